"""Stored test results of the tables by day: only days whose folders changed are tested.

What a day's results were made from is kept as the names of its folders. Folder names are never
used twice, so a day that was loaded again, removed or added since then shows in the pointers of
the tables, whoever wrote it and whatever failed in between.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.operators.daily_quality import Suite, day_keys, day_results, merged, signature
from punctual.sources.tables import DAY, NO_DAY, Warehouse, day_of

TESTS = "tests"
RESULTS, KEYS, TESTED = "results_by_day", "keys_by_day", "tested_folders"
FOLDERS = "table_name string, folder string, suite string"

#: layer and name of the stored table that a tested table is, or follows from
Sources = dict[str, tuple[str, str]]


def current_folders(warehouse: Warehouse, sources: Sources) -> set[tuple[str, str]]:
    """The tables' day folders: one name per day and table, from the pointers."""
    return {(table, f) for table, place in sources.items() for f in warehouse.pointer(*place).folders}


def changed_days(warehouse: Warehouse, now: set[tuple[str, str]], suite: str) -> set[str] | None:
    """Days whose folders are not those that were tested, as text; None if no result counts."""
    if not warehouse.has(TESTS, TESTED):
        return None
    tested = warehouse.read(TESTS, TESTED).collect()  # days times tables, as in the pointers
    if any(r.suite != suite for r in tested):
        return None
    days = {day_of(f) for _, f in now ^ {(r.table_name, r.folder) for r in tested}}
    return None if None in days else days


def refresh(warehouse: Warehouse, tables: dict[str, DataFrame], sources: Sources, suite: Suite) -> set[str] | None:
    """Test the changed days of `tables`, in which every row of a day follows from that day's
    folder. Returns those days, None for all."""
    now, own = current_folders(warehouse, sources), signature(suite)
    changed = changed_days(warehouse, now, own)
    if changed == set():
        return changed
    if changed is not None:
        dates = [F.lit(dt.date.fromisoformat(d)) for d in sorted(changed - {NO_DAY})]
        wanted = F.col(DAY).isin(dates) | F.col(DAY).isNull() if NO_DAY in changed else F.col(DAY).isin(dates)
        tables = {name: df.where(wanted) for name, df in tables.items()}
    for name, found in ((RESULTS, day_results(tables, suite, DAY)), (KEYS, day_keys(tables, suite, DAY))):
        if found is None:
            continue
        if changed is None or not warehouse.has(TESTS, name):
            warehouse.overwrite_days(found, TESTS, name)
            continue
        written = {d.isoformat() for d in warehouse.replace_days(found, TESTS, name)}
        gone = changed - written - {NO_DAY}
        warehouse.drop_days([dt.date.fromisoformat(d) for d in gone], TESTS, name)
    rows = [(table, folder, own) for table, folder in sorted(now)]
    warehouse.overwrite(warehouse.spark.createDataFrame(rows, FOLDERS), TESTS, TESTED)
    return changed


def report(warehouse: Warehouse, tables: dict[str, DataFrame], suite: Suite) -> DataFrame:
    """The results of all days as one; `tables` holds those that reference tests look keys up in."""
    keys = warehouse.read(TESTS, KEYS) if warehouse.has(TESTS, KEYS) else None
    return merged(warehouse.read(TESTS, RESULTS), keys, tables, suite)
