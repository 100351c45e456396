"""The daily build: day files to bronze, silver and gold tables, then the data tests."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.operators.quality import enforce, run_tests
from punctual.plans import bronze, daily_tests, silver
from punctual.plans.daily_tests import TESTS
from punctual.plans.marts import FACT, GOLD_TABLES, STATION_ROLLUP, STATIONS, Marts
from punctual.plans.quality_suite import SUITE
from punctual.plans.states import BY_DAY, MERGED, STATES, station_performance
from punctual.sources import day_files, landing
from punctual.sources.tables import Warehouse

BRONZE, SILVER, STATE, GOLD = "bronze", "silver", "states", "gold"
TRAINS, BRONZE_STATIONS = "train_departures", "stations"
UNNESTED = "timetable_unnested"
REPORT = "results"
LOADS, COVERAGE = "load_runs", "coverage_record"
WRITERS = 4  # tables written side by side
#: Tables whose rows follow from one day each, and what they are stored as.
DAY_SOURCES = {
    TRAINS: (BRONZE, TRAINS),
    UNNESTED: (BRONZE, TRAINS),
    FACT: (SILVER, FACT),
    **{name: (GOLD, name) for name in BY_DAY},
}


@dataclass(frozen=True)
class BuildOptions:
    """`reload_days` is the late-data bound: a day inside the window is replaced as a
    whole, an older one only by a full refresh."""

    reload_days: int = 7
    retention_days: int = 365
    full_refresh: bool = False
    as_of: dt.date | None = None

    @property
    def today(self) -> dt.date:
        return self.as_of or dt.datetime.now(dt.UTC).date()

    @property
    def reload_from(self) -> dt.date:
        """First reloaded day; the window includes both ends."""
        return self.today - dt.timedelta(days=self.reload_days)

    @property
    def retention_cutoff(self) -> dt.date:
        return self.today - dt.timedelta(days=self.retention_days)


def load_bronze_trains(warehouse: Warehouse, raw: DataFrame, run_id: str, full: bool) -> None:
    """De-duplicate raw trains and replace the days they cover, or the whole table."""
    trains = bronze.train_departures(raw, run_id)
    if full:
        warehouse.overwrite_days(trains, BRONZE, TRAINS)
    else:
        warehouse.replace_days(trains, BRONZE, TRAINS)


def record_load(warehouse: Warehouse, run_id: str, since: dt.date | None, today: dt.date) -> None:
    """Append what a load brought to the list of loads; only the loaded days are read."""
    loaded = warehouse.read_days(BRONZE, TRAINS).where(F.col("_run_id") == run_id)
    if since is not None:
        loaded = loaded.where(F.col("departureDate") >= F.lit(since))
    summary = landing.load_summary(loaded, since, today)
    warehouse.append(summary.withColumn("run_id", F.lit(run_id)), BRONZE, LOADS)


def build_silver(warehouse: Warehouse, since: dt.date | None = None) -> None:
    """Rebuild the fact, or only its days from `since` on: a fact day depends on the
    bronze day of the same date and on nothing else. A day of that window without events
    any more, say because its trains were cancelled, goes."""
    trains = warehouse.read_days(BRONZE, TRAINS)
    if since is None:
        warehouse.overwrite_days(_fact(trains), SILVER, FACT)
    else:
        fact = _fact(trains.where(F.col("departureDate") >= F.lit(since)))
        warehouse.replace_days(fact, SILVER, FACT, since)
    warehouse.overwrite(silver.dim_stations(warehouse.read(BRONZE, BRONZE_STATIONS)), SILVER, STATIONS)


def _fact(trains: DataFrame) -> DataFrame:
    return silver.fact_timetable_events(silver.timetable_unnested(trains))


def build_gold(warehouse: Warehouse, since: dt.date | None = None, oldest: dt.date | None = None) -> None:
    """Bring the states of the fact's days from `since` on up to date, or of all days, drop
    those of days before `oldest`, and merge the gold tables from the states. Of the fact only
    the days from `since` on are read."""
    refresh_states(warehouse, since)
    if oldest is not None:
        for layer, names in ((STATE, STATES), (GOLD, BY_DAY)):
            for name in names:
                warehouse.drop_days_before(oldest, layer, name)
    states = {name: warehouse.read_days(STATE, name) for name in STATES}
    tables = {name: merge(states.get) for name, merge in MERGED.items()}
    tables[STATION_ROLLUP] = station_performance(states.get, warehouse.read(SILVER, STATIONS))
    _all([partial(warehouse.overwrite, table, GOLD, name) for name, table in tables.items()])


def _all(writes: list[Callable[[], object]]) -> None:
    """Run writes of different tables, a few at a time: each is a small job that leaves most
    of a cluster idle. The first failure is raised once all have ended."""
    with ThreadPoolExecutor(WRITERS) as pool:
        for done in [pool.submit(write) for write in writes]:
            done.result()


def refresh_states(warehouse: Warehouse, since: dt.date | None = None) -> None:
    """Replace the states, and the gold tables by day, of the days from `since` on. A table
    that is not there yet, say after an update of this library, is made from all days."""
    fact = warehouse.read_days(SILVER, FACT)
    writes = []
    for layer, tables in ((STATE, STATES), (GOLD, BY_DAY)):
        for name, state in tables.items():
            if since is None or not warehouse.has(layer, name):
                writes.append(partial(warehouse.overwrite_days, state(fact), layer, name))
            else:
                window = fact.where(F.col("departureDate") >= F.lit(since))
                writes.append(partial(warehouse.replace_days, state(window), layer, name, since))
    _all(writes)


def stored_marts(warehouse: Warehouse) -> Marts:
    """The tables of a finished build, for the reports."""

    def read(name: str) -> DataFrame:
        return warehouse.read(SILVER if name in (FACT, STATIONS) else GOLD, name)

    return Marts.from_tables(read)


def stored_tables(warehouse: Warehouse) -> dict[str, DataFrame]:
    trains = warehouse.read_days(BRONZE, TRAINS)
    tables = {
        BRONZE_STATIONS: warehouse.read(BRONZE, BRONZE_STATIONS),
        TRAINS: trains,
        UNNESTED: silver.timetable_unnested(trains),
        FACT: warehouse.read_days(SILVER, FACT),
        STATIONS: warehouse.read(SILVER, STATIONS),
    }
    return tables | {name: warehouse.read(GOLD, name) for name in GOLD_TABLES}


def check_tables(warehouse: Warehouse) -> DataFrame:
    """One row per declared test, stored. Tables by day are tested on the days that changed since
    the last report; the others, which a build writes whole, are roll-ups and dimensions."""
    tables = stored_tables(warehouse)
    by_day = {name: SUITE[name] for name in DAY_SOURCES}
    others = {name: tests for name, tests in SUITE.items() if name not in by_day}
    daily_tests.refresh(warehouse, {name: tables[name] for name in by_day}, DAY_SOURCES, by_day)
    results = daily_tests.report(warehouse, tables, by_day).unionByName(run_tests(tables, others))
    warehouse.overwrite(results, TESTS, REPORT)
    return warehouse.read(TESTS, REPORT)


def run_daily(
    spark: SparkSession, staging: str, warehouse_root: str, options: BuildOptions | None = None
) -> DataFrame:
    """Load, build and test. Returns the test report; raises if a test of severity
    error fails. The first run is a full one."""
    options = options or BuildOptions()
    warehouse = Warehouse(spark, warehouse_root)
    run_id = str(uuid.uuid4())
    full = options.full_refresh or not warehouse.has(BRONZE, TRAINS)

    stations = bronze.stations(day_files.read_stations(spark, staging), run_id)
    warehouse.overwrite(stations, BRONZE, BRONZE_STATIONS)
    since = None if full else options.reload_from
    load_bronze_trains(warehouse, day_files.read_trains(spark, staging, since), run_id, full)
    record_load(warehouse, run_id, since, options.today)
    build_silver(warehouse, since)
    for layer, name in ((BRONZE, TRAINS), (SILVER, FACT)):
        warehouse.drop_days_before(options.retention_cutoff, layer, name)
    build_gold(warehouse, since, options.retention_cutoff)
    trains = warehouse.read_days(BRONZE, TRAINS)
    warehouse.overwrite(landing.coverage_record(trains), GOLD, COVERAGE)

    report = check_tables(warehouse)
    enforce(report)
    return report
