"""Data tests of tables by day, as results per day that add up.

A row-level test counts bad rows, so its failures add up over days. So do those of a uniqueness
test whose key holds the day or is made from it: equal keys lie in one day. A reference test
depends on the other table as well, so each day keeps how often every key occurs, and a report
looks the keys up anew. A day that changes is tested again; no other day is read.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.operators.quality import TableTests, UniqueTest, missing_keys, require_tables

Suite = dict[str, TableTests]


def _row_results(df: DataFrame, table: str, tests: TableTests, day: str) -> DataFrame:
    counted = df.groupBy(day).agg(*[F.count_if(t.bad()).alias(f"t{i}") for i, t in enumerate(tests.rows)])
    rows = [
        F.struct(F.lit(table).alias("table_name"), F.lit(t.name).alias("test"), F.col(f"t{i}").alias("failures"))
        for i, t in enumerate(tests.rows)
    ]
    return counted.select(day, F.inline(F.array(*rows)))


def _unique_result(df: DataFrame, table: str, test: UniqueTest, day: str) -> DataFrame:
    if not test.within_day and day not in test.columns:
        raise ValueError(f"{table}: {test.name} may fail across days")
    keys = df.select(*{day: None, **dict.fromkeys(test.columns)})
    if test.skip_nulls:
        keys = keys.dropna(subset=list(test.columns))
    repeated = keys.groupBy(*keys.columns).count().where("count > 1")
    found = repeated.groupBy(day).agg(F.count(F.lit(1)).alias("failures"))
    return found.select(day, F.lit(table).alias("table_name"), F.lit(test.name).alias("test"), "failures")


def day_results(tables: dict[str, DataFrame], suite: Suite, day: str) -> DataFrame:
    """Failures by day and test (`day`, `table_name`, `test`, `failures`). Row-level tests give a
    row for each day of the table, uniqueness tests one for the days that fail."""
    parts = []
    for table, tests in suite.items():
        if tests.rows:
            parts.append(_row_results(tables[table], table, tests, day))
        parts += [_unique_result(tables[table], table, t, day) for t in tests.unique]
    return reduce(DataFrame.unionByName, parts)


def day_keys(tables: dict[str, DataFrame], suite: Suite, day: str) -> DataFrame | None:
    """How often each key of a reference test occurs on a day (`day`, `table_name`, `test`,
    `key` as text, `rows`); None without such a test."""
    parts = []
    for table, tests in suite.items():
        for test in tests.references:
            named = tables[table].where(F.col(test.column).isNotNull()).select(
                day,
                F.lit(table).alias("table_name"),
                F.lit(test.name).alias("test"),
                F.col(test.column).cast("string").alias("key"),
            )
            parts.append(named.groupBy(*named.columns).agg(F.count(F.lit(1)).alias("rows")))
    return reduce(DataFrame.unionByName, parts) if parts else None


def merged(results: DataFrame, keys: DataFrame | None, tables: dict[str, DataFrame], suite: Suite) -> DataFrame:
    """The report of `run_tests`, from the results and keys of all days."""
    require_tables(tables, suite)
    sums = results.groupBy("table_name", "test").agg(F.sum("failures").alias("failures"))
    declared = [
        F.struct(F.lit(table).alias("table_name"), F.lit(t.name).alias("test"), F.lit(t.severity).alias("severity"))
        for table, tests in suite.items()
        for t in (*tests.rows, *tests.unique)
    ]
    listed = results.sparkSession.range(1).select(F.inline(F.array(*declared)))
    counted = listed.join(sums, ["table_name", "test"], "left").withColumn(
        "failures", F.coalesce("failures", F.lit(0)).cast("long")
    )
    parts = [counted]
    for table, tests in suite.items():
        for test in tests.references:
            own = keys.where((F.col("table_name") == table) & (F.col("test") == test.name))
            counts = own.groupBy(F.col("key").alias(test.column)).agg(F.sum("rows").alias("count"))
            known = tables[test.table].select(F.col(test.column).cast("string").alias(test.column)).distinct()
            parts.append(missing_keys(counts, known, table, test))
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("failures") == 0)


def signature(suite: Suite) -> str:
    """Changes with the suite, conditions included: results of another suite do not count."""
    texts = []
    for table, tests in sorted(suite.items()):
        texts += [f"{table} {t.name} {t.bad()}" for t in tests.rows]
        texts += [f"{table} {t}" for t in (*tests.unique, *tests.references)]
    return hashlib.md5("\n".join(texts).encode()).hexdigest()
