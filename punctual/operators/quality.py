"""Declarative data tests.

All row-level tests of a table (not null, accepted values, expressions) share one
aggregation pass; a uniqueness test is one grouped count. Every test gives one row:
table_name, test, severity, failures, passed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR, WARN = "error", "warn"


@dataclass(frozen=True)
class RowTest:
    """Fails on every row where the condition is true. The condition is a function, so
    that tests can be declared before there is a session."""

    name: str
    bad: Callable[[], Column]
    severity: str = ERROR


@dataclass(frozen=True)
class UniqueTest:
    """Fails on every combination of columns that occurs more than once. With
    `skip_nulls`, a NULL is never a duplicate; otherwise NULL equals NULL. `within_day`
    declares that rows of different days never share a key, say because it is made from the day."""

    columns: tuple[str, ...]
    skip_nulls: bool = False
    severity: str = ERROR
    within_day: bool = False

    @property
    def name(self) -> str:
        return f"{'unique' if self.skip_nulls else 'unique_combination'}({', '.join(self.columns)})"


@dataclass(frozen=True)
class ReferenceTest:
    """Fails on every row whose key is missing from the other table."""

    column: str
    table: str
    severity: str = WARN

    @property
    def name(self) -> str:
        return f"references({self.column}, {self.table})"


@dataclass
class TableTests:
    rows: list[RowTest] = field(default_factory=list)
    unique: list[UniqueTest] = field(default_factory=list)
    references: list[ReferenceTest] = field(default_factory=list)


def not_null(column: str, severity: str = ERROR) -> RowTest:
    return RowTest(f"not_null({column})", lambda: F.col(column).isNull(), severity)


def accepted_values(column: str, values: list, severity: str = ERROR) -> RowTest:
    return RowTest(f"accepted_values({column})", lambda: ~F.col(column).isin(values), severity)


def expression_is_true(expression: str, severity: str = ERROR) -> RowTest:
    return RowTest(f"expression({expression})", lambda: ~F.expr(f"({expression})"), severity)


def _result(df: DataFrame, table: str, test: str, severity: str) -> DataFrame:
    return df.select(
        F.lit(table).alias("table_name"),
        F.lit(test).alias("test"),
        F.lit(severity).alias("severity"),
        "failures",
    )


def _row_results(df: DataFrame, table: str, tests: list[RowTest]) -> DataFrame:
    counted = df.agg(*[F.count_if(t.bad()).alias(f"t{i}") for i, t in enumerate(tests)])
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(t.name).alias("test"),
            F.lit(t.severity).alias("severity"),
            F.col(f"t{i}").alias("failures"),
        )
        for i, t in enumerate(tests)
    ]
    return counted.select(F.inline(F.array(*rows)))


def _unique_result(df: DataFrame, table: str, test: UniqueTest) -> DataFrame:
    keys = df.select(*test.columns)
    if test.skip_nulls:
        keys = keys.dropna()
    repeated = keys.groupBy(*test.columns).count().where("count > 1")
    return _result(repeated.agg(F.count(F.lit(1)).alias("failures")), table, test.name, test.severity)


def _reference_result(df: DataFrame, table: str, test: ReferenceTest, tables: dict[str, DataFrame]) -> DataFrame:
    # counted per key first: the join then sees each key once, hot or not
    counts = df.where(F.col(test.column).isNotNull()).groupBy(test.column).count()
    known = tables[test.table].select(test.column).distinct()
    return missing_keys(counts, known, table, test)


def missing_keys(counts: DataFrame, known: DataFrame, table: str, test: ReferenceTest) -> DataFrame:
    """The result of a reference test, from rows per key (`count`) and the known keys."""
    missing = counts.join(known, test.column, "left_anti")
    failures = F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("failures")
    return _result(missing.agg(failures), table, test.name, test.severity)


def require_tables(tables: dict[str, DataFrame], suite: dict[str, TableTests]) -> None:
    """A table that a test needs and that is not there is an error: a test that cannot run has
    not passed."""
    needed = {*suite, *(t.table for tests in suite.values() for t in tests.references)}
    if absent := sorted(needed - set(tables)):
        raise KeyError(f"no table for the tests of {', '.join(absent)}")


def run_tests(tables: dict[str, DataFrame], suite: dict[str, TableTests]) -> DataFrame:
    """One result row per declared test."""
    require_tables(tables, suite)
    results = []
    for table, tests in suite.items():
        df = tables[table]
        if tests.rows:
            results.append(_row_results(df, table, tests.rows))
        results += [_unique_result(df, table, t) for t in tests.unique]
        results += [_reference_result(df, table, t, tables) for t in tests.references]
    return reduce(DataFrame.unionByName, results).withColumn("passed", F.col("failures") == 0)


class DataTestError(Exception):
    """Raised when a test of severity error fails."""


def enforce(report: DataFrame) -> list:
    """Return the failed tests; raise if one of them is an error. The report has one
    row per declared test, so it is small."""
    failed = report.where(~F.col("passed")).orderBy("table_name", "test").collect()
    errors = [f"{r.table_name}: {r.test} failed {r.failures} times" for r in failed if r.severity == ERROR]
    if errors:
        raise DataTestError("; ".join(errors))
    return failed
