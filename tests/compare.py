"""Compare a Spark result with a DuckDB one: columns by name, rows in any order."""

from __future__ import annotations

import math
from collections import Counter

TABLES = "region nation customer supplier part orders lineitem events".split()


def duckdb_rows(folder: str, sql: str) -> tuple[list[str], list[tuple]]:
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    result = con.execute(sql)
    return [d[0] for d in result.description], result.fetchall()


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}")
    if hasattr(v, "is_finite"):  # decimal
        return float(v)
    return v


def _typed(v):
    """Type name and value, so 1 and 1.0 or a date and its text do not pass as equal."""
    v = _value(v)
    return (type(v).__name__, v)


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_typed(r[i]) for i in order) for r in rows)


def difference(spark_df, folder: str, sql: str) -> str | None:
    """None when equal, else what differs."""
    expected = canonical(*duckdb_rows(folder, sql))
    actual = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if actual[0] != expected[0]:
        return f"columns {actual[0]} instead of {expected[0]}"
    if actual[1] != expected[1]:
        extra, missing = list((actual[1] - expected[1]).items()), list((expected[1] - actual[1]).items())
        return f"{len(extra)} extra {extra[:2]}, {len(missing)} missing {missing[:2]}"
    return None
