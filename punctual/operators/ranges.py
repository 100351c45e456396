"""Date-range filters over rolled-up rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_day(value: str | dt.date) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def _stamp(day: dt.date) -> Column:
    return F.lit(day).cast("timestamp_ntz")


def in_range(bucket: str, start: str | dt.date, end: str | dt.date) -> Column:
    """Rows whose day bucket lies between midnight of `start` and midnight of `end`."""
    return F.col(bucket).between(_stamp(as_day(start)), _stamp(as_day(end)))


def overlaps(start: str | dt.date, end: str | dt.date) -> Column:
    """Spans with an event between midnight of `start` and midnight of `end`.

    A range of at least a day meets a span when the two overlap. A range that ends
    where it starts is one instant and meets only spans stamped at that midnight. A
    range that ends before it starts meets nothing.
    """
    start, end = as_day(start), as_day(end)
    if start < end:
        return (F.col("first_actual_bucket") <= _stamp(end)) & (F.col("last_actual_bucket") >= _stamp(start))
    if start == end:
        return F.col("midnight_days").contains(start.isoformat())
    return F.lit(False)


def last_days(df: DataFrame, day: str, bounds: DataFrame, days: int) -> DataFrame:
    """Rows of the last `days` days up to the newest `day` in `bounds`, which is read
    as a scalar subquery and so also prunes day partitions."""
    newest = bounds.agg(F.max(day)).scalar()
    return df.where(F.col(day) > F.date_sub(newest, days))
