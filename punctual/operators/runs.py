"""Gaps and islands over day stamps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctual.functions import midnight_day


def day_runs(days: DataFrame, keys: list[str], day: str) -> DataFrame:
    """Fold distinct day stamps per key into runs with no gap above 24 hours.

    Gives keys, first_<day>, last_<day> and midnight_days. The input holds each
    (key, stamp) once, so a window group is as long as the calendar (two stamps a
    day at most), whatever the number of events behind it.
    """
    ordered = Window.partitionBy(*keys).orderBy(day)
    gap = F.col(day) - F.lag(day).over(ordered)
    marked = days.withColumn("_starts", F.coalesce(gap > F.expr("INTERVAL '1' DAY"), F.lit(True)))
    up_to_here = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = marked.withColumn("_run", F.sum(F.col("_starts").cast("int")).over(up_to_here))
    return (
        numbered.groupBy(*keys, "_run")
        .agg(
            F.min(day).alias(f"first_{day}"),
            F.max(day).alias(f"last_{day}"),
            F.concat_ws(",", F.array_sort(F.collect_set(midnight_day(day)))).alias("midnight_days"),
        )
        .drop("_run")
    )
