"""Pieces shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.functions import average_delay, merged_measures, on_time_percentage


def rolled_up(table: DataFrame, *keys: str | Column) -> DataFrame:
    """Add up the additive measures of a roll-up to coarser keys."""
    return table.groupBy(*keys).agg(*merged_measures())


def otp() -> Column:
    return on_time_percentage().alias("otp_percentage")


def mean() -> Column:
    return average_delay().alias("avg_delay")


def trains_per(spans: DataFrame, *keys: str) -> DataFrame:
    return spans.groupBy(*keys).agg(F.sum("n_trains").alias("trains"))


def same_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join two roll-ups on equal keys where NULL equals NULL; keeps the left keys."""
    renamed = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    condition = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return left.join(renamed, condition, how).drop(*[f"_{k}" for k in keys])
