"""Keep one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], newest_first: list[Column]) -> DataFrame:
    """The first row of every key in the given order; equal NULL keys are one key.

    Spark plans `row_number = 1` with a group limit before the shuffle, so a map task
    sends at most one row per key however many copies a hot key has.
    """
    order = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")
