"""Exact order statistics from value counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def weighted_percentile(value: str, count: str, at: float) -> Column:
    """Exact interpolated percentile of `value`, each repeated `count` times.

    The buffer holds distinct values only, so a group of any size fits.
    """
    return F.percentile(value, F.lit(at), F.col(count))
