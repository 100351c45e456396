"""One result for several groupings: the grand total, per type and per category."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Scope ranks, also the tie order of the final sort.
OVERALL, BY_TYPE, BY_CATEGORY = 1, 2, 3

TYPE, CATEGORY = "trainType", "trainCategory"
KEYS = ["scope_rank", "scope_value"]


def _scope(type_: Column, category: Column) -> list[Column]:
    """Rank and value from the grouping bits, so a NULL type is not taken for the total."""
    rank = (
        F.when(F.grouping(TYPE) == 0, BY_TYPE).when(F.grouping(CATEGORY) == 0, BY_CATEGORY).otherwise(OVERALL)
    )
    return [rank.alias("scope_rank"), F.coalesce(type_, category).alias("scope_value")]


def aggregate_scopes(df: DataFrame, *aggregates: Column, within: Sequence[str] = ()) -> DataFrame:
    """Aggregate a pre-aggregated frame over the three scopes in one pass, or over the
    columns `within` each scope."""
    type_, category, inner = F.col(TYPE), F.col(CATEGORY), [F.col(c) for c in within]
    grouped = df.groupingSets([inner, [type_, *inner], [category, *inner]], type_, category, *inner)
    return grouped.agg(*_scope(type_, category), *aggregates).drop(TYPE, CATEGORY)


def empty_total(spark: SparkSession, *counts: str) -> DataFrame:
    """The total's row with zero counts: a total exists even without rows."""
    return spark.range(1).select(
        F.lit(OVERALL).alias("scope_rank"),
        F.lit(None).cast("string").alias("scope_value"),
        *[F.lit(0).cast("long").alias(c) for c in counts],
    )


def fold(pieces: list[DataFrame], keys: list[str]) -> DataFrame:
    """Put results with the same keys side by side.

    Each piece has at most one row per key. Stacking and grouping treats NULL keys as
    equal and costs one small exchange, where joins would need one per piece.
    """
    stacked = pieces[0]
    for piece in pieces[1:]:
        stacked = stacked.unionByName(piece, allowMissingColumns=True)
    values = [c for c in stacked.columns if c not in keys]
    return stacked.groupBy(*keys).agg(*[F.max(v).alias(v) for v in values])
