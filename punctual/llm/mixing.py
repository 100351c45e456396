"""Mixing by iterative proportional fitting.

Token counts per cell (source, language, topic) are raked: in turn, the weights of each
marginal are scaled to its target shares, until all three hold. Every value of a marginal has
one factor, and the weight of a cell is the product of its factors; so a turn is one aggregation
of the cells by that marginal, and only the factors are written. Sweeps end once what the
marginals are off, measured as each is scaled, is below `TOLERANCE`. Marginals that contradict
each other (a value that stands in cells of one other value only) cannot all hold: sweeps then
end when the error does not fall any more, and a warning tells how large it is.

The ratio of a cell's raked to its own weight, scaled and at most one, is the probability with
which its documents are kept, so the expected tokens of the sample have the target marginals.
The scale is set by the largest ratio once the cells of the largest ratios, up to `SLACK` of the
target's tokens, are left out: those are kept whole and fall short of their target, together by
at most that share, so a few stray rows do not set what is kept of the rest. Ratios are compared
in steps of a 64th of a doubling, whose number has a bound that does not follow the cells. A
document is kept if a hash of it lies below its probability: the same documents on each run.

A target is a temperature (shares to that power, scaled to one) or shares by value; values
not listed then share what is left in proportion to their tokens.

Defined cases. Null source or language: a value of its own. Null or empty text: no tokens;
it is kept with its cell's probability. Cells without tokens: probability one. Repeated rows
share one fate. No rows: none. A value with a listed
share of zero: probability zero. No listed value in the data and nothing left for the others: an
error. Extra columns stay.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.llm.common import Scratch, text_or_empty

MARGINS = ("source", "lang", "topic")
#: Powers of the shares that the sample should have.
TARGETS: Mapping[str, float] = {"source": 0.8, "lang": 0.8, "topic": 0.8}
SEED = "mix-1"
#: Share of the tokens by which a raked marginal may be off; sweeps at most; what a sweep has to
#: leave of the error at most for another one to follow.
TOLERANCE, SWEEPS, FALLING = 1e-5, 40, 0.99
#: Share of the target's tokens in cells that may fall short of it.
SLACK = 0.01
#: Steps of a doubling in which ratios are compared.
STEPS = 64
UNKNOWN = "\x00"

Target = float | Mapping[str, float]


def tokens() -> Column:
    """Words of `text`: its spaces, and one."""
    text = text_or_empty()
    spaces = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))
    return F.when(text == "", F.lit(0)).otherwise(spaces + 1).cast("long")


def topic() -> Column:
    """A coarse subject of `text`."""
    text = text_or_empty()
    return (
        F.when(text.contains("icense"), F.lit("licensed"))
        .when(text.contains("@"), F.lit("contact"))
        .when(text.contains("|"), F.lit("listing"))
        .when(tokens() >= 500, F.lit("long"))
        .otherwise(F.lit("short"))
    )


def described(documents: DataFrame) -> DataFrame:
    """`documents` with `tokens`, `topic` and `chance`, a number from 0 to 1 by hash."""
    own = F.concat_ws(":", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text_or_empty()))
    digits = F.conv(F.substr(F.md5(own), F.lit(1), F.lit(13)), 16, 10)
    return documents.drop("tokens", "topic", "chance").select(
        "*", tokens().alias("tokens"), topic().alias("topic"), (digits.cast("double") / 2.0**52).alias("chance")
    )


def _key(margin: str) -> Column:
    return F.coalesce(F.col(margin), F.lit(UNKNOWN)).alias(f"{margin}_key")


def _targets(cells: DataFrame, margin: str, target: Target) -> DataFrame:
    """The share that each value of `margin` should have, and its factor so far."""
    key = f"{margin}_key"
    values = cells.groupBy(key).agg(F.sum("share").alias("own"))
    if isinstance(target, Mapping):
        listed = F.create_map(*[F.lit(x) for pair in target.items() for x in pair])[F.col(key)]
        unlisted = values.agg(F.sum(F.when(listed.isNull(), F.col("own")))).head()[0]
        rest = F.lit(max(0.0, 1.0 - sum(target.values())) / unlisted if unlisted else 0.0)
        values = values.withColumn("own", F.coalesce(listed, rest * F.col("own")))
    else:
        values = values.withColumn("own", F.pow("own", F.lit(target)))
    total = values.agg(F.sum("own")).head()[0]
    if not total:
        raise ValueError(f"no {margin} of the target has tokens")
    return values.select(key, (F.col("own") / total).alias("target"), F.lit(1.0).alias("factor"))


def _weighted(cells: DataFrame, factors: Mapping[str, DataFrame]) -> DataFrame:
    """`cells` with `weight`, the product of their factors."""
    weight = F.lit(1.0)
    for margin, own in factors.items():
        cells = cells.join(own.select(f"{margin}_key", F.col("factor").alias(f"{margin}_factor")), f"{margin}_key")
        weight = weight * F.col(f"{margin}_factor")
    return cells.withColumn("weight", weight).drop(*[f"{m}_factor" for m in factors])


def _scaled(cells: DataFrame, factors: Mapping[str, DataFrame], margin: str) -> DataFrame:
    """New factors of `margin`, and by how much (`off`) the old ones missed its target."""
    key = f"{margin}_key"
    others = {m: own for m, own in factors.items() if m != margin}
    reached = F.sum(F.col("share") * F.col("weight")).alias("reached")
    sums = _weighted(cells, others).groupBy(key).agg(reached)
    return factors[margin].join(sums, key).select(
        key,
        "target",
        F.coalesce(F.try_divide("target", "reached"), F.lit(0.0)).alias("factor"),
        F.abs(F.col("target") - F.col("factor") * F.col("reached")).alias("off"),
    )


def _raked(cells: DataFrame, targets: Mapping[str, Target], scratch: Scratch) -> dict[str, DataFrame]:
    """The factors of each marginal."""
    factors = {m: scratch.store(_targets(cells, m, targets[m]), f"{m}-0") for m in targets}
    before = float("inf")
    for sweep in range(1, SWEEPS + 1):
        error = 0.0
        for m in targets:
            factors[m] = scratch.store(_scaled(cells, factors, m), f"{m}-{sweep}")
            scratch.drop(f"{m}-{sweep - 1}")
            error = max(error, factors[m].agg(F.sum("off")).head()[0] / 2)
        if error <= TOLERANCE:
            return factors
        if error > FALLING * before:
            break
        before = error
    warnings.warn(f"the marginals are {error:.2g} of the tokens off their targets", stacklevel=3)
    return factors


def _top(cells: DataFrame) -> float:
    """The largest weight but for those of the cells that may fall short."""
    step = F.floor(F.log2("weight") * STEPS).alias("step")
    steps = cells.groupBy(step).agg(F.sum(F.col("share") * F.col("weight")).alias("mass"), F.max("weight").alias("largest"))
    # at most some 140,000 rows, whatever the number of cells: a double has 2,100 doublings
    reached = F.sum("mass").over(Window.orderBy(F.desc("step")))
    total = F.sum("mass").over(Window.partitionBy())
    steps = steps.select("largest", (reached > SLACK * total).alias("beyond"))
    return steps.agg(F.max(F.when(F.col("beyond"), F.col("largest")))).head()[0]


def rake(rows: DataFrame, scratch: Scratch, targets: Mapping[str, Target] = TARGETS) -> DataFrame:
    """`weight` (target over own share) and `probability` per cell of `rows`, a stored table."""
    margins = list(targets)
    keys = [f"{m}_key" for m in margins]
    cells = rows.select(*[_key(m) for m in margins], "tokens").groupBy(*keys).agg(F.sum("tokens").alias("tokens"))
    cells = scratch.store(cells.where("tokens > 0"), "cells")
    total = cells.agg(F.sum("tokens")).head()[0]
    if not total:
        return cells.select(*keys, F.lit(1.0).alias("weight"), F.lit(1.0).alias("probability"))
    cells = cells.select(*keys, (F.col("tokens") / total).alias("share"))
    weighted = scratch.store(_weighted(cells, _raked(cells, targets, scratch)), "weighted")
    top = _top(weighted.where("weight > 0"))
    chosen = weighted.select(*keys, "weight", F.least(F.lit(1.0), F.col("weight") / top).alias("probability"))
    return scratch.store(chosen, "raked")


def mixed(documents: DataFrame, scratch: Scratch, targets: Mapping[str, Target] = TARGETS) -> DataFrame:
    """`documents` with `tokens`, `topic`, `weight`, `probability` and `kept`."""
    rows = described(documents)
    cells = rake(rows, scratch, targets)
    margins = list(targets)
    keyed = rows.drop("weight", "probability", "kept").select("*", *[_key(m) for m in margins])
    joined = keyed.join(cells, [f"{m}_key" for m in margins], "left")
    one = F.coalesce("probability", F.lit(1.0))
    return joined.drop(*[f"{m}_key" for m in margins]).select(
        *[c for c in rows.columns if c not in ("weight", "probability", "kept", "chance")],
        F.coalesce("weight", F.lit(1.0)).alias("weight"),
        one.alias("probability"),
        (F.col("chance") < one).alias("kept"),
    )
