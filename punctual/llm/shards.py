"""Shards of near equal size by histogram sort.

Rows are ordered by a hash of their text, then by a hash of their id, so equal texts are
neighbours. For each wanted splitter the bytes below a set of candidate boundaries are
counted exactly; the interval that holds the splitter is probed again until it holds a
single text. A splitter goes to the end of that text which is nearer, so equal texts stay
together; only a group of copies that is larger than a shard is split, between ids. So a
shard is off the mean by less than its own size, and by little where no group is large. Rows
then move once.

Only (key, size) pairs are read again and again, each time those inside the intervals. The
driver holds the probes: shards times `PROBES` counts.

Defined cases. Null text: no bytes, as the empty text. Rows alike in id and text are not
split. Fewer texts than shards: some shards are empty. No rows: none. Extra columns stay;
`shard` and `slot` replace columns of that name.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.llm.common import Scratch, text_or_empty

SHARDS, PROBES = 8, 64
#: Keys are whole numbers below this.
KEYS = 1 << 60
#: Rows that one task numbers, about.
NUMBERED = 50_000


def hashed(text: Column) -> Column:
    """60 bits of a text's hash, the same in every engine."""
    return F.conv(F.substr(F.md5(text), F.lit(1), F.lit(15)), 16, 10).cast("long")


def keyed(rows: DataFrame, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """`rows` with `key`, `tie` and `size` (UTF-8 bytes plus one)."""
    own = F.coalesce(F.col(row_id).cast("string"), F.lit(""))
    return rows.select(
        "*",
        hashed(text_or_empty(text)).alias("key"),
        hashed(own).alias("tie"),
        (F.octet_length(text_or_empty(text)) + 1).cast("long").alias("size"),
    )


class Group(NamedTuple):
    """The rows of one value that a target falls into: bytes below it and with it."""

    value: int
    below: int
    upto: int


def locate(rows: DataFrame, column: str, targets: list[float]) -> list[Group]:
    """For each target (bytes, below the total) the value of `column` that it falls into."""
    found: dict[int, Group] = {}
    open_ones = {i: (0, KEYS, 0) for i in range(len(targets))}  # low, high, bytes below low
    while open_ones:
        intervals = sorted(set(open_ones.values()))
        probe = F.lit(None).cast("struct<at:int,bin:long>")
        for at, (low, high, _) in enumerate(intervals):
            step = -(-(high - low) // PROBES)
            inside = (F.col(column) >= low) & (F.col(column) < high)
            bin_of = F.expr(f"({column} - {low}L) div {step}L")
            probe = F.when(inside, F.struct(F.lit(at).alias("at"), bin_of.alias("bin"))).otherwise(probe)
        counts = (
            rows.select(probe.alias("probe"), column, "size")
            .where("probe IS NOT NULL")
            .groupBy("probe")
            .agg(F.sum("size").alias("bytes"), F.min(column).alias("first"), F.max(column).alias("last"))
            .collect()
        )
        bins = sorted((c.probe.at, c.probe.bin, c.bytes, c.first, c.last) for c in counts)
        narrower = {}
        for i, interval in open_ones.items():
            below = interval[2]
            for at, _, size, first, last in bins:
                if intervals[at] != interval:
                    continue
                if targets[i] < below + size:
                    if first == last:
                        found[i] = Group(first, below, below + size)
                    else:
                        narrower[i] = (first, last + 1, below)
                    break
                below += size
        open_ones = narrower
    return [found[i] for i in range(len(targets))]


def splitters(rows: DataFrame, shards: int = SHARDS) -> list[tuple[int, int]]:
    """(key, tie) of the first row of each shard but the first; needs `key`, `tie`, `size`."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    if not total:
        return [(KEYS, 0)] * (shards - 1)
    targets = [total * i / shards for i in range(1, shards)]
    firsts = []
    for target, group in zip(targets, locate(rows, "key", targets), strict=True):
        if group.upto - group.below > total / shards:
            copies = rows.where(F.col("key") == group.value)
            row = locate(copies, "tie", [target - group.below])[0]
            nearer = row.value + int(target - group.below - row.below > row.upto - target + group.below)
            firsts.append((group.value, nearer))
        else:
            firsts.append((group.value + int(target - group.below > group.upto - target), 0))
    return firsts


def shard_of(firsts: list[tuple[int, int]]) -> Column:
    shard = F.lit(0)
    for key, tie in firsts:
        shard = shard + ((F.col("key") > key) | ((F.col("key") == key) & (F.col("tie") >= tie))).cast("int")
    return shard


def sharded(rows: DataFrame, scratch: Scratch, shards: int = SHARDS) -> DataFrame:
    """`rows` (as of `keyed`) with `shard` and `slot`, gapless from 0 in each shard.

    Slots run through bins of each shard; the exact row counts of the bins give the first
    slot of each, so no task sees a whole shard.
    """
    keys = scratch.store(rows.select("key", "tie", "size"), "keys")
    shard = shard_of(splitters(keys, shards)).alias("shard")
    bins = max(1, -(-keys.count() // (shards * NUMBERED)))
    bin_of = F.pmod(F.xxhash64("key", "tie"), F.lit(bins)).alias("bin")
    before = Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    counts = keys.select(shard, bin_of).groupBy("shard", "bin").count()
    first_slots = counts.select("shard", "bin", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first_slot"))
    plain = rows.drop("shard", "slot", "bin")
    moved = plain.select("*", shard, bin_of).repartition("shard", "bin")
    in_bin = Window.partitionBy("shard", "bin").orderBy("key", "tie")
    numbered = moved.withColumn("in_bin", F.row_number().over(in_bin) - 1)
    return numbered.join(first_slots, ["shard", "bin"]).select(
        *plain.columns, "shard", (F.col("first_slot") + F.col("in_bin")).cast("long").alias("slot")
    )
