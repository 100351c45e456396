"""Phrases whose words stand together more often than apart, from a weighted de Bruijn graph.

Texts are cut into pieces at sentence marks and line ends, and pieces into words. Nodes of the
graph are runs of `LONGEST` - 1 words, edges the runs of `LONGEST` words that lead from one node
to the next, weighted by their occurrences. Counts of shorter runs follow from the flow: what
leaves a node in edges, and what ends in it because the piece ends (the piece-end correction).
So each word of a text makes one row, the longest run that begins with it.

1. A first pass finds which pairs of neighbouring words can occur `least` times: pairs are
   counted by a 64-bit hash, and the hashes that reach `least` set bits in a map of fixed size
   (`MAP_BITS`). A run that is cut at any other pair loses no phrase, so pieces also end there.
   What shares a bit by chance is only not cut; a full map would cut nothing.
2. A second pass makes the edges and the shorter runs at piece ends, counted per task; Spark sums
   them. A node with one edge and no piece end is a unary path: it is compacted into its edge,
   which carries both counts, and has no row of its own. Others get their flow as a row, and
   so do, level by level, shorter runs.
3. A phrase is scored at its weakest cut by counts of both sides. Phrases of `least` occurrences
   are few, and joins, the check against longer phrases and ranks deal only with them.

Only pieces of the language itself count; the counts of two languages never meet. Numbers that
may pass 64 bits are decimals.

Defined cases. Null or empty text: no words. Null language: `und`. Repeated rows: each counts.
Texts without a blank are one word. No rows: none. Ties: as the order of scores, counts and
phrases (by UTF-8 bytes) says. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.llm.common import BATCH, Scratch, give_back, giving_back, setting, text_or_empty
from punctual.llm.packed_keys import mix

UNKNOWN = "und"
LONGEST, LEAST, TOP = 4, 30, 2000
SCALE, COVER = 2_000_000, 80
#: Where pieces end, and what parts words.
PIECE_END, WORD_END = "[.,;:!?\\x0A-\\x0D]", "[ \\t]+"
#: Bits of the map of pairs, as a power of two: 8 MB at any size of the corpus.
MAP_BITS = 26
#: Text bytes that are cut at a time, distinct pairs that a task holds, bytes of pairs to a bucket.
TEXT, HELD, BUCKET = 4 << 20, 1_500_000, 32 << 20
#: Texts that a Python worker is given at a time.
TEXTS = 512
PAIRS = "bucket long, keys binary, counts binary"
RUNS = "lang string, words int, run string, weight long"


def _blocks(text: str) -> Iterator[str]:
    """A very long text in blocks that end where a piece does."""
    ends, at = re.compile(PIECE_END), 0
    while len(text) - at > TEXT:
        found = ends.search(text, at + TEXT)
        if not found:
            break
        yield text[at : found.end()]
        at = found.end()
    yield text[at:]


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str]]]:
    """Texts of one language, about `TEXT` bytes of all languages at a time."""
    held: dict[str, list[str]] = {}
    size = 0
    for batch in batches:
        for lang, whole in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            for text in _blocks(whole):
                held.setdefault(lang, []).append(text)
                size += len(text)
                if size > TEXT:
                    yield from held.items()
                    held, size = {}, 0
    yield from held.items()


class Words:
    """The words of texts in a row: numbers into `names`, and which are followed by another
    word of their piece."""

    def __init__(self, texts: list[str]):
        pieces = pc.split_pattern_regex(pc.ascii_lower(pa.array(texts, pa.large_string())), pattern=PIECE_END)
        pieces = pc.split_pattern_regex(pieces.flatten(), pattern=WORD_END)
        words = pieces.flatten()
        sizes = pc.list_value_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)
        piece = np.repeat(np.arange(len(sizes)), sizes)
        real = pc.not_equal(words, "")
        piece = piece[real.to_numpy(zero_copy_only=False)]
        coded = words.filter(real).dictionary_encode()
        self.names, self.at = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.followed = np.append(piece[1:] == piece[:-1], np.zeros(min(1, len(piece)), bool))

    def pair_keys(self, lang: str) -> tuple[np.ndarray, np.ndarray]:
        """Places of words with a next one, and a hash of the two and the language."""
        salt = xxhash.xxh3_64_intdigest(lang)
        own = np.array([xxhash.xxh3_64_intdigest(w, salt) for w in self.names.to_pylist()], np.uint64)
        place = np.flatnonzero(self.followed)
        first, second = own[self.at[place]], own[self.at[place + 1]]
        return place, mix(mix(first * np.uint64(0x9E3779B97F4A7C15) ^ second) + second)


def _in_map(keys: np.ndarray) -> np.ndarray:
    """The bit of the map that belongs to each key."""
    return (keys >> np.uint64(64 - MAP_BITS)).astype(np.int64)


def _pair_counts(batches: Iterator[pa.RecordBatch], buckets: int, least: int) -> Iterator[pa.RecordBatch]:
    """Counts of distinct pairs per task, no higher than `least`, by bucket of their bit."""
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def rows() -> pa.RecordBatch:
        bucket = _in_map(keys) >> (MAP_BITS - buckets.bit_length() + 1)  # ascending, as keys are
        found, starts = np.unique(bucket, return_index=True)
        starts = np.append(starts, len(keys))
        ends = list(zip(starts[:-1], starts[1:], strict=True))
        few = np.minimum(counts, least).astype(np.uint16)
        columns = [
            pa.array(found, pa.int64()),
            pa.array([keys[a:b].tobytes() for a, b in ends], pa.binary()),
            pa.array([few[a:b].tobytes() for a, b in ends], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["bucket", "keys", "counts"])

    for lang, texts in _by_language(batches):
        found, times = np.unique(Words(texts).pair_keys(lang)[1], return_counts=True)
        keys, counts = _merged([keys, found], [counts, times])
        if len(keys) > HELD:
            yield rows()
            keys, counts = keys[:0], counts[:0]
    yield rows()


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(count, first) if len(first) else count


def frequent_pairs(texts: DataFrame, scratch: Scratch, least: int) -> np.ndarray:
    """A map of `MAP_BITS` bits, packed, with a bit for each pair that may occur `least` times."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # a pair takes some six bytes of text and ten bytes here, once in each task at most
    wanted = max(1, 2 * size // BUCKET, texts.sparkSession.sparkContext.defaultParallelism)
    buckets = min(1 << (MAP_BITS - 3), 1 << (wanted - 1).bit_length())
    width = (1 << MAP_BITS) // buckets  # bits of a bucket

    def bits(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        keys, counts = _merged(
            [np.frombuffer(k, np.uint64) for k in group["keys"]],
            [np.frombuffer(c, np.uint16).astype(np.int64) for c in group["counts"]],
        )
        own = np.zeros(width, bool)
        own[_in_map(keys[counts >= least]) - key[0] * width] = True
        give_back()
        return pd.DataFrame({"bucket": [key[0]], "bits": [np.packbits(own).tobytes()]})

    counts = texts.mapInArrow(giving_back(lambda batches: _pair_counts(batches, buckets, least)), PAIRS)
    found = scratch.store(counts.groupBy("bucket").applyInPandas(bits, "bucket long, bits binary"), "map", TEXTS)
    out = np.zeros((buckets, width // 8), np.uint8)
    for bucket, own in found.collect():
        out[bucket] = np.frombuffer(own, np.uint8)
    return out.reshape(-1)


def _runs(batches: Iterator[pa.RecordBatch], pairs: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The longest run from each word on, counted; and the number of words, with no run."""
    for lang, texts in _by_language(batches):
        words = Words(texts)
        n = len(words.at)
        if not n:
            continue
        place, keys = words.pair_keys(lang)
        bit = _in_map(keys)
        goes_on = np.zeros(n + LONGEST, bool)
        goes_on[place] = pairs[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8) & 1
        # numbers from 1; 0 where the run has ended
        padded = np.append(words.at + 1, np.zeros(LONGEST, np.int64))
        columns, still = [words.at + 1], np.ones(n, bool)
        for step in range(1, LONGEST):
            still = still & goes_on[step - 1 : n + step - 1]
            columns.append(np.where(still, padded[step : n + step], 0))
        single = columns[1] == 0
        alone = np.bincount(words.at[single], minlength=len(words.names))
        columns = [c[~single] for c in columns]
        code = np.zeros(len(columns[0]), np.int64)
        for column in columns:  # numbers of prefixes, then of whole runs
            code = np.unique(code * (len(words.names) + 1) + column, return_inverse=True)[1]
        _, first, times = np.unique(code, return_index=True, return_counts=True)
        names = pa.concat_arrays([pa.nulls(1, words.names.type), words.names])
        parts = [names.take(pa.array(np.where(c[first] > 0, c[first], 0))) for c in columns]
        runs = pc.binary_join_element_wise(*parts, pa.scalar(" ", names.type), null_handling="skip")
        length = sum((c[first] > 0).astype(np.int32) for c in columns)
        kept = np.flatnonzero(alone)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * (1 + len(kept) + len(first))),
                pa.array(np.concatenate([[0], np.ones(len(kept), np.int32), length]), pa.int32()),
                pa.concat_arrays([pa.nulls(1, names.type), words.names.take(pa.array(kept)), runs]).cast(pa.string()),
                pa.array(np.concatenate([[n], alone[kept], times]), pa.int64()),
            ],
            names=["lang", "words", "run", "weight"],
        )


def _first_words(run: Column, words: int) -> Column:
    return F.substring_index(run, " ", words)


def edges(documents: DataFrame, scratch: Scratch, least: int = LEAST) -> DataFrame:
    """The edges of the graph and the shorter runs at piece ends: `lang`, `words`, `run`,
    `weight`; and the words of each language, as runs of no words."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang")
    texts = documents.select(lang, text_or_empty().alias("text"))
    shared = texts.sparkSession.sparkContext.broadcast(frequent_pairs(texts, scratch, least))
    rows = texts.mapInArrow(giving_back(lambda batches: _runs(batches, shared.value)), RUNS)
    rows = rows.groupBy("lang", "words", "run").agg(F.sum("weight").alias("weight"))
    return scratch.store(rows, "edges", TEXTS)


def counts_of(graph: DataFrame, scratch: Scratch, least: int = LEAST) -> DataFrame:
    """Runs of `least` occurrences, `lang`, `words`, `run`, `count`; `held` is the count of the
    longer run that the run was compacted into, where it is a unary node."""
    longest = graph.where(F.col("words") == LONGEST).withColumnsRenamed({"weight": "count"})
    levels = [longest.where(F.col("count") >= least).withColumn("held", F.lit(None).cast("long"))]
    flow = longest.select("lang", "run", "count")
    for words in range(LONGEST - 1, 0, -1):
        ends = graph.where(F.col("words") == words).select("lang", "run", F.col("weight").alias("count"))
        out = flow.select("lang", _first_words(F.col("run"), words).alias("run"), "count", F.lit(1).alias("edges"))
        both = out.unionByName(ends.withColumn("edges", F.lit(2)))  # an end is never a unary path
        node = both.groupBy("lang", "run").agg(F.sum("count").alias("count"), F.sum("edges").alias("edges"))
        flow = scratch.store(node, f"flow-{words}")
        own = flow.where(F.col("count") >= least)
        held = F.when(F.col("edges") == 1, F.col("count"))
        levels.append(own.select("lang", F.lit(words).alias("words"), "run", "count", held.alias("held")))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    out = scratch.store(out, "counts")
    scratch.drop(*(f"flow-{words}" for words in range(1, LONGEST)))
    return out


def scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Phrases of two words and more with `a`, and at their weakest cut `l`, `r` and `score`."""
    phrases = counts.where("words > 1").select("lang", "words", F.col("run").alias("phrase"), F.col("count").alias("a"))
    cuts = phrases.withColumn("k", F.explode(F.expr("sequence(1, words - 1)")))
    cuts = cuts.withColumn("head", F.expr("substring_index(phrase, ' ', k)"))
    cuts = cuts.withColumn("tail", F.expr("substring_index(phrase, ' ', k - words)"))
    sides = counts.select("lang", "run", "count")
    cuts = cuts.join(sides.select("lang", F.col("run").alias("head"), F.col("count").alias("l")), ["lang", "head"])
    cuts = cuts.join(sides.select("lang", F.col("run").alias("tail"), F.col("count").alias("r")), ["lang", "tail"])
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    ratio = (exact("a") * F.lit(SCALE).cast("decimal(8,0)")).cast("decimal(38,0)")
    cuts = cuts.withColumn("product", ratio).withColumn("sides", (exact("l") + exact("r")).cast("decimal(38,0)"))
    cuts = cuts.withColumn("score", F.expr("product div sides"))
    weakest = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("cut"))
    return weakest.select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.score").join(totals, "lang")


def covered(counts: DataFrame) -> DataFrame:
    """Phrases within longer ones, with the highest count of these as `longer`."""
    runs = counts.where("words > 2").select("lang", "words", "count", F.split("run", " ").alias("own"))
    places = """flatten(transform(sequence(2, words - 1), size ->
        transform(sequence(1, words - size + 1), first -> array_join(slice(own, first, size), ' '))))"""
    within = runs.select("lang", F.explode(F.expr(places)).alias("phrase"), F.col("count").alias("longer"))
    # a unary node is held by its edge, whose count is its own
    compact = counts.where("words > 1 AND held IS NOT NULL")
    compact = compact.select("lang", F.col("run").alias("phrase"), F.col("held").alias("longer"))
    return within.unionByName(compact).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))


def collocations(documents: DataFrame, scratch: Scratch, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The first `top` phrases of each language: `lang`, `rank`, `phrase`, `a`, `l`, `r`, `n`,
    `score`."""
    graph = edges(documents, scratch, least)
    totals = graph.where("words = 0").select("lang", F.col("weight").alias("n"))
    counts = counts_of(graph.where("words > 0"), scratch, least)
    kept = scored(counts, totals).join(covered(counts), ["lang", "phrase"], "left")
    uncovered = F.col("longer").isNull() | (
        F.col("longer").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * COVER
    )
    kept = scratch.store(kept.where(uncovered).drop("longer"), "kept")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # first within shares of a language, so that no task ranks all its phrases
    share = F.pmod(F.xxhash64("phrase"), F.lit(64))
    shares = kept.withColumn("share", share).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order)))
    best = shares.where(F.col("rank") <= top).drop("share")
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return best.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
