"""Near-duplicates by ProbMinHash: weighted shingles, bands, verified links, classes.

A text is its runs of five words (lower-cased, without punctuation); a run weighs as often
as it occurs. Each run has a stream of arrivals, the same wherever it occurs: a Poisson
process of its weight that drops arrivals into `REGISTERS` registers at random. A register
keeps its earliest arrival's run, and a stream ends once its next arrival is later than what
all registers hold, so two texts agree in a register with their probability Jaccard
similarity. Texts that agree in all registers of a band are candidates. A text in which a run
occurs twice has a second set of registers, in which each run weighs one: there texts agree
with their plain Jaccard similarity. Other texts have the same registers either way.

A bucket's center is its smallest text. Each text is first compared with the centers that
most of its buckets have, and links of 0.8 or more join classes; the similarity is the larger
of the probability Jaccard of the weighted runs and the plain Jaccard of the distinct ones,
over whole texts. In buckets whose texts are still in several classes, each text outside the
largest class is compared with some of that class, and at last with all texts of other
classes. So every candidate pair is either in one class already or compared, and groups of
copies never become all pairs. Equal texts are one text from the start. Pairs that cannot
reach 0.8 are never made: runs that no other candidate has count against a text, which bounds
its similarity to all others.

Defined cases. Null text: the empty text. Texts of one to four words: one run of them all.
Texts without words: alike only if equal. Ids that are null or occur twice: texts take the
place of ids inside; the class id is the smallest id of the class. Repeated rows: one class.
Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.llm.common import Scratch, give_back, giving_back, text_or_empty
from punctual.llm.packed_keys import FACTOR, PARTS, RunningHash, answers, packs, questions, values_of

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 30, 6
REGISTERS = BANDS * ROWS
#: Characters of one text that are hashed at a time, about.
STRETCH = 1 << 20
#: Texts that a Python worker holds at a time; pairs of texts, which may be copies of a long one;
#: parts of about four million bytes.
BATCH, PAIRS, FEW = 256, 64, 4
#: Centers that a text is compared with at first, those of most of its buckets.
CENTERS = 8
#: Texts of a block, and pairs of blocks that a Python worker holds at a time, about.
BLOCK, BLOCKS = 64, 32
#: Counters of a text's runs by hash. The smaller counts of two texts, summed, are never less
#: than the runs they share, unless a counter is full.
COUNTERS = 512
#: Registers in which texts with a full counter, which are very long, agree if they may be links:
#: eight standard deviations below the mean at 0.8, which misses one link in some 10^11 there (by
#: Chernoff's bound) and fewer above.
AGREEING = int(REGISTERS * THRESHOLD - 8 * (REGISTERS * THRESHOLD * (1 - THRESHOLD)) ** 0.5)
#: Text bytes per bucket of runs, about.
BUCKET = 8 << 20
#: Runs whose arrivals are drawn at a time, about.
ELEMENTS = 1 << 16

_GAP = re.compile(r"\W+")


def mix(x: np.ndarray) -> np.ndarray:
    """64 bits scrambled."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _run_hashes(words: bytes, run: int) -> np.ndarray:
    """A 64-bit hash of each `run` successive words of `words`, which single blanks part."""
    raw = np.frombuffer(words, dtype=np.uint8)
    blanks = np.flatnonzero(raw == 32)
    starts, ends = np.append(0, blanks + 1), np.append(blanks, len(raw))
    run = min(run, len(starts))
    starts, ends = starts[: len(starts) - run + 1], ends[run - 1 :]
    return RunningHash(raw).of(starts, ends)


def shingles(text: str, run: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct runs of a text, and how often each occurs."""
    parts, kept, at = [], "", 0
    while at < len(text):
        end = at + STRETCH
        if end < len(text):
            gap = _GAP.search(text, end)
            end = gap.start() if gap else len(text)
        own = _GAP.sub(" ", text[at:end].lower()).strip()
        at = end
        joined = f"{kept} {own}" if kept and own else kept or own
        if not joined:
            continue
        last = joined.rsplit(" ", run - 1)
        if len(last) < run and at < len(text):
            kept = joined
            continue
        if len(last) == run or not parts:
            parts.append(_run_hashes(joined.encode("utf-8", "surrogatepass"), run))
        kept = " ".join(last[1:]) if len(last) == run else joined
    if not parts and kept:
        parts.append(_run_hashes(kept.encode("utf-8", "surrogatepass"), run))
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.unique(np.concatenate(parts), return_counts=True)


def signatures(text: np.ndarray, runs: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """ProbMinHash registers of `n` texts whose runs are given by row (`text` is sorted)."""
    held = np.full(n * REGISTERS, np.inf)
    winner = np.zeros(n * REGISTERS, np.uint64)
    total = np.bincount(text, weights, n)
    # as many arrivals at first as fill all registers of a text on average
    needed = REGISTERS * np.log(REGISTERS) * 1.2
    draws = np.maximum(1, np.ceil(needed * weights / total[text])).astype(np.int64)
    at, latest = np.zeros(len(runs), np.int64), np.zeros(len(runs))
    left = np.arange(len(runs))
    while len(left):
        each = draws[left]
        own = np.repeat(left, each)
        first = np.cumsum(each) - each
        step = np.arange(len(own)) - np.repeat(first, each)
        number = (at[own] + step + 1).astype(np.uint64)
        bits = mix(runs[own] + number * FACTOR)
        register = text[own] * REGISTERS + (bits % np.uint64(REGISTERS)).astype(np.int64)
        wait = -np.log(((mix(bits) >> np.uint64(11)).astype(np.float64) + 1.0) / 9007199254740993.0) / weights[own]
        summed = np.cumsum(wait)
        time = summed - np.repeat(summed[first] - wait[first], each) + latest[own]
        ends = first + each - 1
        latest[left] = time[ends]
        at[left] += each
        early = np.flatnonzero(time < held[register])
        early = early[np.argsort(-time[early], kind="stable")]
        # the earliest of each register is written last
        held[register[early]] = time[early]
        winner[register[early]] = runs[own[early]]
        last = held.reshape(n, REGISTERS).max(axis=1)
        left = left[latest[left] < last[text[left]]]
        draws[left] = draws[left] // 8 + 1
    return winner.reshape(n, REGISTERS)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One hash per band of each row of registers."""
    by_band = registers.reshape(len(registers), BANDS, ROWS)
    keys = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(registers), BANDS))
    for row in range(ROWS):
        keys = mix(keys * FACTOR + by_band[:, :, row])
    return keys


@giving_back
def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Band keys of each row, and a byte of each register; texts without words have none.
    Copies in a batch are signed once."""
    for batch in batches:
        # `digest` names a text, so copies within a batch are found without a second look
        digests = batch.column("digest").to_pylist()
        first: dict[bytes, int] = {}
        for i, digest in enumerate(digests):
            first.setdefault(digest, i)
        keys: dict[bytes, np.ndarray] = {}  # of weighted runs, then of distinct ones if those differ
        marks: dict[bytes, bytes] = {}
        names, runs, weights, held = [], [], [], 0

        def settle() -> None:
            nonlocal names, runs, weights, held
            if names:
                row = np.repeat(np.arange(len(names)), [len(r) for r in runs])
                own = signatures(row, np.concatenate(runs), np.concatenate(weights).astype(np.float64), len(names))
                for name, k, m in zip(names, band_keys(own).astype(np.int64), own.astype(np.uint8), strict=True):
                    keys[name], marks[name] = k, m.tobytes()
                again = [i for i, weight in enumerate(weights) if (weight > 1).any()]
                if again:
                    row = np.repeat(np.arange(len(again)), [len(runs[i]) for i in again])
                    distinct = np.concatenate([runs[i] for i in again])
                    own = signatures(row, distinct, np.ones(len(distinct)), len(again))
                    for i, k in zip(again, band_keys(own).astype(np.int64), strict=True):
                        keys[names[i]] = np.append(keys[names[i]], k)
            names, runs, weights, held = [], [], [], 0

        for digest, i in first.items():
            run, weight = shingles(batch.column("text")[i].as_py())
            if not len(run):
                keys[digest], marks[digest] = np.zeros(0, np.int64), b""
                continue
            names.append(digest)
            runs.append(run)
            weights.append(weight)
            held += len(run)
            if held >= ELEMENTS:
                settle()
        settle()
        own = [keys[d] for d in digests]
        offsets = np.append(0, np.cumsum([len(k) for k in own]))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("digest"),
                pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()), pa.array(np.concatenate(own) if own else [], pa.int64())
                ),
                pa.array([marks[d] for d in digests], pa.binary()),
            ],
            names=["doc_id", "digest", "keys", "marks"],
        )


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The larger of plain Jaccard and probability Jaccard of two texts' runs."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    runs, at = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    p, q = np.zeros(len(runs)), np.zeros(len(runs))
    p[at[: len(a[0])]], q[at[len(a[0]) :]] = a[1] / a[1].sum(), b[1] / b[1].sum()
    both = (p > 0) & (q > 0)
    plain = both.sum() / len(runs)
    if not both.any() or plain >= THRESHOLD:
        return float(plain)
    # of a common run i: 1 / sum_j max(p_j / p_i, q_j / q_i); runs j by their ratio p / q
    ratio = np.divide(p, q, out=np.full(len(runs), np.inf), where=q > 0)
    order = np.argsort(ratio, kind="stable")
    ordered = ratio[order]
    q_below = np.append(0, np.cumsum(q[order]))
    p_from = np.append(np.cumsum(p[order][::-1])[::-1], 0)
    first = np.searchsorted(ordered, ratio[both], side="left")
    shares = 1 / (p_from[first] / p[both] + q_below[first] / q[both])
    return float(max(plain, shares.sum()))


@F.pandas_udf(T.DoubleType())
def _similar(a: pd.Series, b: pd.Series) -> pd.Series:
    """Similarity of text pairs; rows that follow each other often share the second text."""
    known, runs, out = None, None, []
    for x, y in zip(a, b, strict=True):
        if y != known:
            known, runs = y, shingles(y)
        out.append(similarity(shingles(x), runs))
    give_back()
    return pd.Series(out, dtype="float64")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (`a`, `b`) whose texts are similar enough, with `similarity`."""
    one = texts.withColumnRenamed("text", "text_a")
    other = texts.withColumnRenamed("text", "text_b")
    joined = pairs.join(one, pairs["a"] == one["node"]).select("a", "b", "text_a")
    joined = joined.join(other, joined["b"] == other["node"]).sortWithinPartitions("b")
    found = joined.select("a", "b", _similar("text_a", "text_b").alias("similarity"))
    return found.where(F.col("similarity") >= THRESHOLD)


def _runs_of(row: dict) -> list[tuple[np.ndarray, np.ndarray]]:
    ends = np.cumsum(np.frombuffer(row["sizes"], np.int64))
    starts = np.append(0, ends[:-1])
    return [shingles(row["text"][a:b].decode("utf-8")) for a, b in zip(starts, ends, strict=True)]


def _ask_runs(row: dict) -> tuple[np.ndarray, np.ndarray]:
    own, count = np.unique(np.concatenate([r for r, _ in _runs_of(row)]), return_counts=True)
    return own, (count > 1).astype(np.uint8)


def _in_several(bucket: int, keys: np.ndarray, extra: np.ndarray, parts: np.ndarray) -> np.ndarray:
    own, at, count = np.unique(keys, return_inverse=True, return_counts=True)
    return ((count > 1) | (np.bincount(at, extra[:, 0], len(own)) > 0)).astype(np.uint8)[at]


def counters(runs: np.ndarray) -> np.ndarray:
    """How many of a text's distinct runs each counter has; 255 is full."""
    own = np.bincount((runs % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
    return np.minimum(own, 255).astype(np.uint8)


def shared_runs(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """Of each `node` of `texts`: `runs`, its distinct runs; `shared`, those that other texts
    have too; `spare`, the weight of the others; `plain`, whether no run occurs twice; `counts`,
    its counters."""
    raw = texts.select(F.col("node").alias("place"), F.col("text").cast("binary").alias("text"))
    parts = scratch.store(raw.mapInArrow(packs, PARTS), "parts", BATCH)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET))
    told = answers(questions(parts, _ask_runs, buckets), _in_several, "uint8", 1)

    def count(part: tuple, rows: pd.DataFrame, values: pd.DataFrame) -> pd.DataFrame:
        out = []
        give_back()  # what the group before left
        for row in rows.to_dict("records"):
            runs = _runs_of(row)
            own, at = np.unique(np.concatenate([r for r, _ in runs]), return_inverse=True)
            often = (values_of(own, values, buckets, "uint8") if len(own) else np.zeros(0, np.uint8))[at] > 0
            ends = np.cumsum([len(r) for r, _ in runs])
            for node, (run, weight), end in zip(np.frombuffer(row["ids"], np.int64), runs, ends, strict=True):
                seen = often[end - len(run) : end]
                spare = weight[~seen].sum() / max(1, weight.sum())
                out.append((node, len(run), seen.sum(), spare, (weight < 2).all(), counters(run).tobytes()))
        return pd.DataFrame(out, columns=["node", "runs", "shared", "spare", "plain", "counts"])

    counted = parts.groupBy("part").cogroup(told.groupBy("part")).applyInPandas(
        count, "node long, runs long, shared long, spare double, plain boolean, counts binary"
    )
    return scratch.store(counted, "shared", FEW)


def _may_reach() -> Column:
    """Whether texts `a` and `b` can be similar enough, by what they share with anyone.

    Plain Jaccard is at most m / (a + b - m) with m the smaller shared count; of texts
    without repeated runs the probability Jaccard is the same. In general it is at most
    (1 - u)(1 - v) / (1 - u v) with u and v the weights that are not shared.
    """
    most = F.least("a_shared", "b_shared")
    u, v = F.col("a_spare"), F.col("b_spare")
    weighted = ~(F.col("a_plain") & F.col("b_plain")) & ((1 - u) * (1 - v) >= (THRESHOLD - 1e-9) * (1 - u * v))
    return (most >= (THRESHOLD - 1e-9) * (F.col("a_runs") + F.col("b_runs") - most)) | weighted


def _side(shared: DataFrame, side: str) -> DataFrame:
    figures = [F.col(c).alias(f"{side}_{c}") for c in ("runs", "shared", "spare", "plain")]
    return shared.select(F.col("node").alias(side), *figures)


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """`node` and `component` (its smallest node) of all nodes of `links` (`a`, `b`).

    Labels go to neighbours, then along labels of labels, until nothing changes; each round
    is a stored table.
    """
    both = links.select("a", "b").union(links.select("b", "a"))
    both = scratch.store(both.distinct(), f"{name}-links")
    labels = scratch.store(
        both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"), f"{name}-0"
    )
    turn = 0
    while True:
        turn += 1
        seen = labels.select(F.col("node").alias("neighbour"), "label")
        near = both.join(seen, both["b"] == seen["neighbour"]).groupBy("a").agg(F.min("label").alias("near"))
        nearest = labels.join(near, labels.node == near.a).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        of = labels.select(F.col("node").alias("at"), F.col("label").alias("further"))
        jumped = nearest.join(of, nearest.label == of["at"]).select(
            "node", "old", F.least("label", "further").alias("label")
        )
        jumped = scratch.store(jumped, f"{name}-{turn}")
        changed = jumped.where("old <> label").limit(1).count()
        labels = jumped.select("node", "label")
        scratch.drop(f"{name}-{turn - 1}")
        if not changed:
            return labels.withColumnRenamed("label", "component")


def joined(found: DataFrame, links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """`found` (`node`, `component`) after more `links`: only components are linked anew."""
    ends = links.select(F.col("a").alias("node")).union(links.select("b")).distinct().join(found, "node", "left")
    ends = scratch.store(ends.select("node", F.coalesce("component", "node").alias("component")), f"{name}-ends")
    a_end = ends.select(F.col("node").alias("a"), F.col("component").alias("a_part"))
    b_end = ends.select(F.col("node").alias("b"), F.col("component").alias("b_part"))
    between = links.join(a_end, "a").join(b_end, "b").where("a_part <> b_part")
    between = between.select(F.col("a_part").alias("a"), F.col("b_part").alias("b")).distinct()
    merged = components(between, scratch, name).select(
        F.col("node").alias("component"), F.col("component").alias("merged")
    )
    everyone = found.unionByName(ends.join(found, "node", "left_anti"))
    told = everyone.join(merged, "component", "left")
    return scratch.store(told.select("node", F.coalesce("merged", "component").alias("component")), f"{name}-found")


def open_rows(members: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of `members` whose bucket has texts of several classes, with `component`,
    `largest` (whether that class is the largest there) and `size` (texts of the bucket)."""
    placed = members.select("key", "node").join(found, "node", "left")
    placed = placed.select("key", "node", F.coalesce("component", "node").alias("component"))
    parts = placed.groupBy("key", "component").agg(F.count("node").alias("n"))
    bucket = Window.partitionBy("key")
    parts = parts.select(
        "key",
        "component",
        (F.row_number().over(bucket.orderBy(F.desc("n"), "component")) == 1).alias("largest"),
        F.count("component").over(bucket).alias("parts"),
        F.sum("n").over(bucket).alias("size"),
    ).where("parts > 1")
    return placed.join(parts.drop("parts"), ["key", "component"])


def likely_pairs(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """Pairs (`a`, `b`) of each text outside the largest class of its bucket with some texts
    of that class."""
    by_hash = Window.partitionBy("key").orderBy(F.xxhash64("key", "node"), "node")
    some = rows.where("largest").withColumn("turn", F.row_number().over(by_hash)).where(F.col("turn") <= CENTERS // 2)
    one = rows.where("NOT largest").select("key", F.col("node").alias("a")).join(_side(shared, "a"), "a")
    other = some.select("key", F.col("node").alias("b")).join(_side(shared, "b"), "b")
    return one.join(other, "key").where(_may_reach()).select("a", "b").distinct()


def _cards(rows: pa.StructArray) -> dict[str, np.ndarray]:
    """Columns of a block of texts."""
    found = dict(zip([f.name for f in rows.type], rows.flatten(), strict=True))
    packed = lambda name, kind: np.frombuffer(b"".join(found[name].to_pylist()), kind).reshape(len(rows), -1)
    plain = {n: c.to_numpy(zero_copy_only=False) for n, c in found.items() if n not in ("keys", "marks", "counts")}
    keys = np.stack([np.resize(k, 2 * BANDS) for k in found["keys"].to_numpy(zero_copy_only=False)])
    return {**plain, "keys": keys, "marks": packed("marks", np.uint8), "counts": packed("counts", np.uint8)}


@giving_back
def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each pair of blocks, the pairs of texts that may be similar enough: by what they
    share with anyone, and by their counters, or by their registers if a counter is full. A pair
    shows up in its first common bucket."""
    for batch in batches:
        out = []
        for at in range(batch.num_rows):
            key = batch.column("key")[at].as_py()
            one, other = (_cards(batch.column(side)[at].values) for side in ("one", "other"))
            a = {n: c[:, None] for n, c in one.items()}
            b = {n: c[None, :] for n, c in other.items()}
            good = (a["component"] != b["component"]) & (b["largest"] | (a["node"] < b["node"]))
            most = np.minimum(a["shared"], b["shared"])
            u, v = a["spare"], b["spare"]
            plain = a["plain"] & b["plain"]
            limit = THRESHOLD - 1e-9
            reach = (most >= limit * (a["runs"] + b["runs"] - most)) | (
                ~plain & ((1 - u) * (1 - v) >= limit * (1 - u * v))
            )
            x, y = np.nonzero(good & reach)
            common = one["keys"][x] == other["keys"][y]
            first = one["keys"][x, common.argmax(axis=1)] == key
            x, y = x[first], y[first]
            agree = (one["marks"][x] == other["marks"][y]).sum(axis=1)
            common = np.minimum(one["counts"][x], other["counts"][y]).sum(axis=1, dtype=np.int64)
            enough = common >= limit * (one["runs"][x] + other["runs"][y] - common)
            full = (one["counts"] == 255).any(axis=1)[x] | (other["counts"] == 255).any(axis=1)[y]
            kept = np.where(full, agree >= AGREEING, enough) | ~plain[x, y]
            out.append(np.stack([one["node"][x[kept]], other["node"][y[kept]]], axis=1))
        pairs = np.concatenate(out) if out else np.zeros((0, 2), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in pairs.T], names=["a", "b"])


def remaining_pairs(rows: DataFrame, shared: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (`a`, `b`) of each text outside the largest class of its bucket with the texts of
    other classes there. Blocks of texts meet; only pairs that may be links leave the task."""
    cards = rows.join(shared, "node").join(nodes.select("node", "keys", "marks"), "node")
    block = F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / BLOCK)).alias("block")
    figures = ("runs", "shared", "spare", "plain", "counts")
    card = F.struct("node", "component", "largest", *figures, "keys", "marks")
    blocks = lambda some, side: some.groupBy("key", block).agg(F.collect_list(card).alias(side))
    one, other = blocks(cards.where("NOT largest"), "one"), blocks(cards, "other")
    met = one.drop("block").join(other.drop("block"), "key")
    return met.mapInArrow(_compared, "a long, b long")


def classes(documents: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per document: `doc_id`, `digest` of its text, `class_id`, and `first`: whether
    its text stands for the class."""
    work = Scratch(scratch.spark, "near-work")
    result = scratch.store(_classes(documents, work), "classes")
    work.drop("")
    return result


def _classes(documents: DataFrame, scratch: Scratch) -> DataFrame:
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(F.md5(text_or_empty())).alias("digest"),
        text_or_empty().alias("text"),
    )
    signed = scratch.store(texts.mapInArrow(_signed, "doc_id long, digest binary, keys array<long>, marks binary"), "signed", BATCH)
    plain = signed.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").isEmpty()
    node = F.min("doc_id") if plain else F.xxhash64("digest")
    nodes = signed.groupBy("digest").agg(
        node.alias("node"),
        F.min("doc_id").alias("least"),
        F.first("keys").alias("keys"),
        F.first("marks").alias("marks"),
    )
    nodes = scratch.store(nodes, "nodes")
    keyed = nodes.select("node", F.explode(F.array_distinct("keys")).alias("key"))
    buckets = keyed.groupBy("key").agg(F.min("node").alias("center"), F.count("node").alias("n")).where("n > 1")
    members = scratch.store(keyed.join(buckets, "key").select("key", "node", "center"), "members")
    wanted = members.select("node").distinct()
    if plain:
        needed = texts.withColumnRenamed("doc_id", "node").join(wanted, "node", "left_semi").select("node", "text")
    else:
        needed = texts.withColumn("node", F.xxhash64("digest")).join(wanted, "node", "left_semi")
        needed = needed.groupBy("node").agg(F.first("text").alias("text"))
    needed = scratch.store(needed, "texts")
    shared = shared_runs(needed, scratch)
    by_buckets = Window.partitionBy("node").orderBy(F.desc("count"), "center")
    first_pairs = (
        members.where("node <> center")
        .groupBy("node", "center")
        .count()
        .withColumn("turn", F.row_number().over(by_buckets))
        .where(F.col("turn") <= CENTERS)
        .select(F.col("node").alias("a"), F.col("center").alias("b"))
    )
    first_pairs = first_pairs.join(_side(shared, "a"), "a").join(_side(shared, "b"), "b").where(_may_reach())
    first_pairs = scratch.store(first_pairs.select("a", "b"), "pairs-1")
    links = scratch.store(verified(first_pairs, needed), "links-1", PAIRS)
    found = components(links, scratch, "first")

    done = first_pairs
    for name in ("likely", "remaining"):
        rows = scratch.store(open_rows(members, found), f"open-{name}")
        pairs = likely_pairs(rows, shared) if name == "likely" else remaining_pairs(rows, shared, nodes)
        either = done.union(done.select("b", "a"))
        pairs = pairs.join(either, ["a", "b"], "left_anti")
        pairs = scratch.store(pairs, f"pairs-{name}", BLOCKS)
        more = scratch.store(verified(pairs, needed), f"links-{name}", PAIRS)
        done = done.unionByName(pairs)
        if not more.isEmpty():
            found = joined(found, more, scratch, name)

    of_node = nodes.join(found, "node", "left").select(
        "digest", "least", F.coalesce("component", "node").alias("component")
    )
    of_class = of_node.groupBy("component").agg(
        F.min("least").alias("class_id"), F.min_by("digest", F.struct(F.col("least").isNull(), "least", "digest")).alias("leader")
    )
    of_text = of_node.join(of_class, "component").select("digest", "class_id", (F.col("digest") == F.col("leader")).alias("first"))
    return signed.select("doc_id", "digest").join(of_text, "digest").select("doc_id", "digest", "class_id", "first")


def deduplicated(documents: DataFrame, scratch: Scratch) -> DataFrame:
    """`documents` with one row of each class: that of the smallest id."""
    result = classes(documents, scratch)
    plain = result.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").isEmpty()
    kept = result.where(F.col("first") & F.col("doc_id").eqNullSafe(F.col("class_id")))
    if plain:
        return documents.join(kept.select("doc_id"), "doc_id", "left_semi").select(*documents.columns)
    own = documents.withColumn("own digest", F.unhex(F.md5(text_or_empty())))
    kept = kept.select(F.col("digest").alias("own digest"), F.col("class_id").alias("least id")).distinct()
    rows = own.join(kept, "own digest").where(F.col("doc_id").eqNullSafe(F.col("least id")))
    return rows.dropDuplicates(["own digest"]).select(*documents.columns)
