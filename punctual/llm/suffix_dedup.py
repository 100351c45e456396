"""Repeated strings by a distributed difference-cover algorithm.

Each byte that a string of `LENGTH` bytes covers which also starts earlier is found, over all
documents. Matches never cross documents.

1. Reduction. In each window of `LENGTH` bytes the smallest of the hashed strings of `GRAM`
   bytes is its anchor, so equal windows have equal anchors at the same place. Windows whose
   anchor string occurs once repeat nothing. An anchor's windows are neighbours; where all of
   them occur earlier in one piece, they are settled. What is left are stretches around the
   ends of matches.
2. Difference cover. Of the positions in these stretches, the residues 1 and 2 modulo 3 are
   sampled. Triples of strings at sampled positions are sorted over all tasks and named by
   their place; then triples of names, until a name stands for `NAMED` bytes. Names that
   occur once end there.
3. Remaining positions. Any two positions have a distance below 3 at which both are sampled,
   so two windows are equal exactly if the bytes up to there, the names from there on and the
   bytes behind the last name are. Each window asks under the two distances that its residue
   shares with others whether an equal one stands earlier.

Keys travel as packed arrays, each once per part, so a string that every document holds is a
row per part, not per occurrence. Hashes have 64 bits, and windows are equal only if several
agree. Texts move twice by row: to take out the stretches, and to be cut.

Defined cases. Null text: empty. Texts shorter than `LENGTH`: nothing is removed. Null ids:
after all others. Several texts with one id: documents of their own, ordered by a hash of
their text. Rows alike in id and text: one document; all such rows get its result. Extra
columns are ignored by `cut_bytes` and stay in `without_repeats`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.llm.common import Scratch, give_back, giving_back, text_or_empty
from punctual.llm.packed_keys import FACTOR, PARTS, RunningHash, answers, mix, packs, questions, values_of

LENGTH, GRAM = 100, 50
#: The first triples are of strings of 9 bytes; each turn makes names three times as long.
FIRST, NAMED = 27, 81
#: Text bytes that are hashed at a time, about; text bytes per bucket of keys.
STRETCH, BUCKET = 1 << 17, 8 << 20
SEGMENT_PART, SEGMENT_BUCKET = 1 << 19, 2 << 20
#: Texts that a Python worker is given at a time.
TEXTS = 512

FOUND = "place long, spans binary, starts binary, sizes binary, text binary"
SEGMENTS = "part long, ids binary, starts binary, sizes binary, text binary"
EMPTY, SETTLED, OPEN = 0, 1, 2
PLACE = "its place"


class Anchors:
    """Anchors of the texts of one part: `at`, first and last window, text number, and keys."""

    def __init__(self, sizes: np.ndarray, text: np.ndarray):
        ends = np.cumsum(sizes)
        found, at = [], 0
        while at < len(sizes):
            # as many whole texts as fit, or stretches of a long one
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + STRETCH, side="right")))
            begin, end = int(ends[at] - sizes[at]), int(ends[stop - 1])
            if end - begin >= LENGTH:
                for low in range(begin, end - LENGTH + 1, STRETCH if stop == at + 1 else end - begin):
                    high = min(end, low + STRETCH + LENGTH - 1) if stop == at + 1 else end
                    found.append(self._stretch(text, low, high, ends[at:stop], at))
            at = stop
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 4 + [
            np.zeros(0, np.uint64)
        ] * 1
        self.at, self.low, self.high, self.text, self.gram = columns
        if len(self.at):
            # windows on both sides of a seam may have one anchor
            again = np.append(False, (self.at[1:] == self.at[:-1]) & (self.text[1:] == self.text[:-1]))
            last = np.append(~again[1:], True)
            high = self.high[last]
            self.at, self.low, self.text, self.gram = (c[~again] for c in (self.at, self.low, self.text, self.gram))
            self.high = high
        self.context = self._contexts(text)

    @staticmethod
    def _stretch(text: np.ndarray, low: int, high: int, ends: np.ndarray, first: int) -> tuple:
        own = text[low:high]
        grams = RunningHash(own).of_length(GRAM)
        width = LENGTH - GRAM + 1
        # smallest hash, then last position: one number each
        bits = np.uint64((1 << 20) - 1)
        best = (grams & ~bits) | (bits - np.arange(len(grams), dtype=np.uint64))
        span = 1
        while span * 2 <= width:
            best = np.minimum(best[:-span], best[span:])
            span *= 2
        if span < width:
            best = np.minimum(best[: span - width], best[width - span :])
        windows = np.arange(len(best))
        inside = np.searchsorted(ends - low, windows, side="right")
        fits = windows + LENGTH <= (ends - low)[np.minimum(inside, len(ends) - 1)]
        windows, number = windows[fits], inside[fits]
        anchor = (bits - (best[fits] & bits)).astype(np.int64)
        opens = np.append(True, (anchor[1:] != anchor[:-1]) | (number[1:] != number[:-1]))[: len(anchor)]
        begin = np.flatnonzero(opens)
        close = np.append(begin[1:], len(windows))[: len(begin)] - 1
        return anchor[begin] + low, windows[begin] + low, windows[close] + low, number[begin] + first, grams[anchor[begin]]

    def _contexts(self, text: np.ndarray) -> np.ndarray:
        """A hash of all text that an anchor's windows cover, and of where they begin."""
        out = np.empty(len(self.at), np.uint64)
        at = 0
        while at < len(self.at):
            stop = max(at + 1, int(np.searchsorted(self.low, self.low[at] + STRETCH)))
            base, end = int(self.low[at]), int(self.high[stop - 1]) + LENGTH
            running = RunningHash(text[base:end])
            low, high = self.low[at:stop] - base, self.high[at:stop] - base + LENGTH
            shape = ((self.at[at:stop] - self.low[at:stop]) << 32 | (high - low)).astype(np.uint64)
            out[at:stop] = mix(running.of(low, high) + shape * FACTOR)
            at = stop
        return out


def _anchors(row: dict) -> tuple[Anchors, np.ndarray, np.ndarray, np.ndarray]:
    """A part's anchors, its distinct (string, context) keys ascending by string, the first
    anchor of each, and the key of each anchor. Anchors are in order of id."""
    ids, sizes = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["sizes"], np.int64)
    found = Anchors(sizes, np.frombuffer(row["text"], np.uint8))
    order = np.lexsort((found.at, ids[found.text], found.context, found.gram))
    gram, context = found.gram[order], found.context[order]
    new = np.append(True, (gram[1:] != gram[:-1]) | (context[1:] != context[:-1]))[: len(order)]
    key = np.empty(len(order), np.int64)
    key[order] = np.cumsum(new) - 1
    return found, order[new], key, ids


def _ask_anchors(row: dict) -> tuple[np.ndarray, np.ndarray]:
    found, first, _, ids = _anchors(row)
    extra = np.stack([found.context[first], ids[found.text[first]].astype(np.uint64)], axis=1)
    return found.gram[first], extra


def _judge_anchors(bucket: int, keys: np.ndarray, extra: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Per key: settled if its context occurs earlier, open if its string has other contexts."""
    context, place = extra[:, 0], extra[:, 1].astype(np.int64)
    order = np.lexsort((place, context, keys))
    key, own = keys[order], context[order]
    new_key = np.append(True, key[1:] != key[:-1])[: len(key)]
    new_context = new_key | np.append(True, own[1:] != own[:-1])[: len(key)]
    group = np.cumsum(new_key) - 1
    several = np.bincount(group, new_context)[group] > 1 if len(key) else np.zeros(0, bool)
    out = np.empty(len(keys), np.uint8)
    out[order] = np.where(~new_context, SETTLED, np.where(several, OPEN, EMPTY))
    return out


def _runs(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches (begin, end) in ascending order, those that touch joined."""
    if not len(begin):
        return begin, end
    reach = np.maximum.accumulate(end)
    new = np.append(True, begin[1:] > reach[:-1])
    return begin[new], reach[np.append(np.flatnonzero(new)[1:], len(begin)) - 1]


def _settle(row: dict, told: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """Per text: removed spans so far, and the stretches that are left."""
    found, first, key, ids = _anchors(row)
    codes = _answers_of(found.gram[first], told, buckets)[key]
    # a later anchor of one key in this part follows an equal one
    later = np.ones(len(key), bool)
    later[first] = False
    codes = np.where(later, SETTLED, codes)
    sizes = np.frombuffer(row["sizes"], np.int64)
    base, text = np.cumsum(sizes) - sizes, row["text"]
    out = []
    for number in np.unique(found.text[codes != EMPTY]):
        own = slice(*np.searchsorted(found.text, [number, number + 1]))
        code, low, high = codes[own], found.low[own], found.high[own] + 1
        gone = _runs(low[code == SETTLED], high[code == SETTLED] + LENGTH - 1)
        left = _runs(low[code == OPEN], high[code == OPEN])
        stretches = [text[a : b + LENGTH - 1] for a, b in zip(*left, strict=True)]
        out.append(
            (
                int(ids[number]),
                (np.stack(gone, axis=1) - base[number]).tobytes(),
                (left[0] - base[number]).tobytes(),
                np.array([len(s) for s in stretches], np.int64).tobytes(),
                b"".join(stretches),
            )
        )
    return pd.DataFrame(out, columns=["place", "spans", "starts", "sizes", "text"])


def _answers_of(keys: np.ndarray, told: pd.DataFrame, buckets: int, kind: str = "uint8") -> np.ndarray:
    if not len(keys):
        return np.zeros(0, kind)
    return values_of(keys, told, buckets, kind)


@giving_back
def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches in parts, whose numbers rise with the place of their texts."""
    first, number, held, size = TaskContext.get().partitionId() << 32, 0, [], 0

    def part() -> pa.RecordBatch:
        ids = b"".join(np.full(len(h[2]) // 8, h[0], np.int64).tobytes() for h in held)
        values = [first + number, ids, *(b"".join(h[c] for h in held) for c in (1, 2, 3))]
        kinds = [pa.int64()] + [pa.binary()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip(values, kinds, strict=True)],
            names=["part", "ids", "starts", "sizes", "text"],
        )

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("place", "starts", "sizes", "text")), strict=True):
            if held and size + len(row[3]) > SEGMENT_PART:
                yield part()
                number, held, size = number + 1, [], 0
            held.append(row)
            size += len(row[3])
    if held:
        yield part()


def _room(row: dict) -> np.ndarray:
    """For each position of a part, the bytes to the end of its stretch."""
    sizes = np.frombuffer(row["sizes"], np.int64)
    return np.repeat(np.cumsum(sizes), sizes) - np.arange(sizes.sum())


def _sampled(row: dict, length: int) -> np.ndarray:
    """Positions of residue 1 or 2 modulo 3 with `length` bytes before them."""
    at = np.flatnonzero(_room(row) >= length)
    return at[at % 3 != 0]


def _triples(row: dict, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sampled positions of which a triple can repeat, and a key of each triple.

    `length` is what the triple covers; the first ones are of bytes, others of names."""
    at = _sampled(row, length)
    if row.get("names") is None:
        return at, RunningHash(np.frombuffer(row["text"], np.uint8)).of_length(length)[at] if len(at) else at.astype(np.uint64)
    names = np.frombuffer(row["names"], np.uint64)
    three = [names[at + k * (length // 3)] for k in range(3)]
    alive = (three[0] > 0) & (three[1] > 0) & (three[2] > 0)
    return at[alive], _joined([t[alive] for t in three])


def _joined(columns: list[np.ndarray]) -> np.ndarray:
    out = np.full(len(columns[0]), len(columns), np.uint64)
    for c in columns:
        out = mix(out * FACTOR + c.astype(np.uint64))
    return out


def _ask_once(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own, count = np.unique(keys, return_counts=True)
    return own, (count > 1).astype(np.uint8)


def _name(bucket: int, keys: np.ndarray, extra: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """The place of each key in the sorted bucket as its name, 0 if it occurs once."""
    own, at, count = np.unique(keys, return_inverse=True, return_counts=True)
    often = (count > 1) | (np.bincount(at, extra[:, 0], len(own)) > 0)
    names = np.where(often, (np.uint64(bucket) << np.uint64(40)) + np.arange(1, len(own) + 1, dtype=np.uint64), 0)
    return names.astype(np.uint64)[at]


def named(segments: DataFrame, length: int, buckets: int) -> DataFrame:
    """`segments` with `names`: of the `length` bytes from each sampled position, 0 for others."""
    asked = questions(segments, lambda row: _ask_once(_triples(row, length)[1]), buckets)
    told = answers(asked, _name, "uint8", 1)

    def take(part: tuple, rows: pd.DataFrame, values: pd.DataFrame) -> pd.DataFrame:
        give_back()  # what the group before left
        if not len(rows):
            return pd.DataFrame(columns=["part", "ids", "starts", "sizes", "text", "names"])
        row = rows.iloc[0].to_dict()
        at, keys = _triples(row, length)
        own, which = np.unique(keys, return_inverse=True)
        names = np.zeros(len(row["text"]), np.uint64)
        names[at] = _answers_of(own, values, buckets, "uint64")[which]
        columns = {c: [row[c]] for c in ("part", "ids", "starts", "sizes", "text")}
        return pd.DataFrame({**columns, "names": [names.tobytes()]})

    return segments.groupBy("part").cogroup(told.groupBy("part")).applyInPandas(take, f"{SEGMENTS}, names binary")


def _window_keys(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Positions of windows and their keys, one for each distance at which the window's
    residue is sampled; a key with a name that occurs once is left out."""
    text, names = np.frombuffer(row["text"], np.uint8), np.frombuffer(row["names"], np.uint64)
    windows = np.flatnonzero(_room(row) >= LENGTH)
    ats, keys = [], []
    for distance in range(3):
        at = windows[(windows + distance) % 3 != 0]
        last = distance + (LENGTH - NAMED - distance) // 3 * 3
        own = [names[at + d] for d in sorted({*range(distance, last, NAMED), last})]
        alive = np.all([n > 0 for n in own], axis=0)
        at = at[alive]
        marks = [*range(distance), *range(last + NAMED, LENGTH)]
        kind = np.full(len(at), distance, np.uint64)
        ats.append(at)
        keys.append(_joined([kind, *(n[alive] for n in own), *(text[at + m] for m in marks)]))
    return np.concatenate(ats), np.concatenate(keys)


def _ask_windows(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return _ask_once(_window_keys(row)[1])


def _earlier(bucket: int, keys: np.ndarray, extra: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Whether a part before its own holds the key; parts come in ascending order."""
    _, first, at = np.unique(keys, return_index=True, return_inverse=True)
    return (parts > parts[first][at]).astype(np.uint8)


def _repeated(row: dict, told: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """Per text, the spans of its windows that occur earlier."""
    at, keys = _window_keys(row)
    own, which = np.unique(keys, return_inverse=True)
    before = _answers_of(own, told, buckets).astype(bool)[which]
    # positions rise with the place of their texts, so a key's first one is the part's earliest
    earliest = np.full(len(own), np.iinfo(np.int64).max)
    np.minimum.at(earliest, which, at)
    at = np.unique(at[before | (at > earliest[which])])
    sizes, ids = np.frombuffer(row["sizes"], np.int64), np.frombuffer(row["ids"], np.int64)
    ends = np.cumsum(sizes)
    segment = np.searchsorted(ends, at, side="right")
    starts = np.frombuffer(row["starts"], np.int64)[segment] + at - (ends - sizes)[segment]
    place = ids[segment]
    out = []
    for part in np.split(np.arange(len(place)), np.flatnonzero(np.diff(place)) + 1) if len(place) else []:
        spans = _runs(starts[part], starts[part] + LENGTH)
        out.append((int(place[part[0]]), np.stack(spans, axis=1).tobytes()))
    return pd.DataFrame(out, columns=["place", "spans"])


def with_place(documents: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """`documents` with a number that rises in their order, and the distinct texts as `place`
    (that number) and `text`."""
    text = text_or_empty()
    if documents.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").isEmpty():
        rows = documents.withColumn(PLACE, F.col("doc_id").cast("long"))
        return rows, rows.select(F.col(PLACE).alias("place"), text.alias("text"))
    own = documents.withColumn("its digest", F.md5(text))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("its digest"), F.col("its digest")]
    keys = own.select("doc_id", "its digest").distinct()
    keys = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    places = scratch.store(
        keys.select(
            F.col("doc_id").alias("its id"),
            F.col("its digest").alias("same digest"),
            F.monotonically_increasing_id().alias(PLACE),
        ),
        "places",
    )
    same = F.col("doc_id").eqNullSafe(F.col("its id")) & (F.col("its digest") == F.col("same digest"))
    rows = own.join(places, same).select(*documents.columns, PLACE)
    return rows, rows.select(F.col(PLACE).alias("place"), text.alias("text")).dropDuplicates(["place"])


def repeats(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """`place` and `spans` (packed pairs of bytes, several rows a text) of all repeated bytes
    of distinct `texts`."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET))
    raw = texts.select("place", F.col("text").cast("binary").alias("text"))
    parts = scratch.store(raw.mapInArrow(packs, PARTS), "parts", TEXTS, large=True)

    told = answers(questions(parts, _ask_anchors, buckets), _judge_anchors, "uint64", 2)

    def settle(part: tuple, rows: pd.DataFrame, values: pd.DataFrame) -> pd.DataFrame:
        give_back()  # what the group before left
        if not len(rows):
            return pd.DataFrame(columns=["place", "spans", "starts", "sizes", "text"])
        return _settle(rows.iloc[0].to_dict(), values, buckets)

    found = parts.groupBy("part").cogroup(told.groupBy("part")).applyInPandas(settle, FOUND)
    found = scratch.store(found, "found", TEXTS, large=True)
    scratch.drop("parts")

    left = found.where("octet_length(text) > 0").select("place", "starts", "sizes", "text")
    left = left.repartitionByRange("place").sortWithinPartitions("place")
    segments = scratch.store(left.mapInArrow(_segments, SEGMENTS), "segments", TEXTS, large=True)
    size = segments.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // SEGMENT_BUCKET))
    length = FIRST
    while length <= NAMED:
        segments = scratch.store(named(segments, length, buckets), f"names-{length}", TEXTS, large=True)
        scratch.drop("segments", f"names-{length // 3}")
        length *= 3

    told = answers(questions(segments, _ask_windows, buckets), _earlier, "uint8", 1)

    def close(part: tuple, rows: pd.DataFrame, values: pd.DataFrame) -> pd.DataFrame:
        give_back()  # what the group before left
        if not len(rows):
            return pd.DataFrame(columns=["place", "spans"])
        return _repeated(rows.iloc[0].to_dict(), values, buckets)

    more = segments.groupBy("part").cogroup(told.groupBy("part")).applyInPandas(close, "place long, spans binary")
    return scratch.store(more.unionByName(found.select("place", "spans").where("octet_length(spans) > 0")), "spans", TEXTS, large=True)


def merged(spans: list[bytes] | None) -> np.ndarray:
    """All spans of a text as disjoint ascending (begin, end) rows."""
    pairs = np.frombuffer(b"".join(spans or []), np.int64).reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    return np.stack(_runs(pairs[:, 0], pairs[:, 1]), axis=1)


def _kept(text: bytes, spans: np.ndarray) -> bytes:
    ends = [0, *spans[:, 1].tolist()]
    return b"".join(text[a:b] for a, b in zip(ends, [*spans[:, 0].tolist(), len(text)], strict=True))


@giving_back
def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        rows = zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("spans").to_pylist(), strict=True)
        for doc_id, text, spans in rows:
            raw, pairs = text.as_py(), merged(spans)
            removed = int((pairs[:, 1] - pairs[:, 0]).sum())
            out.append((doc_id, len(raw), removed, len(pairs), hashlib.sha256(_kept(raw, pairs)).hexdigest()))
        columns = list(zip(*out, strict=True)) or [[]] * 5
        kinds = [pa.int64()] * 4 + [pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def _with_spans(documents: DataFrame, scratch: Scratch) -> DataFrame:
    """`documents` with `its spans`, all spans of repeated bytes of each."""
    rows, texts = with_place(documents, scratch)
    spans = repeats(texts, scratch).groupBy(F.col("place").alias(PLACE)).agg(F.collect_list("spans").alias("its spans"))
    return rows.join(spans, PLACE, "left").drop(PLACE)


def cut_bytes(documents: DataFrame, scratch: Scratch) -> DataFrame:
    """`doc_id`, `n_bytes`, `n_removed`, `n_spans` and `kept_sha256` of each document."""
    rows = _with_spans(documents.select("doc_id", "text"), scratch).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_or_empty().cast("binary").alias("text"),
        F.col("its spans").alias("spans"),
    )
    digests = rows.mapInArrow(
        _digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
    return scratch.store(digests, "digests", TEXTS)


@F.pandas_udf(T.StringType())
def _kept_text(texts: pd.Series, spans: pd.Series) -> pd.Series:
    """Texts without their spans; a character that a span cuts goes as a whole."""
    out = []
    for text, own in zip(texts, spans, strict=True):
        if own is None or not len(own):
            out.append(text)
            continue
        raw, pairs = text.encode("utf-8"), merged(list(own)).copy()
        inside = (np.frombuffer(raw + b" ", np.uint8) & 0xC0) == 0x80
        for side, step in ((0, -1), (1, 1)):
            for _ in range(3):
                pairs[:, side] += step * inside[pairs[:, side]]
        out.append(_kept(raw, np.stack(_runs(pairs[:, 0], pairs[:, 1]), axis=1)).decode("utf-8"))
    give_back()
    return pd.Series(out, dtype=object)


def without_repeats(documents: DataFrame, scratch: Scratch) -> DataFrame:
    """`documents` whose texts have lost what stands earlier, `n_chars` anew if there is such
    a column; a document of which nothing is left goes."""
    rows = _with_spans(documents, scratch).withColumn(
        "its rest", F.when(F.col("its spans").isNull(), F.col("text")).otherwise(_kept_text(text_or_empty(), "its spans"))
    )
    rows = rows.where("`its spans` IS NULL OR `its rest` <> ''")
    columns = {"text": F.col("its rest"), "n_chars": F.length("its rest").cast("long")}
    rest = rows.select(
        *[
            F.when(F.col("its spans").isNull(), F.col(c)).otherwise(columns[c]).alias(c) if c in columns else F.col(c)
            for c in documents.columns
        ]
    )
    return scratch.store(rest, "rest", TEXTS)
