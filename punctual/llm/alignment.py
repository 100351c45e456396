"""Which tokens of two tokenizers stand for the same bytes, and how often corpus-wide.

A text with a blank before it is cut by a byte-level vocabulary (A) and by a piece vocabulary
(B). The ends of both cuts part the bytes into segments; each lies in one token of A and one of
B and is a link of the two. Where both have an end, a group of tokens ends. A pair of ids counts
the documents that hold it linked.

1. Texts are tokenized once; ids go to a stored table as packed numbers.
2. Tasks gather the distinct pairs of their documents. They are united by bucket of the A id in
   a tree of at most `FAN` rows to a group, and each bucket's set gets a minimal perfect hash.
3. Tasks count documents in a dense vector over the numbers of that hash, without keys; vectors
   are summed by bucket in the same tree.
4. A second pass over the ids aligns the documents again and looks their links up; the key kept
   at the number must be the pair's.

The hashes of up to `HELD` pairs are broadcast at a time, so steps 3 and 4 take one pass over the
ids for each so many pairs; links fall into the passes by their A id, and sums add up. A bucket
has at most (A ids / `BUCKETS`) x (B ids) pairs, whatever the number of documents.

Defined cases. Null or empty text, and texts that do not come back from the bytes of their
tokens: no tokens, zeros and an empty digest. Repeated rows: each counts as a document. No rows:
none. Strings of special tokens are plain text. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import Scratch, give_back, giving_back, text_or_empty
from punctual.llm.packing import ids_of
from punctual.llm.perfect_hash import Bucket, Index, build

BUCKETS, FAN, HELD = 256, 32, 4_000_000
#: Texts that a Python worker is given at a time, and packed documents.
TEXTS, ROWS = 128, 128
#: Distinct pairs that a task gathers before it passes them on.
GATHERED = 2_000_000
IDS = "doc_id long, row long, a binary, b binary"
COUNTS = "n_a long, n_b long, n_groups long, n_links long"
ALIGNED = f"doc_id long, row long, {COUNTS}, n_best long, count_sum long, groups_sha256 string"


class Vocabularies:
    """The bytes of the tokens of both vocabularies, and their encoders."""

    def __init__(self, bytes_path: str, pieces_path: str):
        import sentencepiece
        import tokenizers

        # the ranks file lies beside the vocabulary
        self.encode_a = ids_of(bytes_path.removesuffix(".json") + ".tiktoken", False)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        # byte-level vocabularies write bytes that do not print as the code points from 256 on
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in printed}
        letters |= {chr(256 + at): b for at, b in enumerate(sorted(set(range(256)) - set(printed)))}
        entries = tokenizers.Tokenizer.from_file(bytes_path).get_vocab()
        self.a = [b""] * (max(entries.values()) + 1)
        for entry, number in entries.items():
            self.a[number] = bytes(letters[c] for c in entry) if set(entry) <= set(letters) else entry.encode()
        self.b = [self._piece(number) for number in range(self.pieces.get_piece_size())]

    def _piece(self, number: int) -> bytes:
        piece = self.pieces.id_to_piece(number)
        if self.pieces.is_byte(number):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of both for each text; none if either does not give its bytes back."""
        for text, b in zip(texts, self.pieces.encode(texts, num_threads=1), strict=True):
            raw = f" {text}"
            a = self.encode_a(raw) if text else None
            raw = raw.encode()
            # lists of plain numbers are walked several times faster than arrays
            own = a.tolist() if text else []
            whole = text and b"".join(map(self.a.__getitem__, own)) == raw == b"".join(map(self.b.__getitem__, b))
            yield (a, np.array(b)) if whole else (np.zeros(0, int), np.zeros(0, int))


class Sizes:
    """What aligning needs of the vocabularies: bytes of each token, and how ids are packed."""

    def __init__(self, both: Vocabularies):
        self.a = np.array([len(t) for t in both.a], np.int64)
        self.b = np.array([len(t) for t in both.b], np.int64)
        self.kind_a, self.kind_b = ("<u2" if len(x) <= 1 << 16 else "<u4" for x in (self.a, self.b))


class Aligned:
    """The links of a batch of documents: A token, B token and document of each segment."""

    def __init__(self, batch: pa.RecordBatch, sizes: Sizes):
        texts = [batch.column(name).to_pylist() for name in ("a", "b")]
        self.a, self.b = (
            np.frombuffer(b"".join(own), kind) for own, kind in zip(texts, (sizes.kind_a, sizes.kind_b), strict=True)
        )
        self.n_a, self.n_b = (
            np.array([len(x) for x in own], np.int64) // np.dtype(kind).itemsize
            for own, kind in zip(texts, (sizes.kind_a, sizes.kind_b), strict=True)
        )
        self.documents, self.partners = len(self.n_a), len(sizes.b)
        end_a, end_b = np.cumsum(sizes.a[self.a]), np.cumsum(sizes.b[self.b])
        ends = np.sort(np.concatenate([end_a, end_b]), kind="stable")
        ends = ends[np.append(ends[1:] != ends[:-1], True)] if len(ends) else ends
        self.at_a, self.at_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        #: whether a group ends with the segment
        self.shared = (end_a[self.at_a] == ends) & (end_b[self.at_b] == ends)
        self.document = np.repeat(np.arange(self.documents), self.n_a)[self.at_a]
        self.id_a = self.a[self.at_a].astype(np.int64)
        self.pair = self.id_a * self.partners + self.b[self.at_b]

    def pairs_by_document(self) -> np.ndarray:
        """The pairs, once for each document that holds them."""
        space = np.int64(1 << 36) if self.documents < 1 << 27 else None
        if space is None or (len(self.pair) and self.pair.max() >= space):
            both = np.unique(np.stack([self.document, self.pair]), axis=1)
            return both[1]
        return np.unique(self.document * space + self.pair) & (space - 1)

    def per_document(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.document, values, self.documents).astype(np.int64)

    def digests(self) -> list[str]:
        """sha256 of `a1,a2|b1;a3|b2,b3` for each document."""
        last = np.flatnonzero(self.shared)
        upto_a, upto_b = self.at_a[last] + 1, self.at_b[last] + 1  # tokens up to each group's end
        from_a = np.append(0, upto_a)[:-1]
        from_b = np.append(0, upto_b)[:-1]
        n_a, n_b = upto_a - from_a, upto_b - from_b
        # a group's tokens of A come first, then those of B
        place_a = np.arange(len(self.a)) + np.repeat(from_b, n_a)
        place_b = np.arange(len(self.b)) + np.repeat(upto_a, n_b)
        cells = np.zeros((len(self.a) + len(self.b), DIGITS.shape[1] + 1), np.uint8)
        cells[place_a, :-1] = DIGITS[self.a]
        cells[place_b, :-1] = DIGITS[self.b]
        cells[:, -1] = ord(",")
        cells[place_a[upto_a - 1], -1] = ord("|")
        cells[place_b[upto_b - 1], -1] = ord(";")
        ends = np.cumsum(self.n_a + self.n_b)
        full = ends[(self.n_a + self.n_b) > 0]
        cells[full - 1, -1] = 0
        length = np.ones(len(cells), np.int64)
        length[place_a] += LENGTHS[self.a]
        length[place_b] += LENGTHS[self.b]
        length[full - 1] -= 1
        written = np.append(0, np.cumsum(length))[np.append(0, ends)]
        text = cells[cells != 0].tobytes()
        return [hashlib.sha256(text[x:y]).hexdigest() if y > x else "" for x, y in zip(written, written[1:], strict=False)]


def _digits() -> np.ndarray:
    """The decimal digits of the ids below 100,000, zeros (no digit) before them."""
    ids = np.arange(100_000)[:, None] // 10 ** np.arange(4, -1, -1)
    out = (ids % 10 + ord("0")) * (ids > 0)
    out[0, -1] = ord("0")
    return out.astype(np.uint8)


DIGITS = _digits()
LENGTHS = np.count_nonzero(DIGITS, axis=1)


def _ids(batches: Iterator[pa.RecordBatch], paths: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    both = Vocabularies(*paths)
    sizes, row = Sizes(both), TaskContext.get().partitionId() << 40
    for batch in batches:
        found = list(both.encode(batch.column("text").to_pylist()))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(np.arange(row, row + len(found))),
                pa.array([a.astype(sizes.kind_a).tobytes() for a, _ in found], pa.binary()),
                pa.array([b.astype(sizes.kind_b).tobytes() for _, b in found], pa.binary()),
            ],
            names=["doc_id", "row", "a", "b"],
        )
        row += len(found)


def _bucket_rows(bucket: np.ndarray, starts: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    """A row of bytes for each bucket; `starts` has one place more than `bucket`."""
    node = np.full(len(bucket), TaskContext.get().partitionId())
    parts = [values[a:b].tobytes() for a, b in zip(starts, starts[1:], strict=False)]
    columns = [pa.array(bucket, pa.int64()), pa.array(node, pa.int64()), pa.array(parts, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "node", "values"])


PACKED = "bucket long, node long, values binary"


def _distinct(batches: Iterator[pa.RecordBatch], sizes: Sizes) -> Iterator[pa.RecordBatch]:
    """The distinct pairs of a task, by bucket."""
    held: list[np.ndarray] = []

    def rows() -> pa.RecordBatch:
        pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *held]))
        bucket = pairs // len(sizes.b) % BUCKETS
        order = np.argsort(bucket, kind="stable")
        found, starts = np.unique(bucket[order], return_index=True)
        return _bucket_rows(found, np.append(starts, len(pairs)), pairs[order].astype(np.uint64))

    for batch in batches:
        held.append(np.unique(Aligned(batch, sizes).pair))
        if sum(map(len, held)) > 2 * GATHERED:
            held[:] = [np.unique(np.concatenate(held))]
            if len(held[0]) > GATHERED:
                yield rows()
                held.clear()
    yield rows()


def tree(rows: DataFrame, join: Callable[[list[bytes]], np.ndarray], scratch: Scratch, name: str, nodes: int) -> DataFrame:
    """One row for each bucket: `join` of the values of at most about `FAN` nodes at a time."""

    def joined(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        values = join(list(group["values"])).tobytes()
        give_back()
        return pd.DataFrame({"bucket": [key[0]], "node": [key[1]], "values": [values]})

    level = 0
    while level == 0 or nodes > 1:
        own = rows.withColumn("node", F.expr(f"node DIV {FAN}"))
        rows = scratch.store(own.groupBy("bucket", "node").applyInPandas(joined, PACKED), f"{name}-{level}")
        nodes, level = -(-nodes // FAN), level + 1
    return rows


def _united(values: list[bytes]) -> np.ndarray:
    return np.unique(np.frombuffer(b"".join(values), np.uint64))


def _summed(values: list[bytes]) -> np.ndarray:
    return np.sum([np.frombuffer(v, np.int64) for v in values], axis=0)


HASHED = "bucket long, n long, sizes binary, bits binary, keys binary"


def _hashes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for bucket, values in zip(frame["bucket"], frame["values"], strict=True):
            found = build(np.frombuffer(values, np.uint64))
            parts = [found.sizes.tobytes(), np.packbits(found.bits).tobytes(), found.keys.tobytes()]
            yield pd.DataFrame([[bucket, len(found.keys), *parts]], columns=["bucket", "n", "sizes", "bits", "keys"])


class Slice:
    """The hashes of some buckets in arrays that a task looks pairs up in."""

    def __init__(self, rows: list[dict], partners: int):
        self.buckets, self.partners = [r["bucket"] for r in rows], partners
        parts = []
        for r in rows:
            sizes = np.frombuffer(r["sizes"], np.int64)
            bits = np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=int(sizes.sum())).astype(bool)
            parts.append(Bucket(sizes, bits, np.frombuffer(r["keys"], np.uint64)))
        self.index = Index(parts)
        self.place = np.full(BUCKETS, -1)
        self.place[self.buckets] = np.arange(len(rows))

    def numbers(self, pairs: np.ndarray) -> np.ndarray:
        """The number of each pair, -1 for pairs of other slices."""
        place = self.place[pairs // self.partners % BUCKETS]
        out = np.full(len(pairs), -1, np.int64)
        mine = place >= 0
        keys = pairs[mine].astype(np.uint64)
        out[mine] = self.index.verified(keys, self.index.numbers(keys, place[mine]))
        return out


def _slices(hashes: DataFrame) -> list[list[int]]:
    """Buckets in groups of at most `HELD` pairs, but one bucket at least; one group if none."""
    out: list[list[int]] = [[]]
    held = 0
    for bucket, n in hashes.select("bucket", "n").orderBy("bucket").collect():  # at most BUCKETS rows
        if out[-1] and held + n > HELD:
            out.append([])
            held = 0
        out[-1].append(bucket)
        held += n
    return out


def _rows_of(table: DataFrame, buckets: list[int]) -> list[dict]:
    return [r.asDict() for r in table.where(F.col("bucket").isin(buckets)).orderBy("bucket").collect()]


def counted(ids: DataFrame, sizes: Sizes, scratch: Scratch) -> tuple[DataFrame, list[list[int]]]:
    """The hashes with the `counts` of their pairs and whether a count is the `best` of the A id;
    and the buckets that are held together."""
    spark, nodes = ids.sparkSession, max(1, ids.rdd.getNumPartitions())
    pairs = scratch.store(ids.mapInArrow(giving_back(lambda batches: _distinct(batches, sizes)), PACKED), "pairs", ROWS)
    united = tree(pairs, _united, scratch, "united", nodes)
    hashes = scratch.store(united.mapInPandas(_hashes, HASHED), "hashes", 1)
    slices, partners = _slices(hashes), len(sizes.b)
    counts = None
    for number, buckets in enumerate(slices):
        shared = spark.sparkContext.broadcast(_rows_of(hashes, buckets))

        def vectors(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            own = Slice(shared.value, partners)
            first = own.index.first
            vector = np.zeros(first[-1], np.int64)
            for batch in batches:
                found = own.numbers(Aligned(batch, sizes).pairs_by_document())
                vector += np.bincount(found[found >= 0], minlength=len(vector))
            yield _bucket_rows(np.array(own.buckets, np.int64), first, vector)

        rows = scratch.store(ids.mapInArrow(giving_back(vectors), PACKED), f"vectors-{number}", ROWS)
        summed = tree(rows, _summed, scratch, f"summed-{number}", nodes)
        counts = summed if counts is None else counts.unionByName(summed)

    def with_best(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame(columns=["bucket", "n", "sizes", "bits", "keys", "counts", "best"])
        own = np.frombuffer(right["values"][0], np.int64)
        number = (np.frombuffer(left["keys"][0], np.uint64) // np.uint64(partners)).astype(np.int64) // BUCKETS
        most = np.zeros(number.max(initial=-1) + 1, np.int64)
        np.maximum.at(most, number, own)
        return left.assign(counts=[own.tobytes()], best=[np.packbits(own == most[number]).tobytes()])

    both = hashes.groupBy("bucket").cogroup(counts.groupBy("bucket"))
    return scratch.store(both.applyInPandas(with_best, f"{HASHED}, counts binary, best binary"), "counted"), slices


def aligned(documents: DataFrame, scratch: Scratch, bytes_path: str, pieces_path: str) -> DataFrame:
    """A row for each document with its numbers of tokens, groups and links, how many links have
    the best count of their A id, the sum of the counts, and a digest of the groups."""
    spark, paths = documents.sparkSession, (bytes_path, pieces_path)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    ids = scratch.store(texts.mapInArrow(giving_back(lambda batches: _ids(batches, paths)), IDS), "ids", TEXTS)
    sizes = Sizes(Vocabularies(*paths))
    table, slices = counted(ids, sizes, scratch)
    partners, parts = len(sizes.b), []
    for number, buckets in enumerate(slices):
        shared = spark.sparkContext.broadcast(_rows_of(table, buckets))

        def looked_up(batches: Iterator[pa.RecordBatch], shared=shared, first=not number) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            own = Slice(shared.value, partners)
            counts = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(r["counts"], np.int64) for r in shared.value)])
            best = [np.unpackbits(np.frombuffer(r["best"], np.uint8), count=r["n"]) for r in shared.value]
            # the last stands for pairs of other slices
            counts, best = np.append(counts, 0), np.concatenate([*best, [0]])
            for batch in batches:
                links = Aligned(batch, sizes)
                found = own.numbers(links.pair)
                none = np.zeros(links.documents, np.int64)
                plain = [
                    links.n_a,
                    links.n_b,
                    links.per_document(links.shared),
                    np.bincount(links.document, minlength=links.documents),
                ]
                figures = [*(plain if first else [none] * 4), links.per_document(best[found])]
                total = np.zeros(links.documents, np.int64)
                np.add.at(total, links.document, counts[found])
                digests = links.digests() if first else [""] * links.documents
                columns = [batch.column("doc_id"), batch.column("row"), *map(pa.array, [*figures, total]), pa.array(digests)]
                names = [c.split()[0] for c in ALIGNED.split(", ")]
                yield pa.RecordBatch.from_arrays([c.cast(k) for c, k in zip(columns, KINDS, strict=True)], names=names)

        parts.append(scratch.store(ids.mapInArrow(giving_back(looked_up), ALIGNED), f"aligned-{number}", ROWS))
    out = parts[0]
    if len(parts) > 1:
        for part in parts[1:]:
            out = out.unionByName(part)
        sums = [F.sum(c).alias(c) for c in "n_a n_b n_groups n_links n_best count_sum".split()]
        out = out.groupBy("doc_id", "row").agg(*sums, F.max("groups_sha256").alias("groups_sha256"))
    return out.drop("row")


KINDS = [pa.int64()] * 8 + [pa.string()]
