"""Packing into training sequences by tiers of context sizes.

A document's ids, and an end id, are cut into full windows of the largest tier; each is a
sequence. What is left, the rest, stays whole and is routed to the smallest tier that holds
it. A rest that fills its tier exactly is a sequence of that context size. Rests of the largest
tier open long windows, and the gaps are filled from ever shorter tiers, each rest into the
fullest window that still takes it. What no gap takes is packed tier by tier into windows of its
own tier, from the largest to the smallest: a rest and the one of its tier or a shorter one that
fills the window to its end. Since a short window that is not full would be padded to the largest
tier, rests without such a partner go into long windows like those before. Sequences of one
context size are then dealt into step groups of near equal attention cost.

Texts are tokenized once, in Arrow batches, where also the checksum of each piece is taken;
only lengths move. Pieces are packed in groups of about `GROUP`, dealt by hash and place in the
stored table, so no task holds more, however long a text or often a row is. Ids are those of the `tokenizers` vocabulary file; `tiktoken` with the same
vocabulary gives the same ids several times faster. Texts on which it does not are left to
`tokenizers` itself: those with the string of an added token, and those with runs of white space
that `tiktoken` would take time for that grows with their square. Strings of added tokens are taken as those tokens, as `tokenizers` does unless
told otherwise, or with `special=False` as plain text.

Defined cases. Null text: empty; it is packed as its end id alone. Repeated rows are packed
each. No rows: no pieces. Other columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import re
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import Scratch, text_or_empty

TIERS = (256, 512, 1024, 2048)
END, GROUP, STEP = 1, 8_000, 64
#: Texts that a Python worker is given at a time.
TEXTS = 512
#: How the vocabulary splits text before it merges; a fixed value.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Runs of white space that `tiktoken` is not given: it takes 0.4 s for a megabyte of runs of 200
#: blanks, 7 s for runs of 5,000, and fails on a million.
BLANKS = re.compile(r"\s{200}")
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = f"{PIECE}, sequence_id long, offset long, tier int, step long"


def encoder(ranks_path: str):  # noqa: ANN201
    """The vocabulary in `ranks_path` as an encoder, loaded once per Python worker."""
    import tiktoken
    from tiktoken import registry

    if ranks_path not in registry.ENCODINGS:
        with open(ranks_path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        registry.ENCODINGS[ranks_path] = tiktoken.Encoding(
            ranks_path, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}
        )
    return registry.ENCODINGS[ranks_path]


@functools.cache
def ids_of(ranks_path: str, special: bool) -> Callable[[str], np.ndarray]:
    """Ids of a text, as `tokenizers` gives them for the vocabulary file beside `ranks_path`."""
    import tokenizers

    fast = encoder(ranks_path)
    whole = tokenizers.Tokenizer.from_file(str(Path(ranks_path).with_suffix(".json")))
    whole.encode_special_tokens = not special
    added = [token.content for token in whole.get_added_tokens_decoder().values()]

    def ids(text: str) -> np.ndarray:
        if BLANKS.search(text) or any(token in text for token in added):
            return np.array(whole.encode(text, add_special_tokens=False).ids, np.uint32)
        return fast.encode_to_numpy(text, disallowed_special=())

    return ids


def cut(ids: np.ndarray, window: int) -> list[tuple[int, int, int]]:
    """(start, length, checksum) of the full windows of `ids` and of the rest."""
    ids = ids.astype("<u4")
    starts = range(0, len(ids), window)
    return [(s, min(window, len(ids) - s), zlib.crc32(ids[s : s + window].tobytes())) for s in starts]


def _pieces(batches: Iterator[pa.RecordBatch], ranks_path: str, window: int, special: bool) -> Iterator[pa.RecordBatch]:
    encode = ids_of(ranks_path, special)
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            ids = np.append(encode(text.as_py()), END)
            rows += [(doc_id, *piece, len(ids)) for piece in cut(ids, window)]
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


class Windows:
    """Open windows of one size by the gap that is left in them."""

    def __init__(self, size: int):
        self.size, self.by_gap = size, [[] for _ in range(size + 1)]
        #: has a bit for each gap that a window has
        self.gaps = 0

    def put(self, piece: int, own: int, gap: int) -> int:
        """The offset of a piece put into a gap of window `own`."""
        left = gap - piece
        if left:
            self.by_gap[left].append(own)
            self.gaps |= 1 << left
        return self.size - gap

    def fullest(self, piece: int) -> tuple[int, int] | None:
        """The window with the least gap that takes the piece, and that gap."""
        fitting = self.gaps >> piece
        if not fitting:
            return None
        gap = piece + (fitting & -fitting).bit_length() - 1
        own = self.by_gap[gap].pop()
        if not self.by_gap[gap]:
            self.gaps ^= 1 << gap
        return own, gap


def pack(lengths: np.ndarray, tiers: tuple[int, ...] = TIERS) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece; no sequence exceeds the largest tier."""
    window, half = tiers[-1], tiers[-2] if len(tiers) > 1 else 0
    sequence, offset = np.empty(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    long, opened = Windows(window), 0
    #: pieces of each size that no gap of the largest tier takes
    waiting: list[list[int]] = [[] for _ in range(window + 1)]

    def into_long(i: int, opens: bool) -> bool:
        nonlocal opened
        size = int(lengths[i])
        found = long.fullest(size)
        if found is None:
            if not opens:
                return False
            found, opened = (opened, window), opened + 1
        sequence[i], offset[i] = found[0], long.put(size, *found)
        return True

    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        if size in tiers:
            sequence[i], opened = opened, opened + 1
        elif not into_long(i, size > half):
            waiting[size].append(i)

    for tier in reversed(tiers[:-1]):
        for size in range(tier - 1, (tier - 1) // 2, -1):
            ones, others = waiting[size], waiting[tier - size]
            while ones and others and (ones is not others or len(ones) > 1):
                for i, at in ((ones.pop(), 0), (others.pop(), size)):
                    sequence[i], offset[i] = opened, at
                opened += 1

    for own in reversed(waiting):
        for i in own:
            into_long(i, True)
    return sequence, offset


def steps(sequence: np.ndarray, lengths: np.ndarray, tier: np.ndarray, size: int = STEP) -> np.ndarray:
    """A step group for each piece: sequences of one tier, from the costliest to the cheapest,
    are dealt forth and back over as many groups as `size` to a group needs."""
    own = pd.DataFrame({"sequence": sequence, "tier": tier, "cost": lengths.astype(float) ** 2})
    costs = own.groupby("sequence").agg(tier=("tier", "first"), cost=("cost", "sum"))
    costs = costs.sort_values(["tier", "cost"], ascending=[True, False], kind="stable")
    rank = costs.groupby("tier").cumcount().to_numpy()
    groups = -(-costs.groupby("tier")["cost"].transform("size").to_numpy() // size)
    lap, at = rank // groups, rank % groups
    step = np.where(lap % 2 == 0, at, groups - 1 - at)
    return pd.Series(step, index=costs.index).reindex(sequence).to_numpy()


def _pack_group(key: tuple, pieces: pd.DataFrame, tiers: tuple[int, ...]) -> pd.DataFrame:
    pieces = pieces.sort_values(["length", "doc_id", "start", "ids_crc32"], kind="stable").reset_index(drop=True)
    lengths = pieces["length"].to_numpy()
    sequence, offset = pack(lengths, tiers)
    filled = np.bincount(sequence, lengths).astype(np.int64)
    tier = np.where(np.isin(filled, tiers), filled, tiers[-1])[sequence].astype(np.int32)
    first = int(key[0]) << 32
    out = pieces.drop(columns="group")
    return out.assign(sequence_id=first + sequence, offset=offset, tier=tier, step=first + steps(sequence, lengths, tier))


def packed(
    documents: DataFrame, scratch: Scratch, ranks_path: str, tiers: tuple[int, ...] = TIERS, special: bool = False
) -> DataFrame:
    """The pieces of all documents: `start` and `length` in ids of the document, checksum,
    `sequence_id`, `offset` there, `tier` (its context size) and `step`."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    pieces = texts.mapInArrow(lambda batches: _pieces(batches, ranks_path, tiers[-1], special), PIECE)
    pieces = scratch.store(pieces, "pieces", TEXTS)
    groups = max(1, -(-pieces.count() // GROUP))
    # the place in the stored table tells repeated rows apart, and is the same for a task that runs again
    number = F.xxhash64("doc_id", "start", "ids_crc32", F.monotonically_increasing_id())
    dealt = pieces.withColumn("group", F.pmod(number, F.lit(groups)))

    def pack_group(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return _pack_group(key, group, tiers)

    return dealt.groupBy("group").applyInPandas(pack_group, PACKED)
