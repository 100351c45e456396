"""Questions about 64-bit keys across all tasks, asked and answered in packed arrays.

The state of a computation is a table of parts, rows that hold the arrays of some documents.
A part asks about its distinct keys: they go out by bucket of the key, one row of bytes per
part and bucket. A bucket's task sees each key once per part, however often it occurs there,
and answers in the order of the question; the answers go back to the part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from punctual.llm.common import give_back, giving_back

PARTS = "part long, ids binary, sizes binary, text binary"
#: Text bytes that a part holds, about.
PART = 4 << 20
QUESTION = "bucket long, part long, keys binary, extra binary"
ANSWER = "part long, bucket long, values binary"

#: part as a row -> its keys (distinct, ascending) and a row of numbers for each
Ask = Callable[[dict], tuple[np.ndarray, np.ndarray]]
#: bucket, keys and rows of numbers in ascending order of parts, part of each -> answers
Answer = Callable[[int, np.ndarray, np.ndarray, np.ndarray], np.ndarray]

FACTOR = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(FACTOR), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """64 bits scrambled."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class RunningHash:
    """Hashes of any stretches of a byte array."""

    def __init__(self, raw: np.ndarray):
        up, self.down = np.full(len(raw), FACTOR), np.full(len(raw) + 1, INVERSE)
        up[:1], self.down[:1] = 1, 1
        np.multiply.accumulate(up, out=up)
        np.multiply.accumulate(self.down, out=self.down)
        up *= raw.astype(np.uint64) + np.uint64(1)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(up, out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def of_length(self, length: int) -> np.ndarray:
        """Of each stretch of `length` bytes, by its start."""
        return mix((self.sums[length:] - self.sums[:-length]) * self.down[: len(self.sums) - length])


@giving_back
def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of `place` and `text` (bytes) in parts of about `PART` bytes."""
    first, number = TaskContext.get().partitionId() << 32, 0
    ids, texts, held = [], [], 0

    def part() -> pa.RecordBatch:
        sizes = np.array([len(t) for t in texts], np.int64)
        values = [[first + number], [np.array(ids, np.int64).tobytes()], [sizes.tobytes()], [b"".join(texts)]]
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=["part", "ids", "sizes", "text"]
        )

    for batch in batches:
        for place, text in zip(batch.column("place").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if ids and held + len(text) > PART:
                yield part()
                number, ids, texts, held = number + 1, [], [], 0
            ids.append(place)
            texts.append(text)
            held += len(text)
    if ids:
        yield part()


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


def _by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of the keys by bucket, the buckets that occur and where each begins."""
    own = bucket_of(keys, buckets)
    order = np.argsort(own, kind="stable")
    found, first = np.unique(own[order], return_index=True)
    return order, found, np.append(first, len(keys))


def questions(parts: DataFrame, ask: Ask, buckets: int) -> DataFrame:
    @giving_back
    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
                keys, extra = ask(row)
                order, found, first = _by_bucket(keys, buckets)
                keys, extra = keys[order], extra[order]
                ends = list(zip(first[:-1], first[1:], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found, pa.int64()),
                        pa.array(np.full(len(found), row["part"]), pa.int64()),
                        pa.array([keys[a:b].tobytes() for a, b in ends], pa.binary()),
                        pa.array([extra[a:b].tobytes() for a, b in ends], pa.binary()),
                    ],
                    names=["bucket", "part", "keys", "extra"],
                )

    return parts.mapInArrow(out, QUESTION)


def answers(asked: DataFrame, answer: Answer, kind: str, width: int) -> DataFrame:
    """Answers per part and bucket; the rows of numbers have `width` values of type `kind`."""

    def out(bucket: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part", kind="stable")
        keys = np.frombuffer(b"".join(rows["keys"]), np.uint64)
        extra = np.frombuffer(b"".join(rows["extra"]), kind).reshape(len(keys), width)
        sizes = np.array([len(k) // 8 for k in rows["keys"]])
        values = answer(int(bucket[0]), keys, extra, np.repeat(rows["part"].to_numpy(), sizes))
        ends = np.append(0, np.cumsum(sizes))
        del keys, extra
        give_back()
        return pd.DataFrame(
            {
                "part": rows["part"].to_numpy(),
                "bucket": rows["bucket"].to_numpy(),
                "values": [values[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)],
            }
        )

    return asked.groupBy("bucket").applyInPandas(out, ANSWER)


def values_of(keys: np.ndarray, rows: pd.DataFrame, buckets: int, kind: str) -> np.ndarray:
    """The answer for each of a part's distinct ascending keys."""
    order, _, _ = _by_bucket(keys, buckets)
    rows = rows.sort_values("bucket", kind="stable")
    out = np.empty(len(keys), kind)
    out[order] = np.frombuffer(b"".join(rows["values"]), kind)
    return out
