"""Quality classifier: a factorisation machine over hashed words and structure.

A document's features are its words, hashed to buckets with weights of length one, and a few
figures of its structure. The score is the logistic of

    w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2),

the second-degree interactions of all pairs in time linear in the features. It is fitted on
a bounded sample of the labelled documents that are not held out (`SAMPLE` ids, the first by
a hash of the id, with one row each), with Adam on the driver; scoring runs over all documents in Arrow batches,
whole texts, and needs no shuffle. Labels, language, source and id are never features.

Defined cases. Null text: the empty text, which has no words and zero structure and gets the
score of that. Documents with several labels: the lowest counts. Ids that occur several times:
the row of the lowest hash of its text is learned. No usable labels: every score is 0.5.
Repeated rows: scored alike. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import BATCH, setting, text_or_empty

BUCKETS, FACTORS, SAMPLE, EPOCHS = 1 << 13, 8, 8_000, 8
#: Examples of a step; a small sample is seen more often, for so many steps in all.
STEP, STEPS = 128, 400
FOLDS, THRESHOLD = 5, 0.3
#: Texts that a Python worker is given at a time.
TEXTS = 512
FEATURE_TYPE = "index array<int>, value array<float>"

#: Bytes by kind: capitals, digits, blanks, line ends, sentence marks, other ASCII marks.
_KINDS = [
    range(65, 91),
    range(48, 58),
    [9, 32],
    [10, 13],
    [33, 44, 46, 63],
    [b for b in range(33, 127) if not (chr(b).isalnum() or b in (33, 44, 46, 63))],
]
KIND_OF = np.zeros((256, len(_KINDS)), dtype=np.float32)
for _at, _kind in enumerate(_KINDS):
    KIND_OF[list(_kind), _at] = 1.0
STRUCTURE = len(_KINDS) + 7


def held_out(row_id: Column) -> Column:
    return F.crc32(row_id.cast("string").cast("binary")) % FOLDS == 0


def _structure(text: bytes, words: list[bytes], hashes: np.ndarray) -> np.ndarray:
    """Shares and logarithms, each about 0 to 1."""
    out = np.zeros(STRUCTURE, dtype=np.float32)
    if not words:
        return out
    n, kinds = len(words), len(_KINDS)
    counts = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    out[:kinds] = counts @ KIND_OF / len(text)
    lines = text.split(b"\n")
    out[kinds:] = [
        np.log1p(n) / 10,
        min(1.0, len(text) / n / 20),
        len(np.unique(hashes)) / n,
        float(np.mean(hashes[1:] == hashes[:-1])) if n > 1 else 0.0,
        len(set(lines)) / len(lines),
        sum(w.isupper() for w in words) / n,
        sum(w[-1] < 128 and not w[-1:].isalnum() for w in words) / n,
    ]
    return out


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value) of all texts; structure comes after the buckets."""
    rows, index, value = [], [], []
    for at, text in enumerate(texts):
        raw = text.encode("utf-8", "surrogatepass")
        words = raw.split()
        hashes = np.fromiter(map(zlib.crc32, words), dtype=np.int64, count=len(words))
        bucket, count = np.unique(hashes % BUCKETS, return_counts=True)
        weight = np.log1p(count).astype(np.float32)
        figures = _structure(raw, words, hashes)
        index += [bucket, np.arange(BUCKETS, BUCKETS + STRUCTURE)]
        value += [weight / max(1e-6, float(np.sqrt((weight**2).sum()))), figures]
        rows.append(np.full(len(bucket) + STRUCTURE, at))
    join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
    return join(rows, np.int64), join(index, np.int64), join(value, np.float32)


@dataclass
class Model:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def score(self, rows: np.ndarray, index: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        """Probability of label 1 for each of `n` rows; `rows` is sorted and names each row."""
        if not n:
            return np.zeros(0)
        starts = np.searchsorted(rows, np.arange(n))
        own = self.factors[index] * value[:, None]
        sums = np.add.reduceat(own, starts, axis=0)
        squares = np.add.reduceat((own * own).sum(axis=1), starts)
        straight = np.add.reduceat(self.linear[index] * value, starts)
        margin = self.bias + straight + 0.5 * ((sums * sums).sum(axis=1) - squares)
        return 1.0 / (1.0 + np.exp(-np.clip(margin.astype(np.float64), -30, 30)))


def untrained() -> Model:
    size = BUCKETS + STRUCTURE
    return Model(0.0, np.zeros(size, np.float32), np.zeros((size, FACTORS), np.float32))


class Adam:
    """Adam steps on one array."""

    def __init__(self, shape, rate: float):
        self.mean, self.square, self.rate, self.step = np.zeros(shape), np.zeros(shape), rate, 0

    def __call__(self, gradient: np.ndarray) -> np.ndarray:
        self.step += 1
        self.mean += 0.1 * (gradient - self.mean)
        self.square += 0.001 * (gradient * gradient - self.square)
        mean, square = self.mean / (1 - 0.9**self.step), self.square / (1 - 0.999**self.step)
        return self.rate * mean / (np.sqrt(square) + 1e-8)


def fit(examples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS) -> Model:
    """A model for (feature, value) arrays with labels 0 and 1; the same for the same input."""
    model = untrained()
    if not len(examples):
        return model
    random = np.random.default_rng(7)
    model.factors = random.normal(0, 0.05, model.factors.shape).astype(np.float32)
    share = np.clip(labels.mean(), 0.02, 0.98)
    model.bias = float(np.log(share / (1 - share)))
    steps = [Adam((), 0.05), Adam(model.linear.shape, 0.05), Adam(model.factors.shape, 0.02)]
    size = len(model.linear)
    for _ in range(max(epochs, -(-STEPS * STEP // len(examples)))):
        order = random.permutation(len(examples))
        for chosen in np.array_split(order, max(1, len(order) // STEP)):
            index = np.concatenate([examples[i][0] for i in chosen]).astype(np.int64)
            value = np.concatenate([examples[i][1] for i in chosen]).astype(np.float32)
            rows = np.repeat(np.arange(len(chosen)), [len(examples[i][0]) for i in chosen])
            error = (model.score(rows, index, value, len(chosen)) - labels[chosen]) / len(chosen)
            own = model.factors[index] * value[:, None]
            sums = np.add.reduceat(own, np.searchsorted(rows, np.arange(len(chosen))), axis=0)
            pull = error[rows] * value
            slope = (pull[:, None] * (sums[rows] - own)).astype(np.float64)
            factors = np.stack([np.bincount(index, slope[:, f], size) for f in range(FACTORS)], axis=1)
            linear = np.bincount(index, pull, size) + 1e-5 * model.linear
            model.bias -= float(steps[0](error.sum()))
            model.linear = (model.linear - steps[1](linear)).astype(np.float32)
            model.factors = (model.factors - steps[2](factors + 1e-5 * model.factors)).astype(np.float32)
    return model


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        rows, index, value = features(texts)
        offsets = pa.array(np.searchsorted(rows, np.arange(len(texts) + 1)), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("label"),
                pa.ListArray.from_arrays(offsets, pa.array(index, pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(value, pa.float32())),
            ],
            names=["label", "index", "value"],
        )


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from at most `sample` labelled documents outside the held-out fold."""
    usable = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(~held_out(F.col("doc_id")))
    chosen = (
        usable.groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    texts = documents.select("doc_id", text_or_empty().alias("text"))
    # at most `sample` ids and labels; then one row of each id, so no id takes the place of others
    labelled = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label")
    labelled = labelled.agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("least")).select("label", "least.text")
    with setting(documents.sparkSession, BATCH, str(TEXTS)):
        rows = labelled.mapInArrow(_sample_features, f"label int, {FEATURE_TYPE}").toArrow()
    flat = lambda name: rows.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(rows.column("index").combine_chunks().value_lengths().to_numpy(zero_copy_only=False))[:-1]
    found = zip(np.split(flat("index"), ends), np.split(flat("value"), ends), rows.column("label").to_pylist(), strict=True)
    # rows come in any order
    examples = sorted(found, key=lambda e: (e[2], len(e[0]), e[0].tobytes())) if rows.num_rows else []
    return fit([e[:2] for e in examples], np.array([e[2] for e in examples], dtype=np.float64))


def scored(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`documents` with `score`; a column of that name is replaced."""
    # arrays only: broadcasts are read where this package may be absent
    shared = documents.sparkSession.sparkContext.broadcast((model.bias, model.linear, model.factors))
    kept = documents.drop("score")

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        values, own_model = texts.fillna("").tolist(), Model(*shared.value)
        parts = []
        for at in range(0, len(values), 256):
            own = values[at : at + 256]
            parts.append(own_model.score(*features(own), len(own)))
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return kept.withColumn("score", score(F.col(text)))


def judged(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """`documents` with `held_out`, `score` and `predicted` (1: keep)."""
    rows = scored(documents.drop("held_out", "predicted"), train(documents, labels))
    return rows.withColumn("held_out", F.coalesce(held_out(F.col("doc_id")), F.lit(False))).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )
