"""Exact top-k by inner product with block-at-a-time pruning.

Vectors are documents, their components terms. Documents lie in ranges; a range is cut into
blocks of similar vectors. A block has a forward index (its rows) and, per term, its
largest and smallest weight. Per query, blocks are ordered by the sum of the best each term
can add; they are scored in that order until the bound falls below the query's k-th score.
Each query block meets each range in one task, every range gives its own k best, and one
ranking of those gives the result, so no task holds more than a range and a query block.

Defined cases. A vector that is null, or holds a null or non-finite component, takes no
part, nor does a row without id. Of several rows with one id the smallest vector counts.
Vectors of fewer components count as zero in the others. Equal scores: smaller id first.
Fewer than k candidates: all. Scores beyond 64 bits: the nearest 64-bit number. Other
columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANGE, BLOCK, QUERIES = 8_192, 128, 1_024
#: Whole numbers up to here are exact in float64.
EXACT = 2.0**53


def quantised(embeddings: DataFrame, scale: int = 64) -> DataFrame:
    """`vec_id` and `terms` = floor(scale * component), whole vectors only."""
    usable = embeddings.select("vec_id", "embedding").where(
        "vec_id IS NOT NULL AND embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL "
        "AND NOT isnan(x) AND abs(x) < double('infinity'))"
    )

    def term(x):
        scaled = F.lit(float(scale)) * x.cast("double")
        # from 2^52 on a double is whole already
        return F.when(F.abs(scaled) < 2.0**52, F.floor(scaled).cast("double")).otherwise(
            F.greatest(F.least(scaled, F.lit(1e300)), F.lit(-1e300))
        )

    one = usable.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    return one.select("vec_id", F.transform("embedding", term).alias("terms"))


def _matrix(rows: pa.ListArray, width: int) -> np.ndarray:
    """Rows of numbers as a matrix, short rows filled with zeros."""
    lengths = rows.value_lengths().to_numpy(zero_copy_only=False)
    values = rows.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = values
    return out


def _blocks(rows: np.ndarray, size: int) -> list[np.ndarray]:
    """Row numbers in blocks of at most `size`, split at the median of the widest term."""
    todo, done = [np.arange(len(rows))], []
    while todo:
        part = todo.pop()
        if len(part) <= size:
            done.append(part)
            continue
        own = rows[part]
        widest = int(np.argmax(own.var(axis=0))) if own.shape[1] else 0
        order = np.argsort(own[:, widest], kind="stable") if own.shape[1] else np.arange(len(part))
        half = len(part) // 2
        todo += [part[order[:half]], part[order[half:]]]
    return done


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best per row: high score first, then small id."""
    if scores.shape[1] > 4 * k:
        # all that reach the k-th score, so ties are still there when ids decide
        kth = np.partition(scores, -k, axis=1)[:, -k]
        width = int((scores >= kth[:, None]).sum(axis=1).max())
        keep = np.argpartition(-scores, min(width, scores.shape[1]) - 1, axis=1)[:, :width]
    else:
        keep = np.broadcast_to(np.arange(scores.shape[1]), scores.shape)
    own_scores, own_ids = np.take_along_axis(scores, keep, 1), np.take_along_axis(ids, keep, 1)
    order = np.lexsort((own_ids, -own_scores), axis=1)[:, :k]
    return np.take_along_axis(keep, order, 1)


class RangeIndex:
    """Blocks of one range, with their term bounds."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, size: int = BLOCK):
        parts = _blocks(rows, size)
        self.ids = [ids[p] for p in parts]
        self.rows = [rows[p] for p in parts]
        self.high = np.array([r.max(axis=0) for r in self.rows])
        self.low = np.array([r.min(axis=0) for r in self.rows])

    def top(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores (-inf: none) of the k best of this range per query."""
        n, blocks = len(queries), len(self.rows)
        bounds = np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T
        order = np.argsort(-bounds, axis=1, kind="stable")
        best_ids = np.full((n, k), np.iinfo(np.int64).max)
        best = np.full((n, k), -np.inf)
        active = np.arange(n)
        for turn in range(blocks):
            block = order[active, turn]
            # a bound that equals the k-th score may still win by a smaller id
            going = bounds[active, block] >= best[active, -1]
            active, block = active[going], block[going]
            if not len(active):
                break
            by_block = np.argsort(block, kind="stable")
            for part in np.split(by_block, np.nonzero(np.diff(block[by_block]))[0] + 1):
                who, b = active[part], block[part[0]]
                scores = queries[who] @ self.rows[b].T
                ids = np.broadcast_to(self.ids[b], scores.shape)
                scores = np.where(ids == query_ids[who][:, None], -np.inf, scores)
                wins = (scores >= best[who, -1:]).any(axis=1)
                if not wins.any():
                    continue
                who, scores, ids = who[wins], scores[wins], ids[wins]
                all_ids, all_scores = np.hstack([best_ids[who], ids]), np.hstack([best[who], scores])
                top = _best(all_ids, all_scores, k)
                best_ids[who] = np.take_along_axis(all_ids, top, 1)
                best[who] = np.take_along_axis(all_scores, top, 1)
        return best_ids, best


def _saturated(scores: np.ndarray) -> list[int]:
    edge = 2**63
    return [max(-edge, min(edge - 1, int(s))) for s in scores]


def _exactly(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> list:
    """The k best where scores leave float64, in Python's own whole numbers."""
    whole = lambda m: [[int(x) for x in r] for r in m]
    edge = 2**63
    found, documents = [], whole(rows)
    for query_id, q in zip(query_ids.tolist(), whole(queries), strict=True):
        scores = [(-sum(a * b for a, b in zip(q, d, strict=True)), i) for d, i in zip(documents, ids.tolist(), strict=True)]
        best = heapq.nsmallest(k, (s for s in scores if s[1] != query_id))
        found += [(query_id, i, max(-edge, min(edge - 1, -s))) for s, i in best]
    return found


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            ids, terms, query_ids, query_terms = (batch.column(c)[at].values for c in range(4))
            width = max(0, *(compute.max(x.value_lengths()).as_py() for x in (terms, query_terms)))
            rows, queries = _matrix(terms, width), _matrix(query_terms, width)
            ids, query_ids = ids.to_numpy(), query_ids.to_numpy()
            largest = np.abs(rows).max(initial=0) * np.abs(queries).max(initial=0) * max(1, width)
            if largest < EXACT:
                best_ids, best = RangeIndex(ids, rows).top(query_ids, queries, k)
                q, rank = np.nonzero(best > -np.inf)
                out = [query_ids[q], best_ids[q, rank], best[q, rank].astype(np.int64)]
            else:
                found = _exactly(query_ids, queries, ids, rows, k)
                out = [[f[c] for f in found] for c in range(3)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in out], names=["query_id", "vec_id", "score"]
            )


def _packed(rows: DataFrame, size: int, n: int, prefix: str) -> DataFrame:
    """Rows as arrays, `size` to a row on average, dealt by a hash of the id."""
    parts = max(1, -(-n // size))
    return (
        rows.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(parts)))
        .groupBy("part")
        .agg(F.collect_list("vec_id").alias(f"{prefix}ids"), F.collect_list("terms").alias(f"{prefix}terms"))
        .withColumnRenamed("part", f"{prefix}part")
    )


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score` of the k best of `vectors` for each query.

    Both have `vec_id` and `terms`; a query never finds its own id.
    """
    n, asked = vectors.count(), queries.count()
    ranges, blocks = max(1, -(-n // RANGE)), max(1, -(-asked // QUERIES))
    documents = _packed(vectors, RANGE, n, "")
    asked_blocks = _packed(queries, QUERIES, asked, "query_").withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(ranges - 1).cast("long")))
    )
    pairs = documents.join(asked_blocks, "part").repartition(ranges * blocks, "part", "query_part")
    found = pairs.select("ids", "terms", "query_ids", "query_terms").mapInArrow(
        lambda batches: _search(batches, k), "query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
