"""Approximate nearest neighbours by a permutation index.

A few hundred vectors are drawn as pivots. A vector is represented by its ``PREFIX``
nearest pivots in order. The index is cut into blocks of candidates; in each block an
inverted file lists per pivot the vectors that have it among their nearest, with its
place. A query block meets every candidate block: the lists of a query's own nearest
pivots give the footrule distance (the sum of differences of places, a missing pivot
counting as place ``PREFIX``) of all vectors in the block; the nearest ``SHARE`` of the
block's distinct vectors by that distance, and all within ``NEAR`` of the largest
distance, are reranked by their true cosine, and the best ``k`` leave the task. The
share does not depend on the size of the data, nor does recall; a dense group is
reranked whole.

Copies of one vector are one entry of an inverted file and carry their smallest ids, so
they cannot crowd other vectors out.

Pivots are chosen from a bounded sample, the first ``8 * PIVOTS`` distinct vectors of
each length by hash: in that order, those that are not close to one chosen before, as
pivots that lie together would fill every permutation nearby with one and the same
run. The ``MOST_LENGTHS`` lengths with the most vectors (ties: the shorter) have pivots;
queries of other lengths are compared with all vectors of their length.

Odd rows: vectors that are null, empty, zero or hold null or non-finite components take
no part, nor do rows without ``vec_id``. Vectors meet those of their own length only. A
row is not its own candidate, nor is any row with its id. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .blocks import CANDIDATES, finite, matrix, met, packed, query_blocks

PIVOTS = 512
PREFIX = 64
SHARE = 0.12
NEAR = 0.5
#: Cosine from which a vector is too close to a pivot to be one.
CLOSE = 0.8
#: Distinct vectors of a block that are reranked at least.
LEAST = 64
MOST_LENGTHS = 64


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, x) with x as doubles, of the rows that take part."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    rows = rows.where(F.col("vec_id").isNotNull() & finite(F.col("embedding"))).select("vec_id", x.alias("x"))
    return rows.where(F.exists("x", lambda v: v != 0))


def pivots(rows: DataFrame) -> dict[int, np.ndarray]:
    """The pivots of each vector length, scaled to length 1."""
    drawn = rows.select(F.size("x").alias("dim"), F.pmod(F.xxhash64("x"), F.lit(1 << 40)).alias("draw"), "x")
    most = 8 * PIVOTS
    sizes = drawn.groupBy("dim").agg(F.approx_count_distinct("draw").alias("n")).orderBy(F.desc("n"), "dim").limit(MOST_LENGTHS).collect()
    if not sizes:
        return {}
    drawn = drawn.where(F.col("dim").isin([r["dim"] for r in sizes]))
    share = F.create_map(*(F.lit(v) for r in sizes for v in (r["dim"], min(1.0, 1.5 * most / r["n"]))))
    draw = W.partitionBy("dim").orderBy("draw", "x")
    first = (
        drawn.where(F.col("draw") < share[F.col("dim")] * float(1 << 40))
        .groupBy("dim", "draw")
        .agg(F.min("x").alias("x"))
        .withColumn("n", F.row_number().over(draw))
        .where(F.col("n") <= most)
    )
    found: dict[int, list] = {}
    for r in sorted(first.collect(), key=lambda r: r["n"]):
        found.setdefault(r["dim"], []).append(r["x"])
    return {dim: apart(unit(np.array(x))) for dim, x in found.items()}


def apart(x: np.ndarray) -> np.ndarray:
    """The first ``PIVOTS`` rows that are not close to an earlier one of them."""
    chosen = x[:1]
    for row in x[1:]:
        if len(chosen) < PIVOTS and (chosen @ row).max() < CLOSE:
            chosen = np.vstack((chosen, row))
    return chosen


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def permutations(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """The nearest pivots of each row, nearest first."""
    near = unit(x) @ points.T
    k = min(PREFIX, len(points))
    top = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return np.take_along_axis(top, np.argsort(-np.take_along_axis(near, top, 1), axis=1, kind="stable"), 1)


def inverted(orders: np.ndarray, n: int):
    """(start of each pivot's list, vectors, places): the inverted file of a block."""
    flat = orders.ravel()
    by_pivot = np.argsort(flat, kind="stable")
    starts = np.searchsorted(flat[by_pivot], np.arange(n + 1))
    return starts, by_pivot // orders.shape[1], by_pivot % orders.shape[1]


def footrule(order: np.ndarray, starts, vectors, places, n: int) -> np.ndarray:
    """Footrule distance of a query's permutation to every vector of a block, less
    what vectors without a common pivot have. A vector on a list stops counting as
    having the pivot in the last place."""
    length = len(order)
    lists = [slice(starts[p], starts[p + 1]) for p in order]
    rows = np.concatenate([vectors[s] for s in lists])
    gain = np.concatenate([np.abs(i - places[s]) - (length - i) - (length - places[s]) for i, s in enumerate(lists)])
    return np.bincount(rows, gain, n)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of one vector and rows; each row's sums are formed in the same way anywhere."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum(axis=1)))


def nearest(queries: DataFrame, candidates: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest candidates found for each query
    by cosine, ties to the smaller id, from rows (vec_id, embedding)."""
    rows = usable(candidates)
    points = pivots(rows)
    kind = candidates.schema["vec_id"].dataType.simpleString()
    ask, have = query_blocks(usable(queries)), packed(rows, CANDIDATES)

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                at = {name: batch.column(name)[row] for name in batch.schema.names}
                dim = at["q_dim"].as_py()
                x, y = matrix(at["q_data"], dim), matrix(at["c_data"], dim)
                ids, others = (at[c].values for c in ("q_ids", "c_ids"))
                own, other = (v.to_numpy(zero_copy_only=False) for v in (ids, others))
                y, entry = np.unique(y, axis=0, return_inverse=True)
                by_entry = np.lexsort((other, entry.ravel()))
                first = np.searchsorted(entry.ravel()[by_entry], np.arange(len(y) + 1))
                few = min(len(y), max(LEAST, int(np.ceil(SHARE * len(y)))))
                if dim in points:
                    lists = inverted(permutations(y, points[dim]), len(points[dim]))
                    largest = min(PREFIX, len(points[dim])) * (min(PREFIX, len(points[dim])) + 1)
                    orders = permutations(x, points[dim])
                query, found, score = [], [], []
                for i in range(len(x)):
                    near = np.arange(len(y))  # a rare length has no pivots
                    if dim in points:
                        apart_by = largest + footrule(orders[i], *lists, len(y))
                        limit = max(np.partition(apart_by, few - 1)[few - 1], NEAR * largest)
                        near = np.flatnonzero(apart_by <= limit)
                    cosine = cosines(x[i], y[near])
                    # own rows fill one entry at most, so k + 1 entries, and ties, are enough
                    at_k = min(k, len(near) - 1)
                    best = cosine >= -np.partition(-cosine, at_k)[at_k]
                    near, cosine = near[best], cosine[best]
                    taken = []
                    for c, e in zip(cosine, near, strict=True):
                        rows_of = by_entry[first[e] : first[e + 1]]
                        taken += [(-c, other[j], j) for j in rows_of[other[rows_of] != own[i]][:k]]
                    for c, _, j in sorted(taken)[:k]:
                        query.append(i)
                        found.append(j)
                        score.append(-c)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at["q_block"].as_py()] * len(query), pa.int64()), pa.array(query, pa.int64()), ids.take(pa.array(query, pa.int64())),
                     others.take(pa.array(found, pa.int64())), pa.array(score, pa.float64())],
                    names=["block", "place", "query_id", "vec_id", "score"],
                )

    found = met(ask, have).mapInArrow(run, f"block bigint, place bigint, query_id {kind}, vec_id {kind}, score double")
    rank = F.row_number().over(W.partitionBy("block", "place").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
