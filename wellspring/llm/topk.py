"""Exact top-k search by histogram selection.

The score of a query and a candidate is the inner product of their vectors, whose
components are floor(256 * x) as integers. Queries and candidates are packed into
blocks and every block of one meets every block of the other. Each round scores
everything, and gathers for every query a histogram of scores within the range that
still may hold its kth value; the cell that holds it is the next round's range, until
it is one integer wide. A last pass keeps the scores above the kth value and, of those
equal to it, the smallest ids.

A block reports only cells at or above its own kth score, since the kth value of all
scores is no lower, and of scores equal to the kth value its k smallest ids: both
leave the result as it is, and keep what a block sends at about 2 k rows per query
however many copies of a vector there are.

Odd rows: vectors that are null, empty or hold null or non-finite components take no
part, nor do rows without ``vec_id``. Vectors meet those of their own length only. A
row is not its own candidate, nor is any row with its id. Query rows that repeat an id
are answered each by itself, so equal ones give equal rows. Components beyond 64 bits
are set to the nearest 64-bit integer, scores beyond +-(2^62 - 1) to that bound. Other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .blocks import CANDIDATES, finite, matrix, met, packed, query_blocks
from .common import stored

CELLS = 1024
#: Query rows scored at a time.
TOGETHER = 128
LARGEST = (1 << 62) - 1


def quantized(rows: DataFrame) -> DataFrame:
    """(vec_id, x) with x as 64-bit integers, of the rows that take part."""
    x = F.transform("embedding", lambda v: F.floor(v.cast("double") * 256))
    return rows.where(F.col("vec_id").isNotNull() & finite(F.col("embedding"))).select("vec_id", x.alias("x"))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows, exact."""
    bound = a.shape[1] * int(max(abs(int(a.min())), int(a.max()))) * int(max(abs(int(b.min())), int(b.max())))
    if bound < 1 << 53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    if bound <= LARGEST:
        return a @ b.T
    return np.clip(a.astype(object) @ b.T.astype(object), -LARGEST, LARGEST).astype(np.int64)


def scores(batch: pa.RecordBatch, k: int):
    """Per row of met blocks and run of queries: (the row, query positions, candidate
    ids, scores, whether a score counts, the kth score of each query in this block).
    A query's scores with its own id do not count."""
    for i in range(batch.num_rows):
        at = {name: batch.column(name)[i] for name in batch.schema.names}
        dim = at["q_dim"].as_py()
        queries, candidates = matrix(at["q_data"], dim, np.int64), matrix(at["c_data"], dim, np.int64)
        ids, others = (at[c].values.to_numpy(zero_copy_only=False) for c in ("q_ids", "c_ids"))
        for start in range(0, len(queries), TOGETHER):
            part = slice(start, start + TOGETHER)
            s, own = products(queries[part], candidates), ids[part, None] == others[None, :]
            at_k = max(0, len(others) - k)
            kth = np.partition(np.where(own, -LARGEST - 1, s), at_k, axis=1)[:, at_k]
            yield at, part, others, s, ~own, kth


def lows(at: dict, part: slice) -> np.ndarray:
    return at["q_lows"].values.to_numpy(zero_copy_only=False)[part, None]


def histograms(pairs: DataFrame, k: int, span: int, width: int) -> DataFrame:
    """(q_block, place, cell, n): scores at or above each block's own kth score that lie
    in the ``span`` integers from the query's ``lows`` on, by cells of ``width``."""

    def run(batches):
        for batch in batches:
            for at, part, _, s, counts, kth in scores(batch, k):
                above = s - lows(at, part)
                query, column = np.nonzero(counts & (s >= kth[:, None]) & (above >= 0) & (above < span))
                key, n = np.unique(query * CELLS + above[query, column] // width, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), at["q_block"].as_py())), pa.array(key // CELLS + part.start), pa.array(key % CELLS), pa.array(n)],
                    names=["q_block", "place", "cell", "n"],
                )

    return pairs.mapInArrow(run, "q_block bigint, place bigint, cell bigint, n bigint")


def selected(pairs: DataFrame, k: int, kind: str) -> DataFrame:
    """(q_block, place, query_id, vec_id, score) above the query's kth value, which is ``lows`` now,
    and the k smallest ids at it."""

    def run(batches):
        for batch in batches:
            for at, part, others, s, counts, _ in scores(batch, k):
                order = np.argsort(others, kind="stable")
                low = lows(at, part)
                query, column = np.nonzero(counts & (s > low))
                equal = counts & (s == low)
                ties = [(i, j) for i in np.flatnonzero(equal.any(axis=1)) for j in order[equal[i, order]][:k]]
                query = np.concatenate((query, [i for i, _ in ties])).astype(np.int64)
                column = np.concatenate((column, [j for _, j in ties])).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(query), at["q_block"].as_py())), pa.array(query + part.start), at["q_ids"].values.take(pa.array(query + part.start)),
                     at["c_ids"].values.take(pa.array(column)), pa.array(s[query, column])],
                    names=["q_block", "place", "query_id", "vec_id", "score"],
                )

    return pairs.mapInArrow(run, f"q_block bigint, place bigint, query_id {kind}, vec_id {kind}, score bigint")


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest scores of each query, ties to
    the smaller id, from rows (vec_id, embedding)."""
    kind = candidates.schema["vec_id"].dataType.simpleString()
    ask, have = query_blocks(quantized(queries)), packed(quantized(candidates), CANDIDATES)
    squares = F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    reach = quantized(queries).union(quantized(candidates)).agg(F.max(squares).alias("m")).first()["m"] or 0.0
    reach = min(int(reach * 1.0001) + 1, LARGEST)  # no product of two vectors is larger
    width, low = 2 * reach + 1, -reach
    # lows: where each query's range begins; above: scores counted beyond the range.
    ask = ask.withColumn("lows", F.transform("ids", lambda _: F.lit(low))).withColumn("above", F.transform("ids", lambda _: F.lit(0)).cast("array<bigint>"))
    while width > 1:
        span, width = width, -(-width // CELLS)
        # Cells from the top down: the first at which k scores are reached holds the kth.
        cells = histograms(met(ask, have), k, span, width).groupBy("q_block", "place", "cell").agg(F.sum("n").alias("n"))
        state = ask.select(F.col("block").alias("q_block"), F.posexplode("above").alias("place", "above"))
        down = W.partitionBy("q_block", "place").orderBy(F.desc("cell"))
        cells = cells.join(state, ["q_block", "place"]).withColumn("reached", F.col("above") + F.sum("n").over(down))
        kth = (
            cells.where(F.col("reached") - F.col("n") < k)
            .groupBy("q_block", "place")
            .agg(F.min(F.struct("cell", (F.col("reached") - F.col("n")).alias("above"))).alias("s"))
            .select("q_block", "place", "s.cell", "s.above")
        )
        lows = ask.select(F.col("block").alias("q_block"), F.posexplode("lows").alias("place", "low"))
        # A query with fewer than k candidates ends at its lowest score.
        state = (
            lows.join(kth, ["q_block", "place"], "left")
            .groupBy("q_block")
            .agg(F.sort_array(F.collect_list(F.struct("place", (F.col("low") + F.coalesce("cell", F.lit(0)) * width).alias("low"), F.coalesce("above", F.lit(0)).alias("above")))).alias("s"))
            .select("q_block", F.col("s.low").alias("lows"), F.col("s.above").alias("above"))
        )
        ask = stored(ask.drop("lows", "above").join(state, F.col("block") == F.col("q_block")).drop("q_block"), "queries")
    rank = F.row_number().over(W.partitionBy("q_block", "place").orderBy(F.desc("score"), "vec_id"))
    found = selected(met(ask, have), k, kind).withColumn("rank", rank).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
