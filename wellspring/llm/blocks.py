"""Vectors packed into blocks of bounded size, and every query block met with every
candidate block of its dimension."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

CANDIDATES = 4096
QUERIES = 512
#: Tasks that the met blocks are dealt to, at most; a task takes its blocks in turn.
MOST_TASKS = 20_000


def finite(vector: Column) -> Column:
    """Whether a vector is there, not empty, and holds finite numbers only."""
    number = lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, number), F.lit(False))


def packed(rows: DataFrame, size: int) -> DataFrame:
    """(block, dim, ids, data) from (vec_id, x): up to ``size`` vectors of one
    dimension, their numbers as 64-bit values row by row. Stored, as the numbering
    follows the partitions."""
    number = np.float64 if rows.schema["x"].dataType.simpleString() == "array<double>" else np.int64

    def run(batches):
        held: dict[int, tuple[list, list]] = {}
        block = TaskContext.get().partitionId() << 32

        def flush(dim):
            nonlocal block
            ids, data = held.pop(dim)
            block += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([dim], pa.int32()), pa.array([ids], pa.list_(kind)), pa.array([b"".join(data)])],
                names=["block", "dim", "ids", "data"],
            )

        kind = pa.int64()
        for batch in batches:
            kind = batch.column(0).type
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                x = value.values.to_numpy(zero_copy_only=False).astype(number)
                ids, data = held.setdefault(len(x), ([], []))
                ids.append(key)
                data.append(x.tobytes())
                if len(ids) >= size:
                    yield flush(len(x))
        for dim in list(held):
            yield flush(dim)

    kind = rows.schema["vec_id"].dataType.simpleString()
    return stored(rows.select("vec_id", "x").mapInArrow(run, f"block bigint, dim int, ids array<{kind}>, data binary"), "blocks")


def query_blocks(rows: DataFrame) -> DataFrame:
    """Queries in as few blocks as their number allows."""
    return packed(rows.repartition(max(1, -(-rows.count() // QUERIES))), QUERIES)


def met(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """A row per query block and candidate block of one dimension, with the columns of
    both: those of ``queries`` named q_*, those of ``candidates`` c_*.

    Both sides are repeated once per block of the other and joined on the pair of
    block numbers, so no key is hotter than another.
    """
    side = lambda df, x: df.select(*(F.col(c).alias(f"{x}_{c}") for c in df.columns))
    numbers = lambda df, x: df.groupBy(F.col("dim").alias("dim_")).agg(F.collect_list("block").alias(x))
    left = side(queries, "q").join(numbers(candidates, "others"), F.col("q_dim") == F.col("dim_"))
    right = side(candidates, "c").join(numbers(queries, "others"), F.col("c_dim") == F.col("dim_"))
    left = left.withColumn("c_at", F.explode("others")).drop("others", "dim_")
    right = right.withColumn("q_at", F.explode("others")).drop("others", "dim_")
    tasks = min(MOST_TASKS, max(1, queries.count() * candidates.count()))
    left = left.repartition(tasks, "q_block", "c_at")
    right = right.repartition(tasks, "q_at", "c_block")
    return left.join(right, (F.col("q_block") == F.col("q_at")) & (F.col("c_at") == F.col("c_block")))


def matrix(value: pa.BinaryScalar, dim: int, number=np.float64) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), number).reshape(-1, dim)
