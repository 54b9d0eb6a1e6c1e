"""Tables, stored stages and hashes the operators share."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text a task turns into numpy arrays at a time.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder that driver and executors share: below ``spark.checkpoint.dir``,
    or below the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read back, which cuts the lineage."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Numbers that ids are hashed to for a filter before a join; as many are broadcast at most.
MARKS = 1 << 20


def split_by(rows: DataFrame, key: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose ``key`` may be in the one column of ``ids``, rows whose key is not).

    The ids' hashes decide, ``MARKS`` numbers at most whatever the input, so wide rows
    that a join by key cannot touch need no shuffle. A null key may be either.
    """
    mark = lambda c: F.pmod(F.xxhash64(c), F.lit(MARKS))
    name = unused(rows, "mark")
    marks = F.broadcast(ids.toDF("id").select(mark("id").alias(name)).distinct())
    same = mark(F.col(key)) == F.col(name)
    return rows.join(marks, same, "left_semi"), rows.join(marks, same, "left_anti")


def among(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows whose ``key`` is in the one column of ``ids``."""
    return split_by(rows, key, ids)[0].join(ids.toDF(key).distinct(), key, "left_semi").select(*rows.columns)


def without(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows whose ``key`` is null or not in the one column of ``ids``."""
    maybe, rest = split_by(rows, key, ids)
    return maybe.join(ids.toDF(key).distinct(), key, "left_anti").select(*rows.columns).union(rest)


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; 0 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a variation that no column of ``df`` has (case ignored)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_slices(column: pa.Array, limit: int = SLICE_BYTES):
    """(first row, bytes, offsets) for runs of rows with about ``limit`` bytes of
    UTF-8; one longer text makes a run of its own. Null counts as empty."""
    column = column.fill_null("").cast(pa.large_string())
    if not len(column):
        return
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        stop = min(max(stop, row + 1), len(column))
        yield row, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit (splitmix finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Word hashes of many texts at once.

    A word is a run of bytes other than space and 0x09 to 0x0D, after A-Z are
    lower-cased. The hash of a word is a polynomial over random 64-bit byte codes,
    taken as a difference of running sums, then mixed.
    """

    BASE = 0x9E3779B97F4A7C15

    def __init__(self):
        self.codes = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        self.lower = lower
        self.space = np.zeros(256, bool)
        self.space[[0x20, *range(0x09, 0x0E)]] = True
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, 2 * SLICE_BYTES)
            for name, base in (("powers", self.BASE), ("inverse", pow(self.BASE, -1, 1 << 64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def bounds(self, data: np.ndarray, offsets: np.ndarray):
        """(starts, ends, first word of each text and one past the last)."""
        word = ~self.space[data]
        cut = np.zeros(len(data) + 1, bool)  # before a byte: does a text begin there?
        cut[offsets] = True
        cut[0] = cut[-1] = True
        first, last = cut[:-1].copy(), cut[1:].copy()
        first[1:] |= ~word[:-1]
        last[:-1] |= ~word[1:]
        starts, ends = np.flatnonzero(word & first), np.flatnonzero(word & last) + 1
        return starts, ends, np.searchsorted(starts, offsets)

    def hashes(self, data: np.ndarray, offsets: np.ndarray):
        """(hash of every word, first word of each text and one past the last)."""
        data = self.lower[data]
        starts, ends, first = self.bounds(data, offsets)
        self._grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.codes[data] * self.powers[: len(data)], out=sums[1:])
        value = (sums[ends] - sums[starts]) * self.inverse[starts]
        return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)), first


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int):
    """(hash of every run of ``size`` words, first run of each text and one past
    the last). A text with fewer words gives its whole sequence as one run; a text
    without words gives none."""
    counts = np.diff(first)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    edges = np.concatenate(([0], np.cumsum(runs)))
    at = np.arange(edges[-1]) - np.repeat(edges[:-1] - first[:-1], runs)
    left = np.repeat(first[1:], runs) - at
    out = np.minimum(left, size).astype(np.uint64)
    padded = np.concatenate((words, np.zeros(size, np.uint64)))
    for i in range(size):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + np.where(left > i, padded[at + i], np.uint64(0)))
    return out, edges
