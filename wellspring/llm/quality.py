"""Quality of a text by kernel ridge regression on random Fourier features.

One pass over the texts takes ``STATISTICS`` of each whole text. They are centred and
scaled, and mapped to cosines of random projections, whose inner product approximates
a Gaussian kernel. The normal equations of ridge regression are sums over rows, so
each partition adds up its own and Spark adds up the partitions, row by row of the
matrix; only the finished matrix reaches the driver. The labelled rows are dealt into
two halves: a model fitted on one half scores the other, and an isotonic regression on
those scores, gathered in a histogram of fixed size, turns ridge scores into the
probability of label 1. The final model is fitted on both halves.

Everything but matrix, histogram and their solution stays distributed; all labelled
rows count.

Odd rows: a null text counts as empty; an empty text is scored like any other. A null
id counts as held out. Without usable labels every score is 0.5. Labels other than 0
and 1, and null ones, are not used; of an id with several labels each counts. Other
columns are not read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, stored, text_slices

STATISTICS = (
    "log bytes", "log words", "bytes per word", "spread of bytes per word", "letters", "capitals among ASCII letters",
    "digits", "sentence marks", "other marks", "non-ASCII bytes", "line breaks per word", "marks per word",
    "distinct words", "most frequent word", "word equals the one before", "distinct word pairs",
)
FEATURES = 128
#: Width of the kernel, in standard deviations of a statistic.
WIDTH = 3.0
#: Standardized statistics are kept within this many deviations.
REACH = 6.0
RIDGE = 1e-3
#: Cells of the histogram of ridge scores, which span -1 to 2.
CELLS = 3000
SEED = 5

LOWER, UPPER, DIGIT, SENTENCE, OTHER, SPACE, BREAK, HIGH = range(8)


def byte_classes() -> np.ndarray:
    kind = np.full(256, OTHER, np.uint8)
    kind[97:123], kind[65:91], kind[48:58], kind[128:] = LOWER, UPPER, DIGIT, HIGH
    kind[[ord(c) for c in ".,;:?-'\"()"]] = SENTENCE
    kind[[0x20, 9, 11, 12, 13]], kind[10] = SPACE, BREAK
    return kind


class Statistics:
    """The statistics of many texts at once."""

    def __init__(self):
        self.words, self.kind = Words(), byte_classes()

    def of(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        size = np.diff(offsets)
        text = np.repeat(np.arange(n, dtype=np.int32), size)
        count = np.bincount(text * np.int32(8) + self.kind[data], minlength=8 * n).reshape(n, 8).astype(float)
        starts, ends, first = self.words.bounds(data, offsets)
        hashes, _ = self.words.hashes(data, offsets)
        words = np.diff(first).astype(float)
        length = (ends - starts).astype(float)
        sums = lambda x: np.diff(np.concatenate(([0.0], np.cumsum(x)))[first])
        some = np.maximum(words, 1)
        mean = sums(length) / some
        same = np.zeros(len(hashes))
        same[1:] = hashes[1:] == hashes[:-1]
        same[first[:-1][first[:-1] < len(same)]] = 0
        pairs = hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:] if len(hashes) else hashes
        distinct, top, distinct_pairs = np.ones(n), np.zeros(n), np.ones(n)
        for i in range(n):
            a, b = first[i], first[i + 1]
            if b > a:
                s = np.sort(hashes[a:b])
                cuts = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1], [True])))
                distinct[i], top[i] = (len(cuts) - 1) / (b - a), np.diff(cuts).max() / (b - a)
            if b > a + 1:
                s = np.sort(pairs[a : b - 1])
                distinct_pairs[i] = (1 + np.count_nonzero(s[1:] != s[:-1])) / (b - 1 - a)
        octets = np.maximum(size, 1)
        marks = count[:, SENTENCE] + count[:, OTHER]
        return np.column_stack((
            np.log1p(size), np.log1p(words), np.log1p(mean), np.sqrt(np.maximum(sums(length**2) / some - mean**2, 0)) / np.maximum(mean, 1),
            (count[:, LOWER] + count[:, UPPER] + count[:, HIGH]) / octets, count[:, UPPER] / np.maximum(count[:, LOWER] + count[:, UPPER], 1),
            count[:, DIGIT] / octets, count[:, SENTENCE] / octets, count[:, OTHER] / octets, count[:, HIGH] / octets,
            np.log1p(count[:, BREAK] / some), np.log1p(marks / some), distinct, top, sums(same) / some, distinct_pairs,
        ))


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    levels: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        raw = features(x, self.mean, self.scale) @ self.weights
        return np.interp(raw, self.steps, self.levels)


def features(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """A constant and the cosines of random projections of standardized statistics."""
    rng = np.random.default_rng(SEED)
    directions = rng.normal(0, 1 / WIDTH, (x.shape[1], FEATURES))
    phases = rng.uniform(0, 2 * np.pi, FEATURES)
    z = np.clip((x - mean) / scale, -REACH, REACH)
    return np.column_stack((np.ones(len(x)), np.sqrt(2 / FEATURES) * np.cos(z @ directions + phases)))


def isotonic(value: np.ndarray, mean: np.ndarray, weight: np.ndarray):
    """Pool adjacent violators: the non-decreasing least-squares fit of ``mean`` over
    increasing ``value``, as (mean value, level) of its blocks."""
    blocks: list[list[float]] = []
    for v, m, w in zip(value, mean, weight, strict=True):
        blocks.append([w * v, w * m, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    b = np.array(blocks)
    return b[:, 0] / b[:, 2], b[:, 1] / b[:, 2]


def arrays(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of every row's whole text."""

    def run(batches):
        statistics = Statistics()
        for batch in batches:
            for row, data, offsets in text_slices(batch.column(1)):
                x = statistics.of(data, offsets)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(x)), lists], names=["doc_id", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, x array<double>")


def fit(labelled: DataFrame) -> Model | None:
    """The model for (half, x, y) rows: half and y are 0 or 1."""
    n = len(STATISTICS)
    column = [F.get("x", F.lit(i)) for i in range(n)]
    moments = labelled.agg(
        F.count("y").alias("n"), F.array(*(F.avg(c) for c in column)).alias("mean"), F.array(*(F.stddev_pop(c) for c in column)).alias("scale")
    ).first()
    if not moments["n"]:
        return None
    mean, scale = np.array(moments["mean"]), np.maximum(np.array(moments["scale"]), 1e-6)
    width = FEATURES + 1

    def partial(batches):
        total = np.zeros((2, width, width + 1))
        for batch in batches:
            half, y = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            z = features(arrays(batch.column(1)), mean, scale) if len(y) else np.zeros((0, width))
            for h in (0, 1):
                part = z[half == h]
                total[h] += part.T @ np.column_stack((part, y[half == h]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat([0, 1], width).astype(np.int32)), pa.array(np.tile(np.arange(width, dtype=np.int32), 2)), pa.array(list(total.reshape(-1, width + 1)))],
            names=["half", "row", "sums"],
        )

    sums = labelled.select("half", "x", "y").mapInArrow(partial, "half int, row int, sums array<double>")
    sums = sums.groupBy("half", "row").agg(F.array(*(F.sum(F.get("sums", F.lit(i))) for i in range(width + 1))).alias("sums"))
    total = np.zeros((2, width, width + 1))
    for r in sums.collect():
        total[r["half"], r["row"]] = r["sums"]

    def solved(t: np.ndarray) -> np.ndarray:
        rows = max(t[0, 0], 1.0)
        return np.linalg.solve(t[:, :width] / rows + RIDGE * np.eye(width), t[:, width] / rows)

    other = [solved(total[1]), solved(total[0])]

    def score(batches):
        for batch in batches:
            if batch.num_rows:
                z = features(arrays(batch.column(1)), mean, scale)
                half = batch.column(0).to_numpy(zero_copy_only=False)
                raw = np.where(half == 0, z @ other[0], z @ other[1])
                cell = np.clip((raw + 1) * (CELLS / 3), 0, CELLS - 1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(cell), batch.column(2)], names=["cell", "y"])

    cells = labelled.select("half", "x", "y").mapInArrow(score, "cell int, y int").groupBy("cell")
    found = sorted(cells.agg(F.avg("y").alias("mean"), F.count("y").alias("n")).collect())
    value = np.array([(r["cell"] + 0.5) * 3 / CELLS - 1 for r in found])
    steps, levels = isotonic(value, np.array([r["mean"] for r in found]), np.array([float(r["n"]) for r in found]))
    return Model(mean, scale, solved(total[0] + total[1]), steps, np.clip(levels, 0.0, 1.0))


def scored(rows: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score) of (doc_id, x) rows."""
    if model is None:
        return rows.select("doc_id", F.lit(0.5).alias("score"))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(arrays(batch.column(1))))], names=["doc_id", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double")


def labelled_statistics(stats: DataFrame, labels: DataFrame, usable: Column) -> DataFrame:
    """(half, x, y) of the rows ``usable`` names that have a quality label."""
    marks = labels.where("quality in (0, 1)").select(F.col("doc_id").alias("label_id"), F.col("quality").cast("int").alias("y"))
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("half")
    return stats.where(usable).join(marks, F.col("doc_id") == F.col("label_id")).select(half, "x", "y")


def quality(docs: DataFrame, labels: DataFrame, usable: Column) -> DataFrame:
    """(doc_id, score) of every row; labels of the rows ``usable`` names are learned."""
    stats = stored(statistics(docs), "statistics")
    return scored(stats, fit(stored(labelled_statistics(stats, labels, usable), "labelled")))


def good(docs: DataFrame, labels: DataFrame, usable: Column, least_score: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score at least ``least_score``."""
    # Statistics of all texts are narrower to shuffle than the texts with a label.
    model = fit(stored(labelled_statistics(statistics(docs), labels, usable), "labelled"))
    at = docs.columns.index("text")

    def run(batches):
        statistics = Statistics()
        for batch in batches:
            for row, data, offsets in text_slices(batch.column(at)):
                keep = model.scores(statistics.of(data, offsets)) >= least_score
                yield batch.slice(row, len(keep)).filter(pa.array(keep))

    return docs if model is None else docs.mapInArrow(run, docs.schema)
