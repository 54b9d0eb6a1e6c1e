"""Language of a text by a convolutional network over bytes.

The network embeds bytes (A-Z folded to a-z), applies filters of several widths,
takes each filter's maximum over a window of fixed length and ends in a softmax. It
is trained here, in numpy, on windows of labelled texts. A text is cut into
consecutive windows that cover all of it, the last one padded with zero bytes; its
probabilities are the mean over its windows, weighted by their bytes.

Training reads at most ``WINDOWS_PER_LANGUAGE`` windows per language, drawn by a hash
of row id and text, of the ``MOST_LANGUAGES`` labels with the most rows (ties by name);
rarer labels are not learned, and so never predicted. Everything else is one pass over
the texts. Of languages with equal probability the first by name is predicted.

Odd rows: a null text or one without a letter is ``und`` with score 0, and so is
every text if nothing was learned. Rows are judged one by one, so repeated rows get
equal results; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_slices, unused

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
EPOCHS = 10
BATCH = 64
RATE = 0.01
WINDOWS_PER_LANGUAGE = 1500
MOST_LANGUAGES = 256
UNKNOWN = "und"
#: Windows that are convolved at a time.
TOGETHER = 16


class ByteNet:
    """Parameters and passes of the network.

    Filters narrower than the widest have zeros in the places they do not reach, so
    that one matrix product applies them all.
    """

    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        width, n = max(WIDTHS), FILTERS * len(WIDTHS)
        reach = np.repeat(WIDTHS, FILTERS)
        self.mask = (np.arange(width)[:, None] < reach)[:, None, :]
        filters = rng.normal(0, 1, (width, EMBEDDING, n)) / np.sqrt(reach * EMBEDDING) * self.mask
        self.p = {
            "embedding": rng.normal(0, 0.3, (256, EMBEDDING)),
            "filters": filters,
            "shift": np.zeros(n),
            "dense": rng.normal(0, 1 / np.sqrt(n), (n, len(languages))),
            "bias": np.zeros(len(languages)),
        }
        self.fold()

    def fold(self) -> None:
        """The parameters the matrix product uses, in single precision."""
        self.table = self.p["embedding"].astype(np.float32)
        self.matrix = np.ascontiguousarray(self.p["filters"].reshape(-1, self.mask.shape[2]).T, np.float32)

    def responses(self, x: np.ndarray) -> np.ndarray:
        """(window, filter, place)."""
        width, span = len(self.mask), x.shape[1] - len(self.mask) + 1
        embedded = self.table.take(x, axis=0).transpose(0, 2, 1)
        shifted = np.empty((len(x), width * EMBEDDING, span), np.float32)
        for j in range(width):
            shifted[:, j * EMBEDDING : (j + 1) * EMBEDDING] = embedded[:, :, j : j + span]
        return self.matrix @ shifted

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum(self.responses(x).max(axis=2) + self.p["shift"], 0)
        z = hidden @ self.p["dense"] + self.p["bias"]
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        responses = self.responses(x)
        place = responses.argmax(axis=2)
        hidden = np.maximum(responses.max(axis=2) + self.p["shift"], 0)
        z = hidden @ self.p["dense"] + self.p["bias"]
        e = np.exp(z - z.max(axis=1, keepdims=True))
        d = e / e.sum(axis=1, keepdims=True)
        d[np.arange(len(y)), y] -= 1
        d /= len(y)
        back = (d @ self.p["dense"].T) * (hidden > 0)
        g = {"dense": hidden.T @ d, "bias": d.sum(0), "shift": back.sum(0)}
        g["embedding"], g["filters"] = np.zeros((256, EMBEDDING)), np.zeros_like(self.p["filters"])
        n = hidden.shape[1]
        for j in range(len(self.mask)):
            # only the bytes under each maximum get a gradient
            cells = x[np.arange(len(x))[:, None], place + j].astype(np.int64) * n + np.arange(n)
            table = np.bincount(cells.ravel(), back.ravel(), 256 * n).reshape(256, n)
            g["filters"][j] = (self.p["embedding"].T @ table) * self.mask[j]
            g["embedding"] += table @ self.p["filters"][j].T
        return g

    def train(self, x: np.ndarray, y: np.ndarray, seed: int = 11) -> ByteNet:
        """Adam over shuffled batches; rates fall linearly."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, steps = 0, EPOCHS * -(-len(x) // BATCH)
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for at in range(0, len(x), BATCH):
                step += 1
                pick = order[at : at + BATCH]
                for k, g in self.gradients(x[pick], y[pick]).items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    rate = RATE * (1 - (step - 1) / steps)
                    self.p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                self.fold()
        return self

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean probabilities of each text over all its windows."""
        lengths = np.diff(offsets)
        counts = -(-lengths // WINDOW)
        text = np.repeat(np.arange(len(lengths)), counts)
        edges = np.concatenate(([0], np.cumsum(counts)))
        starts = offsets[text] + (np.arange(edges[-1]) - edges[text]) * WINDOW
        sizes = np.minimum(WINDOW, offsets[text + 1] - starts)
        total = np.zeros((len(lengths), len(self.languages)))
        folded = folded_bytes(np.concatenate((data, np.zeros(WINDOW, np.uint8))))
        steps = np.arange(WINDOW)
        for at in range(0, len(starts), TOGETHER):
            few = slice(at, at + TOGETHER)
            x = folded[starts[few, None] + steps]
            x[steps >= sizes[few, None]] = 0
            np.add.at(total, text[few], self.probabilities(x) * sizes[few, None])
        return total / np.maximum(lengths, 1)[:, None]


def folded_bytes(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def labelled_windows(docs: DataFrame, usable: Column) -> list:
    """At most about ``WINDOWS_PER_LANGUAGE`` (lang, window) rows per language."""
    rows = docs.where(usable & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()
    if not counts:
        return []
    rows = rows.where(F.col("lang").isin([r["lang"] for r in counts]))
    per_language = lambda f: F.create_map(*(F.lit(v) for r in counts for v in (r["lang"], f(r["count"]))))[F.col("lang")]
    share = per_language(lambda n: min(1.0, WINDOWS_PER_LANGUAGE / n))
    each = per_language(lambda n: -(-WINDOWS_PER_LANGUAGE // n))  # windows of a text, if texts are few
    unit = float(1 << 40)
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40))
    chosen = rows.select("lang", "text", draw.alias("draw")).where(F.col("draw") < share * unit)
    chosen = chosen.select("lang", "draw", F.col("text").cast("binary").alias("octets"), F.explode(F.sequence(F.lit(1), each)).alias("i"))
    most = F.greatest(F.octet_length("octets") - WINDOW + 1, F.lit(1))
    begin = F.pmod(F.xxhash64("draw", "i"), most) + 1
    return (
        chosen.select("lang", "draw", "i", F.substring("octets", begin.cast("int"), F.lit(WINDOW)).alias("window"))
        .orderBy("draw", "i", "lang", "window")
        .limit(2 * WINDOWS_PER_LANGUAGE * len(counts))
        .collect()
    )


def fit(docs: DataFrame, usable: Column) -> ByteNet | None:
    """The network trained on texts and non-null ``lang`` of the rows ``usable`` names."""
    rows = labelled_windows(docs, usable)
    if not rows:
        return None
    languages = sorted({r["lang"] for r in rows})
    rng = np.random.default_rng(3)
    x = np.zeros((len(rows), WINDOW), np.uint8)
    for i, r in enumerate(rows):
        window = np.frombuffer(bytes(r["window"]), np.uint8)
        if i % 2:  # short texts must be told apart too
            window = window[: rng.integers(12, WINDOW)]
        x[i, : len(window)] = window
    y = np.array([languages.index(r["lang"]) for r in rows])
    return ByteNet(languages).train(folded_bytes(x), y)


def with_language(docs: DataFrame, net: ByteNet | None, pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its probability."""
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if net is None:
        return docs.withColumns({pred: F.lit(UNKNOWN), score: F.lit(0.0)})
    has = unused(docs, "has_letter")
    rows = docs.withColumn(has, letters)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            for row, data, offsets in text_slices(batch.column(at)):
                part = batch.slice(row, len(offsets) - 1)
                known = part.column(part.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool)
                p = net.predict(data, offsets)
                best = p.argmax(axis=1)
                names = [net.languages[k] if ok else UNKNOWN for k, ok in zip(best, known, strict=True)]
                scores = np.where(known, np.minimum(p[np.arange(len(p)), best], 1.0), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(names, pa.string()), pa.array(scores)], names=[*part.schema.names[:-1], pred, score]
                )

    return rows.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType())]))


def identify(docs: DataFrame, usable: Column) -> DataFrame:
    """doc_id, lang_pred and score of every row, by a network trained on the rows
    ``usable`` names."""
    return with_language(docs.select("doc_id", "text"), fit(docs, usable))


def known_language(docs: DataFrame, usable: Column, least_score: float = 0.5) -> DataFrame:
    """The rows whose language is known with at least ``least_score``."""
    pred, score = unused(docs, "lang_pred"), unused(docs, "lang_score")
    judged = with_language(docs, fit(docs, usable), pred, score)
    return judged.where((F.col(pred) != UNKNOWN) & (F.col(score) >= least_score)).select(*docs.columns)
