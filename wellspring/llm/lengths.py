"""Token counts as an exact histogram of encoded lengths.

Texts are encoded with a byte-level BPE vocabulary; tasks count their lengths and
Spark adds the counts up, so what is shuffled is bounded by distinct lengths per task.
Running sums over the histogram then answer, for every context limit, how many
documents fit, how many tokens they hold, and how many tokens remain if longer
documents are cut at the limit; quantiles follow from the same sums. Running sums are
taken within ranges of ``RANGE`` lengths and then over the ranges, so no task holds
the whole histogram.

Odd rows: null and empty texts have length 0. Repeated rows count each. No rows give
an empty histogram. Special tokens in a text are ordinary text. Other columns are not
read.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the vocabulary's texts are cut before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RANGE = 1024


def encoder(ranks: bytes) -> tiktoken.Encoding:
    pairs = (line.split() for line in ranks.splitlines() if line)
    merges = {base64.b64decode(piece): int(rank) for piece, rank in pairs}
    return tiktoken.Encoding("histogram", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})


def histogram(docs: DataFrame, ranks_file: str = RANKS) -> DataFrame:
    """(length, documents): how many rows of ``docs`` encode to so many tokens."""
    with open(ranks_file, "rb") as f:
        ranks = f.read()

    def run(batches):
        encode = encoder(ranks).encode_ordinary
        for batch in batches:
            length, n = np.unique([len(encode(t.as_py() or "")) for t in batch.column(0)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(length, pa.int64()), pa.array(n, pa.int64())], names=["length", "documents"])

    found = docs.select("text").mapInArrow(run, "length bigint, documents bigint")
    return found.groupBy("length").agg(F.sum("documents").alias("documents"))


def limits(counts: DataFrame) -> DataFrame:
    """For every length L of the histogram, as a context limit: documents of that
    length, documents and tokens in documents up to L, documents beyond L, tokens if
    documents are cut at L, and the share of documents up to L."""
    counts = counts.select("length", "documents", F.floor(F.col("length") / RANGE).alias("range"))
    tokens = F.col("length") * F.col("documents")
    ranges = counts.groupBy("range").agg(F.sum("documents").alias("d"), F.sum(tokens).alias("t"))
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    ever = W.orderBy("range").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ranges = ranges.select(
        "range",
        F.coalesce(F.sum("d").over(before), F.lit(0)).alias("d_before"),
        F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t_before"),
        F.sum("d").over(ever).alias("all"),
    )
    upto = W.partitionBy("range").orderBy("length").rowsBetween(W.unboundedPreceding, 0)
    rows = counts.join(ranges, "range").select(
        "length", "documents", "all",
        (F.col("d_before") + F.sum("documents").over(upto)).alias("documents_up_to"),
        (F.col("t_before") + F.sum(tokens).over(upto)).alias("tokens_up_to"),
    )
    beyond = F.col("all") - F.col("documents_up_to")
    return rows.select(
        "length", "documents", "documents_up_to", "tokens_up_to",
        beyond.alias("documents_beyond"),
        (F.col("tokens_up_to") + F.col("length") * beyond).alias("tokens_cut"),
        (F.col("documents_up_to") / F.col("all")).alias("share"),
    )


def tokens_cut(counts: DataFrame, limit: int) -> int:
    """Tokens left of all documents if each is cut at ``limit``, which may be any."""
    return counts.agg(F.sum(F.least("length", F.lit(limit)) * F.col("documents"))).first()[0] or 0


def quantiles(table: DataFrame, shares: list[float]) -> list[int | None]:
    """The least lengths up to which lie at least ``shares`` of the documents."""
    found = table.agg(*(F.min(F.when(F.col("share") >= s, F.col("length"))) for s in shares)).first()
    return list(found)
