"""The corpus pipeline: five stages over ``documents``, each stored as Parquet.

All stages but the last return the columns of ``documents``; the last returns sampled
segmentations of the texts that are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.llm import langid, minhash, mixing, pieces, quality
from wellspring.llm.common import stored, table
from wellspring.llm.queries import not_crc


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, and those whose language stays unclear, go."""
    return langid.known_language(docs, not_crc(3, 1), 0.3)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score below 0.3 go."""
    return quality.good(docs, table(spark, sf_dir, "labels"), not_crc(5, 0), 0.3)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five-word shingles,
    similarity 0.8."""
    return minhash.first_of_each(docs, 5, 80, 100)


def mixing_rates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rates at which 97 % of the tokens are clean. A label counts for more than the
    words; 256 words of evidence tell the other documents apart, and those that are
    more likely clean than toxic keep a rate of 1 at least."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("toxic") == 0, "clean")
    labelled = table(spark, sf_dir, "labels").select("doc_id", domain.alias("domain"))
    return mixing.mixed(docs, labelled, {"clean": 0.97, "toxic": 0.03}, evidence=256, known=True, keep="clean")[0]


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that 97 % of the tokens are expected to be
    clean, with as many tokens as before."""
    return mixing.applied(docs, mixing_rates(spark, docs, sf_dir))


def segmentation_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two distinct segmentations of every document."""
    return pieces.sample(docs, k=2).select("doc_id", "sample", "ids", "log_prob", "log_inclusion")


STAGES = [
    ("language", language_stage),
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("segmentation", segmentation_stage),
]

#: SQL can express neither the trained models nor the sampled segmentations.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
