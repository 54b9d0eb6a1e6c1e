"""Session settings, and stages in the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Settings the jobs are written for. Partition sizes follow the data: adaptive
#: execution coalesces small shuffle partitions and splits large ones.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed partition even if a later step then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # The JVM leaves methods beyond 8000 bytes interpreted. Above that size Spark
    # shall generate separate, short methods instead of one fused loop. The casts do
    # not need it; wide projections of a caller's own may.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Sets :data:`SETTINGS` in a session that came from elsewhere. The jobs do it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A single-machine session for tests and the benchmark. On a cluster the
    session comes from spark-submit; pass it to the functions as it is."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("wellspring")
    settings = {
        **SETTINGS,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": memory,
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder that driver and executors share: below ``spark.checkpoint.dir``,
    or below the warehouse where that is unset. On a cluster the latter must not be a
    machine's own folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        if base.startswith("file:") and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


#: Folders of the stages written since :func:`temporary` was entered; None outside it.
_STAGES: ContextVar[list[str] | None] = ContextVar("stages", default=None)
#: Spark deletes the shuffle files of a query when the query ends, not when the driver's
#: garbage collection happens to find its plan.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, purpose: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """The rows written once to the shared folder as Parquet, and read from there. Inside
    :func:`temporary` the folder lasts as long as that. ``options`` are the writer's."""
    path = scratch_dir(df.sparkSession, purpose)
    if (held := _STAGES.get()) is not None:
        held.append(path)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """For a part of a job that leaves nothing but what it has written: the stages made in
    it are deleted at its end, also if it fails, and the shuffle files of each of its
    queries when that is done. A DataFrame made in it is not to be used after it."""
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    paths: list[str] = []
    token = _STAGES.set(paths)
    try:
        yield
    finally:
        _STAGES.reset(token)
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(hadoop).delete(folder, True)
