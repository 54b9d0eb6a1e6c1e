"""Landed result extracts as a file stream.

Two streams follow each other. The first is a stream of file names: the files of a
micro-batch are read like any landed extract (:mod:`wellspring.sources.csvfiles`), so
their columns may be ordered differently or be missing, and are stored as rows of that
batch together with its distinct sample ids. The second is a stream of these ids, with
a state keyed by sample that remembers the batch a sample first came in. Only ids go
through the state; rows of samples that are new are then taken from the stored batch,
transformed and appended. The state starts from the samples that are stored when the
stream begins; after that the target is not read again, so samples that other writers
add meanwhile are not noticed.

A balance needs a sample's rows together, so it is derived inside the micro-batch: land
one extract as one file, or as files that arrive together.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from .. import sinks
from ..model.schema import RESULT, WQP_RESULT_COLUMNS
from ..operators.columns import rename_columns, to_storage
from ..operators.dedupe import keep_known
from ..plans.tails import Tables, transform_results
from ..sources.csvfiles import FILE, read_text_csv, readable

#: Files as Spark's binary reader lists them; only names are read.
FILES = "path string, modificationTime timestamp, length bigint, content binary"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Column that names the micro-batch of files a row came with.
BATCH = "_batch"


def result_stream(spark: SparkSession, landing: str, columns: Iterable[str] = (), max_files: int | None = None) -> DataFrame:
    """Stream of the names of landed CSV files.

    ``columns`` are source columns that rows shall have, as NULL, even if no file of a
    micro-batch has them. ``max_files`` bounds a micro-batch.
    """
    reader = spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", "*.csv")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    names = F.array(*map(F.lit, columns)).cast("array<string>")
    return reader.load(landing).select(F.col("_metadata.file_path").alias("path"), names.alias("columns"))


def landed_rows(spark: SparkSession, paths: list[str], columns: Iterable[str] = ()) -> DataFrame:
    """Rows of landed files, all text, with target names and the file's name."""
    rows = read_text_csv(spark, paths, with_file=True)
    rows = rows.withColumns({f"{c}": F.lit(None).cast("string") for c in columns if c not in rows.columns})
    return rename_columns(rows, WQP_RESULT_COLUMNS)


def _stage_files(base: str) -> Callable[[DataFrame, int], None]:
    """Stores the rows and the sample ids of a micro-batch of files. A repeated batch
    replaces what it has stored before."""

    def run(files: DataFrame, batch: int) -> None:
        spark = files.sparkSession
        named = files.collect()  # a row per file
        if not named:
            return
        rows = landed_rows(spark, sorted(readable(r.path) for r in named), named[0]["columns"])
        if "SampleId" not in rows.columns:
            rows = rows.withColumn("SampleId", F.lit(None).cast("string"))
        rows.write.mode("overwrite").parquet(f"{base}/rows/{batch}")
        stored = spark.read.schema(rows.schema).parquet(f"{base}/rows/{batch}")
        ids = stored.select("SampleId").distinct().withColumn(BATCH, F.lit(batch).cast("bigint"))
        ids.write.mode("overwrite").parquet(f"{base}/samples/{batch}")

    return run


def _first_seen() -> StatefulProcessor:
    """Lets a sample pass with the batch it first came in, and never again."""

    class FirstSeen(StatefulProcessor):
        def init(self, handle) -> None:
            self.batch = handle.getValueState("batch", "batch bigint")

        def handleInputRows(self, key, rows, timerValues):
            batches = [row[BATCH] for row in rows]
            if key[0] is None:  # rows without a sample id are never known
                yield from (Row(SampleId=None, **{BATCH: batch}) for batch in sorted(set(batches)))
            elif not self.batch.exists():
                self.batch.update((min(batches),))
                yield Row(SampleId=key[0], **{BATCH: min(batches)})

        def handleInitialState(self, key, initialState, timerValues) -> None:
            if key[0] is not None:
                self.batch.update((-1,))

        def close(self) -> None:
            pass

    return FirstSeen()


def append_unseen(
    base: str,
    tag: str,
    append: Callable[[DataFrame, str], None],
    as_of: Column | datetime.datetime | None = None,
    tables: Tables = Tables(),
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: transform and append the rows of new samples, which
    are given as (SampleId, batch).

    ``append`` gets the name of the load, the same when a batch is repeated after a
    failure, and must leave one copy of it.
    """

    def run(samples: DataFrame, epoch: int) -> None:
        spark = samples.sparkSession
        samples = samples.persist()
        try:
            parts = []
            for batch in sorted(r[BATCH] for r in samples.select(BATCH).distinct().collect()):
                rows = spark.read.parquet(f"{base}/rows/{batch}")
                mine = samples.where(F.col(BATCH) == batch).select("SampleId")
                parts += [keep_known(rows, mine, "SampleId"), rows.where(F.col("SampleId").isNull())]
            if parts:
                rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
                append(transform_results(rows, tag, as_of, tables, scope=(FILE,)), f"stream-{epoch}")
        finally:
            samples.unpersist()

    return run


def _drain(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Runs a stream over all that is there, then stops."""
    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def ingest(
    stream: DataFrame,
    checkpoint: str,
    tag: str,
    read_stored: Callable[[], DataFrame],
    append: Callable[[DataFrame, str], None],
    as_of: Column | datetime.datetime | None = None,
    tables: Tables = Tables(),
) -> None:
    """Take every file of ``stream`` (:func:`result_stream`) that has landed since the
    last run, then stop.

    ``read_stored`` gives the stored samples (SampleId), read once, when the checkpoint
    is new. ``append(rows, load)`` adds rows; see :func:`parquet_target` and
    :func:`store_target`.
    """
    spark = stream.sparkSession
    _drain(stream, _stage_files(checkpoint), f"{checkpoint}/files")
    if not _exists(spark, f"{checkpoint}/samples"):
        return  # nothing has ever landed
    ids = spark.readStream.schema(f"SampleId string, {BATCH} bigint").parquet(f"{checkpoint}/samples/*")
    stored = read_stored().where(F.col("SampleId").isNotNull()).select("SampleId").distinct()
    fresh = ids.groupBy("SampleId").transformWithState(
        _first_seen(), f"SampleId string, {BATCH} bigint", "Append", "None", initialState=stored.groupBy("SampleId")
    )
    provider = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        _drain(fresh, append_unseen(checkpoint, tag, append, as_of, tables), f"{checkpoint}/state")
    finally:
        spark.conf.set(STATE_STORE, provider) if provider else spark.conf.unset(STATE_STORE)


def _exists(spark: SparkSession, path: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def parquet_target(spark: SparkSession, path: str) -> tuple[Callable[[], DataFrame], Callable[[DataFrame, str], None]]:
    """Reader and appender of a Parquet folder of results, for ``ingest``. A load is a
    folder, which a repeated one replaces."""
    schema = to_storage(spark.createDataFrame([], T.StructType([T.StructField("SampleId", T.StringType())])), RESULT).schema

    def read() -> DataFrame:
        return spark.read.schema(schema).parquet(f"{path}/*")

    def append(df: DataFrame, load: str) -> None:
        to_storage(df, RESULT).write.mode("overwrite").parquet(f"{path}/{load}")

    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/empty")
    return read, append


def store_target(spark: SparkSession, db: str, name: str) -> tuple[Callable[[], DataFrame], Callable[[DataFrame, str], None]]:
    """The same for the Results of a database. ``name`` tells the stream's loads from
    those of others; the ledger keeps a repeated one out."""

    def read() -> DataFrame:
        return sinks.keyindex.live_keys(spark, db).select("SampleId")

    def append(df: DataFrame, load: str) -> None:
        sinks.append(df.sparkSession, db, results=df, task=f"{name} {load}")
        sinks.refresh(spark, db)  # a stream writes from a session of its own

    return read, append
