"""Work that grows with the rows is done once per row, compiled and in parallel."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from checks import queries, views
from wellspring.functions import casting
from wellspring.model import schema as S
from wellspring.operators import columns, dedupe
from wellspring.sources import wqp


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_text_without_a_whole_number_is_not_cast(spark):
    texts = ["12", "+7", "-12", "\x0142\x01", "3.5", "1_000", "seven", "n/a", "", None, "1 2", "９", "99999999999999999999"]
    df = spark.createDataFrame([(t,) for t in texts], "IdNum string")
    got = df.select(casting.to_integer(F.col("IdNum"), "bigint").alias("n"), F.col("IdNum").try_cast("bigint").alias("cast")).collect()
    assert [r.n for r in got] == [r["cast"] for r in got]
    assert "RLIKE" in optimized(columns.cast_to_schema(df, S.RESULT).select("IdNum"))


def test_views_run_compiled(spark, tmp_path):
    session = spark.newSession()
    session.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    session.range(3).select(F.col("id").alias("n_nationkey")).write.parquet(f"{tmp_path}/nation.parquet")
    assert views.view(session, str(tmp_path), "SELECT * FROM {nation}").count() == 3
    assert int(session.conf.get("spark.sql.codegen.hugeMethodLimit")) == 8000


def test_new_ids_are_not_filtered_once_more_below(spark, tmp_path):
    for name, ids in (("new", ["A_WQX-1", "A-1", "A-2", "B_WQX-3"]), ("old", ["B-3", "C-1"])):
        spark.createDataFrame([(i,) for i in ids], "StationId string").write.parquet(f"{tmp_path}/{name}")
    new, old = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("new", "old"))
    kept = dedupe.remove_stored_twins(dedupe.new_station_ids(new, old), old)
    assert sorted(r.StationId for r in kept.collect()) == ["A-1", "A_WQX-1"]
    assert not [line for line in optimized(kept).split("\n") if "Filter" in line and "Contains(" in line]


def test_a_window_computes_its_day_once(spark):
    rows = spark.range(20).select(F.concat(F.lit("2011-01-"), F.lpad((F.col("id") + 1).cast("string"), 2, "0")).alias("SampleDate"))
    day = datetime.date(2011, 1, 3)
    window = wqp.results_window(rows, day, day)
    assert [r.SampleDate for r in window.collect()] == ["2011-01-03"]
    conditions = [line for line in optimized(window).split("\n") if "Filter" in line]
    assert sum(line.count("2011-01-,") for line in conditions) == 1


@pytest.mark.parametrize("by", [None, "source_file"])
def test_an_extract_is_landed_by_several_tasks(spark, tmp_path, by):
    rows = spark.range(0, 400, 1, 4).select(
        F.concat(F.lit("S-"), F.col("id") % 40).alias("SampleId"), F.concat(F.lit("file-"), F.col("id") % 2).alias("source_file")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        queries._land(rows if by else rows.drop("source_file"), S.WQP_RESULT_COLUMNS, f"{tmp_path}/out", *((by, F.col("SampleId")) if by else ()))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len([f for f in os.listdir(f"{tmp_path}/out") if f.endswith(".csv")]) >= 4
    found = spark.read.csv(f"{tmp_path}/out", header=True).select("ActivityIdentifier", F.col("_metadata.file_path").alias("file"))
    assert found.count() == 400
    if by:
        assert found.groupBy("ActivityIdentifier").agg(F.countDistinct("file").alias("n")).where("n > 1").isEmpty()
