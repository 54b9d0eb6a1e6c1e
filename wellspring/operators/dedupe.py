"""Which stations and results are new, and which are duplicates.

Key sets are made distinct (with map-side combine) before they meet the rows, see
:mod:`wellspring.operators.skew` on ids with most of the rows. No key ever reaches the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import has_twin_mark, strip_twin_mark
from .skew import keep_known, keep_new

SAMPLE_KEY = ("SampleDate", "SampleId", "Param")


def distinct_ids(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def new_station_ids(rows: DataFrame, stations: DataFrame) -> DataFrame:
    """Distinct station ids of ``rows`` that the station table does not hold."""
    return distinct_ids(rows, "StationId").join(distinct_ids(stations, "StationId"), "StationId", "left_anti")


def new_results_by_sample(results: DataFrame, stored: DataFrame) -> DataFrame:
    """Result rows whose SampleId is not stored yet."""
    return keep_new(results, stored, "SampleId")


def new_results_by_key(results: DataFrame, stored: DataFrame) -> DataFrame:
    """Result rows whose (day, SampleId, Param) is not stored yet.

    The comparison uses Param as the source spells it.
    """
    day = F.col("SampleDate").cast("date")
    keys = stored.select(day.alias("_day"), "SampleId", "Param")
    return keep_new(results.withColumn("_day", day), keys, ["_day", "SampleId", "Param"]).drop("_day")


def stations_by_id(stations: DataFrame, ids: DataFrame) -> DataFrame:
    """Station rows whose id is in ``ids``."""
    return keep_known(stations, ids, "StationId")


def twin_ids(stations: DataFrame, scope: tuple[str, ...] = ()) -> DataFrame:
    """Plain ids (per scope) that also occur with the twin mark."""
    marked = stations.where(has_twin_mark(F.col("StationId")))
    return marked.select(*scope, strip_twin_mark(F.col("StationId")).alias("StationId")).distinct()


def drop_twins(stations: DataFrame, scope: tuple[str, ...] = ()) -> DataFrame:
    """Drop a plain station when its marked twin is in the same scope.

    ``scope`` names the columns a batch is told by, such as the source file. A
    stripped id carries no mark, so the marked rows themselves always stay.
    """
    return keep_new(stations, twin_ids(stations, scope), [*scope, "StationId"])


def remove_stored_twins(ids: DataFrame, stations: DataFrame) -> DataFrame:
    """New station ids less those whose stripped form is already stored.

    Without any marked id the list stays as it is. Once there is one, only ids
    survive whose stripped form belongs to a marked id that is not stored.
    """
    # Every step takes the ids as they are, without a filter that would go down to the
    # rows they come from; so those are read once and not once per step.
    ids = ids.select("StationId", strip_twin_mark(F.col("StationId")).alias("_plain"), has_twin_mark(F.col("StationId")).alias("_marked"))
    any_marked = ids.agg(F.coalesce(F.max("_marked"), F.lit(False))).scalar()
    stored = stations.select(F.col("StationId").alias("_plain"), F.lit(True).alias("_stored")).distinct()
    return (
        ids.withColumn("_twin", F.max("_marked").over(W.partitionBy("_plain")))
        .join(stored, "_plain", "left")
        .where(~any_marked | (F.col("_twin") & F.col("_stored").isNull()))
        .select("StationId")
    )
