"""Harmonisation of names, units, codes and groups by lookup joins.

The built-in tables are small and fixed, so their joins are broadcast and the
detail rows are never shuffled. A table the caller supplies is joined without a
hint: Spark broadcasts it only if its size allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip_twin_mark, trimmed
from ..model import lookups


def normalize_station_type(df: DataFrame, types: DataFrame | None = None) -> DataFrame:
    """Map StationType to its class; an unknown type passes through."""
    if types is None:
        types = lookups.station_types(df.sparkSession)
    else:
        types = types.groupBy("type").agg(F.min("new_type").alias("new_type"))
    return (
        df.join(types, F.col("StationType") == F.col("type"), "left")
        .withColumn("StationType", F.coalesce("new_type", "StationType"))
        .drop("type", "new_type")
    )


def normalize_station(df: DataFrame, types: DataFrame | None = None) -> DataFrame:
    """Station clean-up: strip the twin mark from the id, harmonise the type."""
    return normalize_station_type(df.withColumn("StationId", strip_twin_mark(F.col("StationId"))), types)


def normalize_media(df: DataFrame) -> DataFrame:
    """Expand the sample media codes; anything else is only trimmed."""

    def expanded(media: Column, otherwise: Column) -> Column:
        cases = F
        for code, name in lookups.SAMPLE_MEDIA.items():
            cases = cases.when(media == code, name)
        return cases.otherwise(otherwise)

    # Most cells are a code as it is; only the others are trimmed, once per code.
    media = F.col("SampMedia")
    return df.withColumn("SampMedia", expanded(media, expanded(trimmed(media), trimmed(media))))


def apply_unit_rules(df: DataFrame, rules: DataFrame | None = None, source: str | None = None) -> DataFrame:
    """Lower-case Param, then apply the rule for (Param, Unit) if there is one.

    A rule may scale ResultValue, replace Unit and rename Param. The unit is
    compared as written. ``rules`` replaces the built-in table and has the
    columns param, unit, factor, new_unit, new_param and, when several rules
    share a key, prio (lowest first).
    """
    if rules is None:
        rules = lookups.unit_rules(df.sparkSession, source)
    elif "prio" in rules.columns:
        effect = F.struct("factor", "new_unit", "new_param")
        rules = rules.groupBy("param", "unit").agg(F.min_by(effect, F.col("prio")).alias("e")).select("param", "unit", "e.*")
    lowered = df.withColumn("Param", F.lower("Param"))
    rules = rules.select(F.col("param").alias("_param"), F.col("unit").alias("_unit"), "factor", "new_unit", "new_param")
    return (
        lowered.join(rules, (F.col("Param") == F.col("_param")) & (F.col("Unit") == F.col("_unit")), "left")
        .withColumns(
            {
                "ResultValue": F.when(F.col("factor").isNull(), F.col("ResultValue")).otherwise(
                    F.col("ResultValue") * F.col("factor")
                ),
                "Unit": F.coalesce("new_unit", "Unit"),
                "Param": F.coalesce("new_param", "Param"),
            }
        )
        .drop("_param", "_unit", "factor", "new_unit", "new_param")
    )


def add_param_group(df: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Set ParamGroup from the (renamed) Param; no match keeps the prior value.

    ``groups`` is the user's table with columns param and param_group; the
    default covers the analyte classes.
    """
    if groups is None:
        groups = lookups.param_groups(df.sparkSession)
    else:
        groups = groups.groupBy("param").agg(F.min("param_group").alias("param_group"))
    groups = groups.select(F.col("param").alias("_param"), "param_group")
    return (
        df.join(groups, F.col("Param") == F.col("_param"), "left")
        .withColumn("ParamGroup", F.coalesce("param_group", "ParamGroup"))
        .drop("_param", "param_group")
    )


def normalize_results(
    df: DataFrame,
    rules: DataFrame | None = None,
    groups: DataFrame | None = None,
    source: str | None = None,
) -> DataFrame:
    """All result clean-up. A row without Param keeps its value and unit, since
    no rule or group matches NULL."""
    df = normalize_media(df).withColumn("StationId", strip_twin_mark(F.col("StationId")))
    return add_param_group(apply_unit_rules(df, rules, source), groups)
