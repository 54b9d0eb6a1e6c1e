"""The part every load shares: from renamed source rows to target rows."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import schema as S
from ..operators.balance import charge_balance
from ..operators.columns import cast_to_schema, reorder_to_schema, tag_source
from ..operators.normalize import normalize_results, normalize_station
from ..operators.spatial import add_shape


@dataclass(frozen=True)
class Tables:
    """A user's own lookup tables; None stands for the built-in one."""

    unit_rules: DataFrame | None = None
    param_groups: DataFrame | None = None
    station_types: DataFrame | None = None
    rules_for_source: bool = False


def transform_stations(
    df: DataFrame, tag: str, as_of: Column | datetime.datetime | None = None, tables: Tables = Tables(), need_shape: bool = False, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Cast, tag, shape, normalise and reorder station rows. No shuffle. Columns named in
    ``keep`` stay beside the schema's.

    With ``need_shape`` stations without a usable point are dropped.
    """
    df = add_shape(tag_source(cast_to_schema(df, S.STATION, as_of), tag))
    if need_shape:
        df = df.where(F.col("Shape").isNotNull())
    return reorder_to_schema(normalize_station(df, tables.station_types), S.STATION, keep)


def detail_results(
    df: DataFrame, tag: str, as_of: Column | datetime.datetime | None = None, tables: Tables = Tables()
) -> DataFrame:
    """Cast, tag and normalise result rows. Columns beyond the schema stay."""
    df = tag_source(cast_to_schema(df, S.RESULT, as_of), tag)
    source = tag if tables.rules_for_source else None
    return normalize_results(df, tables.unit_rules, tables.param_groups, source)


def transform_results(
    df: DataFrame,
    tag: str,
    as_of: Column | datetime.datetime | None = None,
    tables: Tables = Tables(),
    scope: tuple[str, ...] = (),
    balance: bool = True,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Result rows of one load plus the balance rows of their samples.

    Samples are told apart by the id as the source writes it and by ``scope``
    (for instance the file a row came from). The detail rows pass straight
    through; only the partial averages of the balance are shuffled. Columns named in
    ``keep``, of those in ``scope``, stay beside the schema's.
    """
    detail = detail_results(df.withColumn("_sample", F.col("SampleId")), tag, as_of, tables)
    rows = reorder_to_schema(detail, S.RESULT, keep)
    if not balance:
        return rows
    derived = charge_balance(detail, (*scope, "_sample", "SampleId"))
    return rows.unionByName(reorder_to_schema(derived, S.RESULT, keep))
