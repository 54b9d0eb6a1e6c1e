"""Projections: rename, cast to the declared schema, reorder, tag."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import casting
from ..functions.text import cut, trimmed
from ..model import schema as S

_MOMENTS = (T.TimestampNTZType, T.TimestampType, T.DateType)


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename the columns the mapping names; the others pass through."""
    return df.withColumnsRenamed({old: new for old, new in mapping.items() if old in df.columns})


def shared_fields(df: DataFrame, fields) -> list[str]:
    """Names a table has in common with a schema, in schema order."""
    present = set(df.columns)
    return [f.name for f in fields if f.name in present]


def select_shared(df: DataFrame, fields, extra: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*shared_fields(df, fields), *extra)


def tag_source(df: DataFrame, tag: str) -> DataFrame:
    return df.withColumn("DataSource", F.lit(tag))


def reorder_to_schema(df: DataFrame, fields, keep: tuple[str, ...] = ()) -> DataFrame:
    """Exactly the declared columns, in order, and those named in ``keep``; missing
    declared ones become NULL."""
    present = set(df.columns)
    return df.select(
        *(F.col(f.name) if f.name in present else F.lit(None).cast(S.working_type(f)).alias(f.name) for f in fields), *keep
    )


def utc(instant: Column) -> Column:
    """The clock in UTC at an instant, whatever the session's zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


def cast_expression(text: Column, source: T.DataType, field: S.Field) -> Column:
    """Cast rule of one field, chosen by its declared kind and the input's type.

    Text arrives trimmed. Dates are judged afterwards, see :func:`cast_to_schema`.
    """
    is_text = isinstance(source, T.StringType)
    kind = field.kind
    if kind == "string":
        return cut(text if is_text else trimmed(text.cast("string")), field.length or None)
    if kind in ("short", "long"):
        type_name = "int" if kind == "short" else "bigint"
        return casting.to_integer(text, type_name) if is_text else text.try_cast(type_name)
    if kind == "double":
        return casting.to_double(text) if is_text else text.try_cast("double")
    if kind == "date" and isinstance(source, _MOMENTS):
        return utc(text) if isinstance(source, T.TimestampType) else text.cast("timestamp_ntz")
    if kind == "time" and is_text:
        return casting.to_time(text)
    return F.lit(None).cast(S.working_type(field))


def moment(as_of: Column | datetime.datetime | None) -> Column:
    """``as_of`` as a column; nothing given means now."""
    if as_of is None:
        return F.localtimestamp()
    if isinstance(as_of, datetime.datetime):
        return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    return as_of


def cast_to_schema(df: DataFrame, fields, as_of: Column | datetime.datetime | None = None) -> DataFrame:
    """Cast every declared field; add missing ones as NULL; keep other columns.

    ``as_of`` is the moment after which a date counts as being in the future.
    The work is spread over three projections (trim, convert, judge dates) so
    that no expression repeats the one before it.
    """
    as_of = moment(as_of)
    types = {f.name: f.dataType for f in df.schema.fields}
    present = [f for f in fields if f.name in types]
    text = {f.name: trimmed(F.col(f.name)) for f in present if isinstance(types[f.name], T.StringType)}
    # A number is written once here, and its text has no blanks to trim.
    written = {f.name: F.col(f.name).cast("string") for f in present if f.kind == "string" and isinstance(types[f.name], T.NumericType)}
    df = df.withColumns(text | written)
    types |= dict.fromkeys(written, T.StringType())

    converted = {
        f.name: casting.to_timestamp(F.col(f.name), as_of)
        if f.kind == "date" and f.name in text
        else cast_expression(F.col(f.name), types[f.name], f)
        for f in present
    }
    df = df.withColumns(converted)
    dates = {f.name: casting.plausible_date(F.col(f.name), as_of) for f in present if f.kind == "date"}
    df = df.withColumns(dates)

    declared = set(names := S.names(fields))
    missing = {f.name: F.lit(None).cast(S.working_type(f)) for f in fields if f.name not in types}
    others = [name for name in df.columns if name not in declared]
    return df.withColumns(missing).select(*names, *(F.col(f"`{name}`") for name in others))


def to_storage(df: DataFrame, fields, keep: tuple[str, ...] = ()) -> DataFrame:
    """Declared columns with their stored types: dates to the day, Lat/Lon as
    decimal(9,6). A coordinate outside that range becomes NULL."""
    df = reorder_to_schema(df, fields, keep)
    return df.select(*(F.col(f.name).try_cast(S.stored_type(f)).alias(f.name) for f in fields), *keep)
