"""Text -> typed value, with NULL for whatever does not parse.

Each function takes trimmed text, best a plain column: it is used several times.
ANSI mode is on by default, so every conversion is a ``try_cast``. Dates are
first rewritten to ISO text and then cast: the cast reports bad input without
raising, where a pattern-based parser throws once per bad cell.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import computed_once

_NUMBER = r"^[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:nan|inf|infinity))$"
# What may be cast to a whole number, and little more.
_INTEGER = r"^[^\w.]*\d+[^\w.]*$"
_TIME = r"^(?:[01]?\d|2[0-3])(?::[0-5]?\d){0,2}$"

# Date layouts. Group 4 is the clock, if any; am / pm is read over, since only
# the day is stored.
_CLOCK = r"(?:[ T]+(\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d+)?)?)(?: ?[AaPp][Mm])?)?$"
_SEP = r"[/.\-]"
_ISO = r"^\d{4}-\d{1,2}-\d{1,2}(?:[ T]\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d+)?)?)?$"
_YEAR_FIRST = rf"^(\d{{4}}){_SEP}(\d{{1,2}}){_SEP}(\d{{1,2}}){_CLOCK}"
_MONTH_FIRST = rf"^(0?\d|1[0-2]){_SEP}(\d{{1,2}}){_SEP}(\d{{4}}){_CLOCK}"
_DAY_FIRST = rf"^(1[3-9]|2\d|3[01]){_SEP}(\d{{1,2}}){_SEP}(\d{{4}}){_CLOCK}"
_SHORT_YEAR = rf"^(0?\d|1[0-2]){_SEP}(\d{{1,2}}){_SEP}(\d{{2}}){_CLOCK}"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})(?:T?(\d{2})(\d{2})(\d{2}))?$"
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_MONTH = (
    r"(?i:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|"
    r"aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
)
_NAME_FIRST = rf"^({_MONTH})\.?[ \-]+(\d{{1,2}}),?[ \-]+(\d{{4}}){_CLOCK}"
_NAME_SECOND = rf"^(\d{{1,2}})[ \-]+({_MONTH})\.?,?[ \-]+(\d{{4}}){_CLOCK}"


def _byte(text: Column, position: int) -> Column:
    return F.substring(text.cast("binary"), position, 1)


def _bytes(text: str) -> Column:
    return F.lit(bytearray(text.encode()))


def to_integer(text: Column, type_name: str) -> Column:
    """Whole numbers only: ``3.5`` and ``1_000`` are NULL.

    A cast that fails builds an error with its message, which costs more than all other
    casts of a row, so text that holds no such number is left out before.
    """
    return F.when(text.rlike(_INTEGER), text.try_cast(type_name))


def to_double(text: Column) -> Column:
    """Decimal and exponent forms plus nan / inf.

    A value ending in a digit or point is a plain number unless it is
    hexadecimal; for the rest a pattern keeps out forms only the JVM reads as
    numbers, such as ``1d``.
    """
    plain = _byte(text, -1).between(_bytes("."), _bytes("9")) & ~F.contains(F.lower(text), F.lit("x"))
    return F.when(plain | text.rlike(_NUMBER), text.try_cast("double"))


def _named(text: Column, pattern: str, month_group: int, day_group: int) -> Column:
    name = F.lower(F.left(F.regexp_extract(text, pattern, month_group), F.lit(3)))
    number = F.floor((F.position(name, F.lit(_MONTHS)) + 2) / 3).cast("string")
    return F.concat(
        F.regexp_extract(text, pattern, 3), F.lit("-"), number, F.regexp_replace(text, pattern, f"-${day_group} $4")
    )


def to_timestamp(text: Column, as_of: Column) -> Column:
    """Dates in the layouts the extracts use.

    Year first (``2011-01-02``, ``2011/1/2 5:30``), month first with four or two
    digits of year (``1/2/2011``, ``01/02/11``; day first only when the month
    cannot be one), compact (``20110102``), and month names (``Jan 2, 2011``,
    ``2-Jan-2011``). A two-digit year lands less than 50 years after ``as_of``.
    Incomplete dates are NULL.

    Most cells are ISO days of ten bytes, which have digits and dashes where no other
    layout has both. Only the others go through the layouts, in one expression that is
    called and not inlined: with it Spark generates short methods for the projection
    around, whatever its settings.
    """
    digit = lambda i: _byte(text, i).between(_bytes("0"), _bytes("9"))
    dash = lambda i: _byte(text, i) == _bytes("-")
    iso_day = (F.octet_length(text) == 10) & dash(5) & dash(8) & digit(2) & digit(3) & digit(4)
    iso = F.when(iso_day, text).otherwise(computed_once(text, lambda t: _as_iso(t, as_of)))
    return iso.try_cast("timestamp_ntz")


def _as_iso(text: Column, as_of: Column) -> Column:
    """Text in any layout as ISO text; NULL for no known layout."""

    def layout(pattern: str, replacement: str) -> Column:
        return F.regexp_replace(text, pattern, replacement)

    last_century = F.regexp_extract(text, _SHORT_YEAR, 3).cast("int") + 2000 >= F.year(as_of) + 50
    return (
        F.when(text.rlike(_ISO), text)
        .when(text.rlike(_MONTH_FIRST), layout(_MONTH_FIRST, "$3-$1-$2 $4"))
        .when(
            text.rlike(_SHORT_YEAR),
            F.concat(F.when(last_century, "19").otherwise("20"), layout(_SHORT_YEAR, "$3-$1-$2 $4")),
        )
        .when(text.rlike(r"^\d{8}$"), layout(_COMPACT, "$1-$2-$3"))
        .when(text.rlike(_COMPACT), layout(_COMPACT, "$1-$2-$3 $4:$5:$6"))
        .when(text.rlike(_YEAR_FIRST), layout(_YEAR_FIRST, "$1-$2-$3 $4"))
        .when(text.rlike(_DAY_FIRST), layout(_DAY_FIRST, "$3-$2-$1 $4"))
        .when(text.rlike(_NAME_FIRST), _named(text, _NAME_FIRST, 1, 2))
        .when(text.rlike(_NAME_SECOND), _named(text, _NAME_SECOND, 2, 1))
    )


def plausible_date(moment: Column, as_of: Column) -> Column:
    """NULL for dates after ``as_of`` or before the year 1800."""
    return F.when((moment <= as_of) & (F.year(moment) >= 1800), moment)


def to_time(text: Column) -> Column:
    """``H[:M[:S]]`` -> ``HH:mm:ss``.

    Most cells are ``HH:mm``, told by their bytes. The others are called and not inlined,
    see :func:`to_timestamp`.
    """
    byte = lambda i, lo, hi: _byte(text, i).between(_bytes(lo), _bytes(hi))
    hour = (byte(1, "0", "1") & byte(2, "0", "9")) | (byte(1, "2", "2") & byte(2, "0", "3"))
    minute = (F.octet_length(text) == 5) & byte(3, ":", ":") & hour & byte(4, "0", "5") & byte(5, "0", "9")
    return F.when(minute, F.concat(text, F.lit(":00"))).otherwise(computed_once(text, _as_time))


def _as_time(text: Column) -> Column:
    padded = F.concat(text, F.lit(":0:0"))
    parts = [F.lpad(F.split_part(padded, F.lit(":"), F.lit(i)), 2, "0") for i in (1, 2, 3)]
    full = (F.octet_length(text) == 8) & (_byte(text, 3) == _bytes(":")) & (_byte(text, 6) == _bytes(":"))
    valid = F.concat(F.lit("1970-01-01 "), text).try_cast("timestamp_ntz").isNotNull()
    return F.when(full & valid, text).when(text.rlike(_TIME), F.concat_ws(":", *parts))
