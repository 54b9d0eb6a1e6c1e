"""Text clean-up expressions."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Every whitespace character, so that trimming takes more than blanks.
WHITESPACE = "".join(chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace())

#: The marker of a duplicate station id and what replaces it.
TWIN_MARK, TWIN_REPLACEMENT = "_WQX-", "-"


def trimmed(c: Column) -> Column:
    """Strip whitespace of all kinds from both ends.

    Nearly every cell begins and ends with a visible ASCII character, which a
    comparison and its last byte tell; only the others pay for ``btrim`` with its long
    character list. ``c`` should be a plain column: it is used several times.
    """
    ends = F.substring(c.cast("binary"), -1, 1).between(F.lit(bytearray(b"!")), F.lit(bytearray(b"~")))
    clean = (c >= F.lit("!")) & (c < F.lit("\x7f")) & ends
    return F.when(clean, c).otherwise(F.btrim(c, F.lit(WHITESPACE)))


def cut(c: Column, length: int | None = None) -> Column:
    """NULL for an empty text, else the first ``length`` characters; short values are
    passed on untouched. ``c`` should be a plain column: it is used several times."""
    size = F.octet_length(c)
    if length is None:
        return F.when(size > 0, c)
    return F.when(size.between(1, length), c).when(size > length, F.substring(c, 1, length))


def strip_twin_mark(c: Column) -> Column:
    """``ORG_WQX-1`` -> ``ORG-1``, every occurrence, case-sensitive."""
    return F.replace(c, F.lit(TWIN_MARK), F.lit(TWIN_REPLACEMENT))


def has_twin_mark(c: Column) -> Column:
    return F.contains(c, F.lit(TWIN_MARK))


def computed_once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used.

    The value is bound as the parameter of an array function, which Spark calls
    instead of writing it into the generated loop. A projection that holds one gets
    its code in many short methods; a fused loop of a wide projection would exceed the
    8000 bytes beyond which the JVM leaves a method interpreted.
    """
    return F.transform(F.array(value), use)[0]
