"""Rows whose key is, or is not, in another table.

A key with most of the rows makes a partition that is large on the side of the rows.
Adaptive execution measures partitions while both sides are shuffled and splits such a
one, which semi and anti joins allow; rows with a NULL key form one such partition too.
It does so only where a side's shuffle feeds the join directly. A plain ``distinct`` of
the keys would stand between, since its shuffle by key serves the join as well, so
copies of a key are combined per key and slice instead, on the map side first, and at
most ``SLICES`` copies of a key meet the rows.

:data:`wellspring.session.SETTINGS` allows a split even where a later step then needs a
shuffle of its own. The rows are read once, and nothing about them is counted
beforehand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICES = 4


def few_copies(keys: DataFrame, on: list[str]) -> DataFrame:
    """The keys with at most ``SLICES`` copies of each."""
    part = F.pmod(F.spark_partition_id(), F.lit(SLICES))
    return keys.select(*on, part.alias("_slice")).distinct().select(*on)


def keep_known(rows: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``."""
    on = [on] if isinstance(on, str) else list(on)
    return rows.join(few_copies(keys, on), on, "left_semi").select(*rows.columns)


def keep_new(rows: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key does not occur in ``keys``; rows with a NULL key stay."""
    on = [on] if isinstance(on, str) else list(on)
    return rows.join(few_copies(keys, on), on, "left_anti").select(*rows.columns)
