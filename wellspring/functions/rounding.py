"""Rounding a double to two decimals on its exact binary value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = 134217729.0  # 2**27 + 1 cuts a double into two 26-bit halves


def round2(x: Column) -> Column:
    """Round half to even at two decimals, ties judged on the exact value.

    ``round`` and ``bround`` work on the shortest decimal text of a double, so
    they see a tie in 2.675 although the stored number lies below it. Here the
    product ``100 * x`` is kept as a rounded part and its exact remainder, of which
    only the sign of a sum is used, and that is exact.

    From 2**46 on neighbouring doubles are at least 1/64 apart, more than twice the
    0.005 that rounding can move, so ``x`` is the double nearest to its own rounding
    and is returned as it is. Below, ``100 * x`` stays under 2**53, where a rounded
    product without a fraction can still stand for a tie on either side.

    ``x`` should be a plain column: it is used several times.
    """
    scaled = x * 100.0
    high = x * _SPLIT - (x * _SPLIT - x)
    remainder = (high * 100.0 - scaled) + (x - high) * 100.0
    low = F.floor(scaled)
    odd = F.pmod(low, F.lit(2)) == 1
    side = (scaled - low - 0.5) + remainder
    up = (side > 0) | ((side == 0) & odd)
    down = (scaled == low) & (remainder == -0.5) & odd
    rounded = (low + F.when(up, 1).when(down, -1).otherwise(0)) / F.lit(100.0)
    return F.when(F.abs(x) < 2.0**46, rounded).otherwise(x)
