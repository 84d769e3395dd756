"""Rounding that agrees with numpy to the last bit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(value: Column, places: int) -> Column:
    """Scale, round to the nearest even integer, scale back.

    ``round`` moves ties away from zero, and ``bround`` looks at the decimal
    digits rather than at the scaled double; both differ on real fares.
    """
    scale = float(10**places)
    return F.rint(value * F.lit(scale)) / F.lit(scale)
