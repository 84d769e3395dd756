"""The tariff: price = base + rate x quantity, by bike type and membership."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Fare = tuple[str, str, float, float]

# --- fixed values: rideable_type, member_casual, base, rate ------------------
DEFAULT_TARIFF: tuple[Fare, ...] = (
    ("electric_bike", "member", 1.0, 0.17),
    ("electric_bike", "casual", 1.0, 0.42),
    ("classic", "member", 1.0, 0.07),
    ("classic", "casual", 1.0, 0.15),
    ("docked_bike", "member", 1.0, 0.07),
    ("docked_bike", "casual", 1.0, 0.15),
)
# ------------------------------------------------------------------------------


def fare(tariff: Sequence[Fare], quantity: Column) -> Column:
    """Price by a short tariff; 0 for a bike type or membership not in it."""
    if len({row[:2] for row in tariff}) != len(tariff):
        raise ValueError("two tariff rows for one bike type and membership")
    priced = None
    for bike, membership, base, rate in tariff:
        match = (F.col("rideable_type") == bike) & (F.col("member_casual") == membership)
        price = F.lit(float(base)) + F.lit(float(rate)) * quantity
        priced = F.when(match, price) if priced is None else priced.when(match, price)
    return F.lit(0.0) if priced is None else priced.otherwise(F.lit(0.0))
