"""Columns added to a trip: distance, travel time, cost, day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    DEFAULT_TARIFF,
    calendar_day,
    fare,
    geodesic_metres,
    minutes_between,
    round_half_even,
)
from ..functions.fares import Fare
from .weather import broadcast_bytes


def add_distance(df: DataFrame) -> DataFrame:
    """``distance``: metres over the ellipsoid between start and end, 2 dp."""
    metres = geodesic_metres("start_lat", "start_lng", "end_lat", "end_lng")
    return df.withColumn("distance", F.round(metres, 2))


def add_travel_time(df: DataFrame) -> DataFrame:
    """``travel_time``: minutes, 1 dp.  Negative if the trip ends before it starts."""
    minutes = minutes_between("started_at", "ended_at")
    return df.withColumn("travel_time", round_half_even(minutes, 1))


def add_cost(
    df: DataFrame,
    tariff: Sequence[Fare] | DataFrame = DEFAULT_TARIFF,
    basis: str = "distance",
    salt: int = 16,
    salt_on: str = "ride_id",
) -> DataFrame:
    """``cost``: base + rate x ``basis``, 3 dp; 0 when the tariff has no such row.

    ``basis`` is ``distance`` (metres) or ``travel_time`` (minutes).  A short
    tariff compiles into the projection.  A tariff table is measured first: below the
    broadcast threshold it goes to the trips, beyond it the join is salted ``salt`` times, so
    that a common pair of type and membership is not one task.
    """
    if basis not in ("distance", "travel_time"):
        raise ValueError(f"basis must be 'distance' or 'travel_time', not {basis!r}")
    if not isinstance(tariff, DataFrame):
        return df.withColumn("cost", round_half_even(fare(tariff, F.col(basis)), 3))

    key = ["rideable_type", "member_casual"]
    twice = F.raise_error("two tariff rows for one bike type and membership")
    fares = tariff.groupBy(*key).agg(
        F.when(F.count(F.lit(1)) > 1, twice).otherwise(F.max("base")).alias("_base"),
        F.max("rate").alias("_rate"),
    )
    price = F.when(F.col("_base").isNull(), F.lit(0.0)).otherwise(
        F.col("_base") + F.col("_rate") * F.col(basis)
    )
    texts = F.octet_length("rideable_type") + F.octet_length("member_casual")
    size = tariff.agg(F.sum(F.coalesce(texts, F.lit(0)) + 64)).first()[0] or 0
    if size <= broadcast_bytes(df.sparkSession):
        joined = df.join(F.broadcast(fares), key, "left")
    else:
        bucket = F.pmod(F.xxhash64(salt_on), F.lit(salt)).cast("int")
        copies = F.explode(F.sequence(F.lit(0), F.lit(salt - 1)))
        joined = df.withColumn("_salt", bucket).join(
            fares.withColumn("_salt", copies), [*key, "_salt"], "left"
        )
    joined = joined.select(*df.columns, "_base", "_rate")
    return joined.withColumn("cost", round_half_even(price, 3)).drop("_base", "_rate")


def add_date_key(df: DataFrame, stamp: str = "started_at", as_text: bool = False) -> DataFrame:
    """``date``: the calendar day of ``stamp``; text on request, for output."""
    day = calendar_day(stamp)
    return df.withColumn("date", day.cast("string") if as_text else day)


def date_as_text(df: DataFrame) -> DataFrame:
    """Render ``date`` as ``yyyy-MM-dd`` text."""
    return df.withColumn("date", calendar_day("date").cast("string"))
