"""Operators in their working order.  Nothing runs until a sink does.

``ingest_trips``, ``enrich_trips`` and ``ingest_and_enrich`` differ in one way that
changes results.  Ingest turns a missing station name into text, so the later
clean-up in ``enrich_trips`` keeps that row; ``ingest_and_enrich`` cleans first and
drops it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions import DEFAULT_TARIFF
from ..functions.fares import Fare
from ..operators import (
    add_cost,
    add_date_key,
    add_distance,
    add_travel_time,
    both_ends,
    cast_trips,
    date_as_text,
    drop_na_any,
    join_weather,
    parse_timestamps,
    weather_daily_avg_from_trips,
)
from ..schema import TRIP_COLUMNS, TRIPS, TRIPS_ENRICHED


def ingest_trips(
    raw: DataFrame, null_text: str | None = "nan", keep: Sequence[str] = ()
) -> DataFrame:
    """Text trips to typed trips; ``keep`` names further columns to carry along."""
    layout = T.StructType([*TRIPS.fields, *[raw.schema[c] for c in keep]])
    return cast_trips(parse_timestamps(raw), null_text, layout)


def _measured(
    trips: DataFrame, tariff: Sequence[Fare] | DataFrame, cost_basis: str
) -> DataFrame:
    timed = add_travel_time(add_distance(parse_timestamps(trips)))
    return add_cost(timed, tariff, cost_basis)


def enrich_trips(
    trips: DataFrame,
    weather: DataFrame,
    tariff: Sequence[Fare] | DataFrame = DEFAULT_TARIFF,
    cost_basis: str = "distance",
    collision: str = "suffix",
    salt: int | None = None,
) -> DataFrame:
    """Ingested trips to complete trips with distance, time, cost and weather."""
    measured = _measured(drop_na_any(trips), tariff, cost_basis)
    joined = join_weather(add_date_key(measured), weather, collision=collision, salt=salt)
    return date_as_text(joined)


def ingest_and_enrich(
    raw: DataFrame,
    weather: DataFrame,
    tariff: Sequence[Fare] | DataFrame = DEFAULT_TARIFF,
    cost_basis: str = "distance",
    null_text: str | None = "nan",
    collision: str = "suffix",
    salt: int | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Both steps over text trips in one pass, incomplete rows dropped first.

    Times and numbers are typed before that, so that a coordinate written ``NaN`` counts as
    missing; ``keep`` names further columns to carry along.
    """
    typed = ingest_trips(raw, None, keep)
    measured = _measured(drop_na_any(typed, list(TRIP_COLUMNS)), tariff, cost_basis)
    layout = T.StructType([*TRIPS_ENRICHED.fields, *[raw.schema[c] for c in keep]])
    done = cast_trips(measured, null_text, layout)
    joined = join_weather(add_date_key(done), weather, collision=collision, salt=salt)
    return date_as_text(joined)


def join_only(
    trips: DataFrame, weather: DataFrame, collision: str = "suffix", salt: int | None = None
) -> DataFrame:
    """Trips with the day's weather: nothing dropped for NULLs, nothing measured."""
    joined = join_weather(add_date_key(trips), weather, collision=collision, salt=salt)
    return date_as_text(joined)


def daily_extremes(trips: DataFrame, weather: DataFrame, n: int = 10) -> DataFrame:
    """Raw trips to the n best and n worst days.

    Trips shrink to one row per day before they meet the weather: no single trip is
    shuffled, and a busy day is one row per task.
    """
    measured = add_distance(drop_na_any(trips))
    return both_ends(weather_daily_avg_from_trips(measured, weather), n)
