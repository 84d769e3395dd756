"""Fixed table layouts.  Nothing in this package infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: the trip layout, in file order -------------------------
TRIP_COLUMNS: dict[str, T.DataType] = {
    "ride_id": T.StringType(),
    "rideable_type": T.StringType(),
    "started_at": T.TimestampNTZType(),
    "ended_at": T.TimestampNTZType(),
    "start_station_name": T.StringType(),
    "start_station_id": T.StringType(),
    "end_station_name": T.StringType(),
    "end_station_id": T.StringType(),
    "start_lat": T.DoubleType(),
    "start_lng": T.DoubleType(),
    "end_lat": T.DoubleType(),
    "end_lng": T.DoubleType(),
    "member_casual": T.StringType(),
}
DERIVED_COLUMNS: dict[str, T.DataType] = {
    "distance": T.DoubleType(),  # metres, 2 dp
    "travel_time": T.DoubleType(),  # minutes, 1 dp
    "cost": T.DoubleType(),  # price, 3 dp
}
# ---------------------------------------------------------------------------


def _struct(columns: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


TRIPS = _struct(TRIP_COLUMNS)
TRIPS_TEXT = _struct(dict.fromkeys(TRIP_COLUMNS, T.StringType()))
TRIPS_ENRICHED = _struct({**TRIP_COLUMNS, **DERIVED_COLUMNS})
WEATHER = _struct(
    {"datetime": T.StringType(), "icon": T.StringType(), "tempmax": T.DoubleType()}
)
TARIFF = _struct(
    {
        "rideable_type": T.StringType(),
        "member_casual": T.StringType(),
        "base": T.DoubleType(),
        "rate": T.DoubleType(),
    }
)
