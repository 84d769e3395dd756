from .trips import (
    PANDAS_NULL_WORDS,
    file_month,
    month_files,
    months_with_files,
    read_for_counts,
    read_months,
    read_table,
    read_table_for_counts,
    read_trips_csv,
    read_trips_parquet,
    read_trips_zip,
    timestamps_from_nanos,
    trips_from_archives,
)
from .weather import read_weather

__all__ = [
    "PANDAS_NULL_WORDS",
    "file_month",
    "month_files",
    "months_with_files",
    "read_for_counts",
    "read_months",
    "read_table",
    "read_table_for_counts",
    "read_trips_csv",
    "read_trips_parquet",
    "read_trips_zip",
    "read_weather",
    "timestamps_from_nanos",
    "trips_from_archives",
]
