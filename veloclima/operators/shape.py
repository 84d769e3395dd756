"""Projections, previews and unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar_day
from ..schema import TRIP_COLUMNS


def limit_rows(df: DataFrame, n: int, order_by: str | None = None) -> DataFrame:
    """Any n rows, or the first n by ``order_by`` (a top-n, never a full sort)."""
    return (df.orderBy(order_by) if order_by else df).limit(n)


def project_trips(df: DataFrame, n: int | None = 100, order_by: str | None = None) -> DataFrame:
    """Day first, then the trip columns; a preview of n rows, or all with ``None``."""
    named = df.select("date", *TRIP_COLUMNS)
    return named if n is None else limit_rows(named, n, order_by)


def select_all_limit(df: DataFrame, n: int = 100, order_by: str | None = None) -> DataFrame:
    return limit_rows(df.select("*"), n, order_by)


def project_day_and_year(df: DataFrame) -> DataFrame:
    """A four-column view: start time under ``date``, its day as text under ``year``.

    ``year`` holds a day for compatibility; ``start_year`` is the year itself.
    """
    return df.select(
        "ride_id",
        "rideable_type",
        F.col("started_at").alias("date"),
        "member_casual",
        calendar_day("started_at").cast("string").alias("year"),
        F.year("started_at").alias("start_year"),
    )


def drop_index_col(df: DataFrame, name: str = "__index_level_0__") -> DataFrame:
    """Drop the index column a pandas writer may have left behind."""
    return df.drop(name)


def multi_month_union(*months: DataFrame) -> DataFrame:
    """All rows of all months, columns matched by name; duplicates stay."""
    if not months:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b), months)
