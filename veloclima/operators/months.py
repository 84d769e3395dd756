"""Choosing months and finding missing ones."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import month_runs


def with_month(df: DataFrame, stamp: str = "started_at") -> DataFrame:
    """Add ``year`` and ``month`` unless the table is already partitioned by them."""
    if {"year", "month"} <= set(df.columns):
        return df
    return df.withColumns({"year": F.year(stamp), "month": F.month(stamp)})


def month_select(
    df: DataFrame, year: int | str, months: Iterable[int | str], stamp: str = "started_at"
) -> DataFrame:
    """Keep the trips of the given months of one year.

    A month-partitioned table is filtered on its partition columns, so other
    months are never listed or opened.  Otherwise the months become time ranges,
    which the Parquet reader checks against its row-group statistics.
    """
    year, months = int(year), list(months)
    runs = month_runs(year, months)
    if not runs:
        return df.limit(0)
    if {"year", "month"} <= set(df.columns):
        wanted = sorted({int(m) for m in months})
        return df.filter((F.col("year") == year) & F.col("month").isin(wanted))

    def moment(day: str):
        return F.lit(f"{day} 00:00:00").cast("timestamp_ntz")

    ranges = [(F.col(stamp) >= moment(a)) & (F.col(stamp) < moment(b)) for a, b in runs]
    return df.filter(reduce(lambda a, b: a | b, ranges))


def months_between(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Every (year, month) from ``first`` to ``last``, each given as ``yyyy-MM``."""
    days = F.sequence(
        F.to_date(F.lit(f"{first}-01")), F.to_date(F.lit(f"{last}-01")), F.expr("interval 1 month")
    )
    return (
        spark.range(1)
        .select(F.explode(days).alias("_day"))
        .select(F.year("_day").alias("year"), F.month("_day").alias("month"))
    )


def months_present(df: DataFrame, stamp: str = "started_at") -> DataFrame:
    """(year, month) that have trips: counted, since counts may come from file footers."""
    counts = with_month(df, stamp).groupBy("year", "month").agg(F.count(F.lit(1)).alias("_n"))
    return counts.where("_n > 0").select("year", "month")


def month_coverage(df: DataFrame, expected: DataFrame, stamp: str = "started_at") -> DataFrame:
    """The expected (year, month) rows that have no trip.

    Only the years that ``expected`` spans are looked at: on a month-partitioned table the
    others are never listed or opened.
    """
    span = expected.agg(F.min("year").alias("first"), F.max("year").alias("last")).first()
    if span["first"] is None:
        return expected
    if {"year", "month"} <= set(df.columns):
        near = df.filter(F.col("year").between(span["first"], span["last"]))
    else:
        low, high = (F.lit(f"{y:04d}-01-01 00:00:00").cast("timestamp_ntz") for y in (span["first"], span["last"] + 1))
        near = df.filter((F.col(stamp) >= low) & (F.col(stamp) < high))
    return expected.join(months_present(near, stamp), ["year", "month"], "left_anti")


def count_by_month(df: DataFrame, stamp: str = "started_at") -> DataFrame:
    """Trips per month, and one more row with NULL year and month for all of them.

    The total adds up the month counts: one look at the trips, one shuffle reused.
    """
    counts = with_month(df, stamp).groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"))
    nothing = F.lit(None).cast("int")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return counts.unionByName(total.withColumns({"year": nothing, "month": nothing}))
