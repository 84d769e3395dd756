"""The daily weather dimension and its join to trips."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar_day, utc_day


def rename_weather_key(weather: DataFrame) -> DataFrame:
    """``datetime`` becomes ``date``; nothing happens if that was done already."""
    return weather.withColumnRenamed("datetime", "date")


def key_day(df: DataFrame, key: str = "date", zone: str = "UTC") -> Column:
    """The key as DATE.  A TIMESTAMP is a moment: its day is that of ``zone``, not the session's."""
    if dict(df.dtypes)[key] == "timestamp":
        return utc_day(F.col(key), zone)
    return calendar_day(key)


def weather_date_text(weather: DataFrame, zone: str = "UTC") -> DataFrame:
    """The weather day as ``yyyy-MM-dd`` text, also when it came as a timestamp."""
    renamed = rename_weather_key(weather)
    return renamed.withColumn("date", key_day(renamed, "date", zone).cast("string"))


def column_overlap(trips: DataFrame, weather: DataFrame, key: str = "date") -> list[str]:
    """Columns other than the key that both tables have, in trip order."""
    right = {c.lower() for c in weather.columns}
    return [c for c in trips.columns if c.lower() in right and c.lower() != key]


def broadcast_bytes(spark: SparkSession) -> int:
    """The session's broadcast threshold; -1 where broadcasts are off."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if text.startswith("-"):
        return -1
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


def planned_bytes(df: DataFrame) -> int:
    """The size Spark plans with, by which it decides about a broadcast."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def hot_days(trips: DataFrame, day: str = "date", tasks: int | None = None) -> tuple[list[dt.date], int]:
    """Days with more than twice a task's share of the trips, and tasks that the largest needs.

    Trips are counted by day: one pass over that column, partial sums, one row per day and
    task shuffled.  At most ``tasks`` / 2 days can be hot, and no more reach the driver.
    """
    tasks = tasks or int(trips.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    seen = Observation()
    counts = trips.where(F.col(day).isNotNull()).groupBy(F.col(day).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    watched = counts.observe(seen, F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    largest = watched.orderBy(F.desc("n"), "day").limit(tasks // 2 + 1).collect()
    share = seen.get["total"] / tasks
    hot = [r for r in largest if r.n > 2 * share]
    return [r.day for r in hot], min(tasks, -int(-hot[0].n // share)) if hot else 1


def join_weather(
    trips: DataFrame,
    weather: DataFrame,
    collision: str = "suffix",
    salt: int | None = 1,
    salt_on: str = "ride_id",
    zone: str = "UTC",
) -> DataFrame:
    """Inner join of trips to the weather of their day.

    Trips need ``date`` (see :func:`add_date_key`); both sides are brought to
    DATE, so text, date and timestamp keys meet.  A key of type TIMESTAMP is a moment,
    and ``zone`` says whose day it counts for.  Trips of a day without weather
    drop out, and a day with two weather rows doubles its trips.

    No broadcast hint is given: Spark compares the weather file's size with
    ``spark.sql.autoBroadcastJoinThreshold`` and ships it whole only below that.
    Beyond it the join sorts by day; ``salt=n`` then spreads each day's trips
    over n tasks (by a hash of ``salt_on``, so a retried task repeats its choice)
    against n copies of its weather rows: one busy day is not one task.  ``salt=None`` lets the
    data say so: where the weather is too large to be shipped, trips are counted by day
    (:func:`hot_days`), and only days with far more than a task's share are spread.

    Columns found on both sides get ``_x`` (trips) and ``_y`` (weather);
    ``collision='raise'`` refuses them instead.
    """
    if collision not in ("suffix", "raise"):
        raise ValueError(f"collision must be 'suffix' or 'raise', not {collision!r}")
    if salt is not None and salt < 1:
        raise ValueError("salt counts buckets: 1 or more")
    weather = rename_weather_key(weather)
    shared = column_overlap(trips, weather)
    if shared and collision == "raise":
        raise ValueError(f"trips and weather both have {shared}")
    lowered = {c.lower() for c in shared}
    trips = trips.withColumnsRenamed({c: f"{c}_x" for c in shared})
    weather = weather.withColumnsRenamed(
        {c: f"{c}_y" for c in weather.columns if c.lower() in lowered}
    )
    order = trips.columns + [c for c in weather.columns if c != "date"]

    left = trips.withColumn("date", key_day(trips, "date", zone))
    right = weather.withColumn("date", key_day(weather, "date", zone))
    key, spread = ["date"], F.lit(True)
    if salt is None:
        shipped = planned_bytes(right) <= broadcast_bytes(trips.sparkSession)
        days, salt = ([], 1) if shipped else hot_days(left)
        spread = F.col("date").isin(days) if days else spread
    if salt > 1:
        bucket = F.pmod(F.xxhash64(salt_on), F.lit(salt)).cast("int")
        left = left.withColumn("_salt", F.when(spread, bucket).otherwise(0))
        copies = F.sequence(F.lit(0), F.when(spread, F.lit(salt - 1)).otherwise(0))
        right = right.withColumn("_salt", F.explode(copies))
        key.append("_salt")
    return left.join(right, key, "inner").select(*order)
