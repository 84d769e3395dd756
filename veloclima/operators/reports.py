"""Aggregates over enriched trips: partial counts first, then one small shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar_day, day_text
from .enrich import add_date_key
from .weather import key_day, rename_weather_key


def count_table(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def weather_daily_avg(enriched: DataFrame) -> DataFrame:
    """Average distance by day, weather icon and maximum temperature.

    Unknown weather (NULL) forms its own group; trips without a distance do not
    enter the average.  Groups form on DATE; only the groups are printed as text.
    """
    by_day = enriched.groupBy(calendar_day("date").alias("day"), "icon", "tempmax")
    return by_day.agg(F.avg("distance").alias("distance")).select(
        day_text("day").alias("day"), "icon", "tempmax", "distance"
    )


def weather_daily_avg_from_trips(
    trips: DataFrame, weather: DataFrame, zone: str = "UTC"
) -> DataFrame:
    """The same report without an enriched table in between.

    Trips shrink to one sum and count per day before they meet the weather, so
    neither the weather's size nor a busy day matters, and rows already gathered
    by day need no second shuffle.  Weather given twice for one day scales sum
    and count alike and leaves the average as it is.
    """
    per_day = (
        add_date_key(trips)
        .groupBy("date")
        .agg(F.sum("distance").alias("_sum"), F.count("distance").alias("_n"))
    )
    renamed = rename_weather_key(weather)
    days = renamed.select(key_day(renamed, "date", zone).alias("date"), "icon", "tempmax")
    total = F.try_divide(F.sum("_sum"), F.sum("_n"))
    return (
        per_day.join(days, "date")
        .groupBy("date", "icon", "tempmax")
        .agg(total.alias("distance"))
        .select(day_text("date").alias("day"), "icon", "tempmax", "distance")
    )


def top_distance(report: DataFrame, n: int = 10, ascending: bool = False) -> DataFrame:
    """The n days with the highest (lowest) average.  Ties go by day, icon, tempmax.

    A missing average sorts as the smallest value: last going down, first going up.
    """
    lead = F.col("distance").asc_nulls_first() if ascending else F.col("distance").desc_nulls_last()
    ties = [F.col(c).asc_nulls_first() for c in ("day", "icon", "tempmax")]
    return report.orderBy(lead, *ties).limit(n)


def both_ends(report: DataFrame, n: int = 10) -> DataFrame:
    """Both lists in one result; Spark aggregates once and reuses the shuffle."""
    return top_distance(report, n).withColumn("list", F.lit("highest")).unionByName(
        top_distance(report, n, ascending=True).withColumn("list", F.lit("lowest"))
    )


def report_weather_km(enriched: DataFrame) -> DataFrame:
    """Average kilometres by icon, and by maximum temperature.

    One row per icon (``dimension='icon'``) and one per temperature
    (``dimension='tempmax'``), both rolled up from one pass over the trips.
    """
    pairs = enriched.groupBy("icon", "tempmax").agg(
        F.count(F.lit(1)).alias("_trips"),
        F.sum("distance").alias("_sum"),
        F.count("distance").alias("_n"),
    )
    rolled = pairs.groupingSets(
        [[F.col("icon")], [F.col("tempmax")]], F.col("icon"), F.col("tempmax")
    ).agg(
        F.when(F.grouping("icon") == 0, F.lit("icon")).otherwise(F.lit("tempmax")).alias(
            "dimension"
        ),
        F.sum("_trips").alias("n_trips"),
        (F.try_divide(F.sum("_sum"), F.sum("_n")) / F.lit(1000.0)).alias("avg_distance_km"),
    )
    return rolled.select("dimension", "icon", "tempmax", "n_trips", "avg_distance_km")


DAILY_REPORT_SQL = """
SELECT CAST(to_date(date) AS STRING) AS day,
       icon,
       tempmax,
       avg(distance) AS distance
FROM {view}
GROUP BY to_date(date), icon, tempmax
"""


def register_view(df: DataFrame, name: str = "trips") -> str:
    """Make the table known to SQL text under ``name``."""
    df.createOrReplaceTempView(name)
    return name


def daily_report_sql(spark: SparkSession, view: str = "trips") -> DataFrame:
    """:func:`weather_daily_avg` as SQL over a registered view."""
    return spark.sql(DAILY_REPORT_SQL.format(view=view))
