"""Throughput on more rows and with one hot day; for measuring by hand.

    python tools/scale_probe.py [copies] [sf_dir]

Every trip of the input is repeated ``copies`` times and a third of all trips is
moved to one day.  Prints seconds and rows per second for each step.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from velo_contract import derived  # noqa: E402
from veloclima import operators as op  # noqa: E402
from veloclima import plans, sinks, sources  # noqa: E402
from veloclima.schema import TRIP_COLUMNS  # noqa: E402
from veloclima.session import build_session, scratch_folder  # noqa: E402


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 20
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    spark = build_session(
        "veloclima-scale",
        master="local[8]",
        extra={
            "spark.driver.memory": "10g",
            "spark.sql.shuffle.partitions": "32",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    hot = F.lit("2024-01-15 08:00:00").cast("timestamp_ntz")
    copy = F.explode(F.sequence(F.lit(1), F.lit(copies)))
    many = (
        derived.stored_trips(spark, sf_dir)
        .repartition(32)
        .withColumn("copy", copy)
        .withColumn("ride_id", F.concat_ws("-", "ride_id", "copy"))
        .withColumn(
            "started_at", F.when(F.col("copy") % 3 == 0, hot).otherwise(F.col("started_at"))
        )
        .select(*TRIP_COLUMNS)
    )
    place = scratch_folder(spark, "scale-trips")
    sinks.write_months(many, place)
    trips = sources.read_trips_parquet(spark, place).select(*TRIP_COLUMNS)
    weather = derived.weather(spark, sf_dir)
    rows = trips.count()
    print(f"{rows} trips", flush=True)

    def timed(label, action):
        started = time.perf_counter()
        action()
        took = time.perf_counter() - started
        print(f"{label:34s} {took:8.2f} s {rows / took / 1e6:8.2f} M rows/s", flush=True)

    def drain(df):
        df.write.format("noop").mode("overwrite").save()

    enriched = scratch_folder(spark, "scale-enriched")
    for _ in range(2):
        timed("scan", lambda: drain(trips))
        timed("drop_na_any", lambda: drain(op.drop_na_any(trips)))
        timed("add_distance", lambda: drain(op.add_distance(trips)))
        timed("enrich_trips", lambda: drain(plans.enrich_trips(trips, weather)))
        timed("daily_extremes", lambda: drain(plans.daily_extremes(trips, weather)))
    timed("enrich_trips, written by month", lambda: sinks.append_months(
        plans.enrich_trips(trips, weather), enriched))
    stored = spark.read.parquet(enriched)
    timed("report over the stored table", lambda: drain(op.weather_daily_avg(stored)))

    dated = op.add_date_key(trips)
    timed("join, broadcast", lambda: drain(op.join_weather(dated, weather)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    timed("join, sorted", lambda: drain(op.join_weather(dated, weather)))
    timed("join, sorted, salt=16", lambda: drain(op.join_weather(dated, weather, salt=16)))
    spark.stop()


if __name__ == "__main__":
    main()
