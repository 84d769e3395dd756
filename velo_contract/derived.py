"""Trips and weather derived from the given tables, and the tables staged from them.

No given table holds trips.  ``events`` gives one month of them, ``orders`` eighty
months; FIXTURES.md states the rules.  Staged tables are written once per session
and input folder into the shared scratch folder, then read like any other table.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veloclima.operators import cast_trips
from veloclima.plans import enrich_trips, ingest_months, ingest_trips
from veloclima.schema import TRIP_COLUMNS
from veloclima.session import scratch_folder
from veloclima.sinks import append_months, write_months, write_parquet, write_table
from veloclima.sources import read_trips_parquet, read_weather


def _micros_of_second(stamp: str) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.pmod(F.timestamp_diff("MICROSECOND", epoch, F.col(stamp)), F.lit(1_000_000))


def _seeds(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """(i, ts, user_id, value): what the trip rules start from."""
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    if table == "events":
        return df.select(F.col("event_id").alias("i"), "ts", "user_id", "value")
    second = ((F.col("o_orderkey") * 7919) % 86400).cast("long")
    return df.select(
        F.col("o_orderkey").alias("i"),
        F.timestamp_add("SECOND", second, F.col("o_orderdate").cast("timestamp_ntz")).alias("ts"),
        F.col("o_custkey").alias("user_id"),
        (F.col("o_totalprice") % 500.0).alias("value"),
    )


def trips(spark: SparkSession, sf_dir: str, table: str = "events") -> DataFrame:
    """Raw trips with the typed 13 columns and real NULLs."""
    i, user = F.col("i"), F.col("user_id")
    bike = (
        F.when(i % 4 == 0, "electric_bike")
        .when(i % 4 == 1, "classic")
        .when(i % 4 == 2, "docked_bike")
        .otherwise("classic_bike")
    )
    who = F.when(user % 13 == 5, "guest").when(user % 3 == 0, "casual").otherwise("member")
    start = F.timestamp_add("MICROSECOND", -_micros_of_second("ts"), F.col("ts"))
    lat, lng = F.col("start_lat"), F.col("start_lng")
    still = i % 23 == 0

    def numbered(prefix: str, modulus: int) -> Column:
        return F.concat(F.lit(prefix), (i % modulus).cast("string"))

    based = _seeds(spark, sf_dir, table).withColumns(
        {
            "started_at": start,
            "start_lat": F.lit(41.65) + ((i * 7919) % 40000) / 100000.0,
            "start_lng": F.lit(-87.85) + ((i * 104729) % 30000) / 100000.0,
        }
    )
    seconds = F.floor(F.col("value") * 60.0).cast("long")
    return based.select(
        i.cast("string").alias("ride_id"),
        bike.alias("rideable_type"),
        "started_at",
        F.timestamp_add("SECOND", seconds, F.col("started_at")).alias("ended_at"),
        F.when(i % 17 != 0, numbered("st", 97)).alias("start_station_name"),
        numbered("s", 97).alias("start_station_id"),
        numbered("en", 89).alias("end_station_name"),
        numbered("e", 89).alias("end_station_id"),
        "start_lat",
        "start_lng",
        F.when(i % 41 != 0, F.when(still, lat).otherwise(lat + ((i * 31) % 4000 - 2000) / 100000.0))
        .alias("end_lat"),
        F.when(still, lng).otherwise(lng + ((i * 37) % 4000 - 2000) / 100000.0).alias("end_lng"),
        who.alias("member_casual"),
    )


def weather_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day of ``events``, without days 10, 20 and 30 of a month."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    days = events.select(F.to_date("ts").alias("d")).distinct()
    day = F.dayofmonth("d")
    icon = F.when(day % 4 == 0, "rain").when(day % 4 == 1, "snow").when(day % 4 == 2, "cloudy")
    return days.filter(day % 10 != 0).select(
        F.date_format("d", "yyyy-MM-dd").alias("datetime"),
        icon.otherwise("clear-day").alias("icon"),
        ((day % 7) * 2.5 - 5.0).alias("tempmax"),
    )


def harsh_weather_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weather with a second row for every seventh day, and icons and temperatures that are unknown."""
    rows = weather_rows(spark, sf_dir)
    day = F.dayofmonth(F.to_date("datetime"))
    again = rows.where(day % 7 == 0).withColumns({"icon": F.lit("fog"), "tempmax": F.col("tempmax") + 1.0})
    unknown = {"icon": F.when(day % 5 != 0, F.col("icon")), "tempmax": F.when(day % 6 != 0, F.col("tempmax"))}
    return rows.withColumns(unknown).unionByName(again)


def far_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pair of points per event: anywhere on the globe, every other one nearly antipodal."""
    i = F.col("event_id")
    at = lambda a, n, low: F.lit(low) + ((i * a) % n) / 100.0
    near = i % 2 == 0
    lat1, lng1 = at(7919, 17900, -89.5), at(104729, 36000, -180.0)
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        i.cast("string").alias("ride_id"),
        lat1.alias("start_lat"),
        lng1.alias("start_lng"),
        F.when(near, F.lit(0.0) - lat1 + at(31, 100, -0.5)).otherwise(at(6007, 17900, -89.5)).alias("end_lat"),
        F.when(near, lng1 + F.lit(180.0) + at(37, 200, -1.0)).otherwise(at(15485863, 36000, -180.0)).alias("end_lng"),
    )


# --- staged tables ----------------------------------------------------------------

_staged: dict[tuple[str, str, str], str] = {}


def staged(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Path (or, for ``processed_table``, name) of a staged table, written on first use."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _staged:
        place = scratch_folder(spark, name)
        _staged[key] = _STAGES[name](spark, sf_dir, place) or place
    return _staged[key]


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_weather(spark, staged(spark, sf_dir, "weather"))


def stored_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`trips` as a month-partitioned Parquet table, without its month columns."""
    path = staged(spark, sf_dir, "trips")
    return read_trips_parquet(spark, path).select(*TRIP_COLUMNS)


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(staged(spark, sf_dir, "processed_table"))


def _stage_harsh(spark: SparkSession, sf_dir: str, place: str) -> None:
    """Trips as pandas stores them, with its row numbers; some end before they start."""
    i = F.col("ride_id").cast("long")
    early = F.timestamp_add("SECOND", F.lit(-90), F.col("started_at"))
    rows = trips(spark, sf_dir).withColumn("ended_at", F.when(i % 29 == 0, early).otherwise(F.col("ended_at")))
    write_parquet(rows.withColumn("__index_level_0__", i), place)


def _stage_weather(spark: SparkSession, sf_dir: str, place: str) -> None:
    write_parquet(weather_rows(spark, sf_dir), place)


def _stage_trips(spark: SparkSession, sf_dir: str, place: str) -> None:
    write_months(trips(spark, sf_dir), place)


def _stage_csv(spark: SparkSession, sf_dir: str, place: str) -> None:
    (
        stored_trips(spark, sf_dir)
        .write.option("header", True)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .option("maxRecordsPerFile", 500_000)
        .csv(place)
    )


def _stage_zip(spark: SparkSession, sf_dir: str, place: str) -> None:
    """Archives ``yyyymm-piece-part.csv.zip``, each packed and written by its task.

    Every 50th trip lies in the next month's file, and every 19th has a line break in the
    name of its last station.  A month comes in 16 pieces, the largest 31 times the
    smallest.  April's archive holds a header and no trip.  Member times are fixed, so a
    repeated task writes the same bytes.
    """
    i = F.col("ride_id").cast("long")
    piece = F.floor(F.sqrt((i % 256).cast("double"))).cast("int")
    broken = F.when(i % 19 == 0, F.concat(F.col("end_station_name"), F.lit("\nside"))).otherwise(F.col("end_station_name"))
    (
        stored_trips(spark, sf_dir)
        .withColumn("end_station_name", broken)
        .withColumn("stem", F.when(i % 50 == 0, "202402").otherwise("202401"))
        .withColumn("piece", piece)
        .write.partitionBy("stem", "piece")
        .option("header", True)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .option("maxRecordsPerFile", 500_000)
        .csv(f"{place}/csv")
    )
    place = f"{place}/zip"
    files, folder = pafs.FileSystem.from_uri(place)
    files.create_dir(folder, recursive=True)

    def zipped(name: str, content: bytes) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as box:
            box.writestr(zipfile.ZipInfo(name, (2024, 1, 1, 0, 0, 0)), content)
            box.writestr(zipfile.ZipInfo("notes.csv", (2024, 1, 1, 0, 0, 0)), "not,trips\n")
        return out.getvalue()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, root = pafs.FileSystem.from_uri(place)
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                stem, number, name = path.as_py().split("/")[-3:]
                name = f"{stem.split('=')[1]}-{number.split('=')[1]}-{name}"
                with target.open_output_stream(f"{root}/{name}.zip") as out:
                    out.write(zipped(name, content.as_py()))
                yield pa.RecordBatch.from_arrays([pa.array([name])], ["name"])

    csv_files = spark.read.format("binaryFile").load(place.removesuffix("zip") + "csv/stem=*/piece=*/*.csv")
    csv_files.select("path", "content").mapInArrow(pack, "name string").count()
    with files.open_output_stream(f"{folder}/202404-none.csv.zip") as out:
        out.write(zipped("202404-none.csv", ",".join(TRIP_COLUMNS).encode() + b"\n"))


def _stage_raw(spark: SparkSession, sf_dir: str, place: str) -> None:
    write_months(ingest_trips(stored_trips(spark, sf_dir)), place)


def _stage_file_months(spark: SparkSession, sf_dir: str, place: str) -> None:
    """Raw trips from the archives, partitioned by the file's month."""
    ingest_months(spark, f"{staged(spark, sf_dir, 'zip')}/zip", 2024, [1, 2], place)


def _stage_weather_months(spark: SparkSession, sf_dir: str, place: str) -> None:
    """Weather with a year and a month of its own, which are not the trips'."""
    rows = weather(spark, sf_dir).withColumns({"year": F.lit(1900), "month": F.lit(7)})
    write_parquet(rows, place)


def _stage_nanos(spark: SparkSession, sf_dir: str, place: str) -> None:
    """Times as nanoseconds, each with its own millisecond, as Spark reads them from pandas."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")

    def nanos(name: str) -> Column:
        micros = F.timestamp_diff("MICROSECOND", epoch, F.col(name))
        return (micros + (F.col("ride_id").cast("long") % 1000) * 1000) * 1000

    rows = stored_trips(spark, sf_dir)
    write_parquet(rows.withColumns({c: nanos(c) for c in ("started_at", "ended_at")}), place)


def _stage_long(spark: SparkSession, sf_dir: str, place: str) -> None:
    """Eighty months of trips; rows arrive in no month order, so gather them first."""
    write_months(cast_trips(trips(spark, sf_dir, "orders"), None), place, rebalance=True)


def _stage_processed(spark: SparkSession, sf_dir: str, place: str) -> None:
    raw = read_trips_parquet(spark, staged(spark, sf_dir, "raw")).select(*TRIP_COLUMNS)
    append_months(enrich_trips(raw, weather(spark, sf_dir)), place)


def _stage_processed_table(spark: SparkSession, sf_dir: str, place: str) -> str:
    name = "processed_" + place.rsplit("-", 1)[1]
    rows = spark.read.parquet(staged(spark, sf_dir, "processed"))
    write_table(rows.drop("year", "month"), name, path=place)
    return name


_STAGES: dict[str, Callable[[SparkSession, str, str], str | None]] = {
    "harsh": _stage_harsh,
    "weather": _stage_weather,
    "trips": _stage_trips,
    "csv": _stage_csv,
    "zip": _stage_zip,
    "raw": _stage_raw,
    "file_months": _stage_file_months,
    "weather_months": _stage_weather_months,
    "nanos": _stage_nanos,
    "long": _stage_long,
    "processed": _stage_processed,
    "processed_table": _stage_processed_table,
}
