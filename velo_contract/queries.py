"""One query per operator.  Each reads the whole of its tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veloclima import operators as op
from veloclima import plans, sinks, sources
from veloclima.functions import day_text
from veloclima.schema import TRIP_COLUMNS
from veloclima.session import scratch_folder

from . import derived

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def shown(df: DataFrame) -> DataFrame:
    """Times as text, so that two engines print them alike."""
    times = [name for name, kind in df.dtypes if kind == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("string") for c in times})


def rounded(report: DataFrame, *columns: str) -> DataFrame:
    """Averages to 4 dp: engines add in different orders."""
    return report.withColumns({c: F.round(c, 4) for c in columns})


def _long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.read_trips_parquet(spark, derived.staged(spark, sf_dir, "long"))


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = derived.staged(spark, sf_dir, "raw")
    return sources.read_trips_parquet(spark, path).select(*TRIP_COLUMNS)


def _csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.read_trips_csv(spark, derived.staged(spark, sf_dir, "csv"))


def _archives(spark: SparkSession, sf_dir: str) -> str:
    return derived.staged(spark, sf_dir, "zip") + "/zip"


# --- sources ------------------------------------------------------------------------


@query
def src_csv_month(spark, sf_dir):
    return shown(plans.ingest_trips(_csv(spark, sf_dir), null_text=None))


@query
def src_zip_csv(spark, sf_dir):
    rows = sources.read_trips_zip(spark, f"{_archives(spark, sf_dir)}/*.zip")
    return shown(plans.ingest_trips(sources.file_month(rows), None, keep=("year", "month")))


@query
def src_parquet(spark, sf_dir):
    return shown(_raw(spark, sf_dir))


@query
def src_parquet_nanos(spark, sf_dir):
    rows = sources.timestamps_from_nanos(spark.read.parquet(derived.staged(spark, sf_dir, "nanos")))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = [F.timestamp_diff("MICROSECOND", epoch, F.col(c)).alias(c) for c in ("started_at", "ended_at")]
    return rows.select("ride_id", *micros)


@query
def src_parquet_glob(spark, sf_dir):
    pattern = f"{derived.staged(spark, sf_dir, 'long')}/year=*/month=*"
    rows = sources.read_trips_parquet(spark, pattern, with_source=True)
    return rows.select(
        "ride_id",
        F.regexp_extract("source", r"year=(\d+)/", 1).cast("int").alias("source_year"),
        F.regexp_extract("source", r"month=(\d+)/", 1).cast("int").alias("source_month"),
    )


@query
def src_weather(spark, sf_dir):
    return derived.weather(spark, sf_dir)


@query
def src_table(spark, sf_dir):
    name = derived.staged(spark, sf_dir, "processed_table")
    return shown(sources.read_table(spark, name))


@query
def month_select(spark, sf_dir):
    return shown(op.month_select(_long(spark, sf_dir), 1997, ["01", "02", "03", "09"]))


@query
def month_coverage(spark, sf_dir):
    expected = op.months_between(spark, "1994-07", "2002-06")
    stored = sources.read_for_counts(spark, derived.staged(spark, sf_dir, "long"))
    return op.month_coverage(stored, expected)


# --- sinks --------------------------------------------------------------------------


@query
def sink_parquet_month(spark, sf_dir):
    path = scratch_folder(spark, "by-month")
    sinks.write_months(derived.trips(spark, sf_dir, "orders"), path, rebalance=True)
    return shown(sources.read_trips_parquet(spark, path))


@query
def sink_append(spark, sf_dir):
    path = scratch_folder(spark, "appended")
    for _ in range(2):
        sinks.append_months(_raw(spark, sf_dir), path, rows_per_file=sinks.CHUNK_ROWS)
    return op.count_by_month(sources.read_trips_parquet(spark, path))


@query
def sink_overwrite(spark, sf_dir):
    path = scratch_folder(spark, "overwritten")
    sinks.write_parquet(derived.processed(spark, sf_dir), path)
    sinks.write_parquet(_raw(spark, sf_dir), path, mode="overwrite")
    return shown(sources.read_trips_parquet(spark, path))


@query
def sink_errorifexists(spark, sf_dir):
    path = scratch_folder(spark, "once")
    sinks.write_parquet(_raw(spark, sf_dir), path)
    try:
        sinks.write_parquet(_raw(spark, sf_dir), path)
    except AnalysisException:
        return shown(sources.read_trips_parquet(spark, path))
    raise AssertionError("a second write to one target must fail")


@query
def sink_joined_parquet(spark, sf_dir):
    path = scratch_folder(spark, "joined")
    joined = plans.join_only(_raw(spark, sf_dir), derived.weather(spark, sf_dir))
    sinks.write_parquet(joined, path, mode="overwrite")
    return shown(spark.read.parquet(path))


@query
def table_copy(spark, sf_dir):
    path = scratch_folder(spark, "copy")
    source = derived.staged(spark, sf_dir, "processed_table")
    target = "copy_" + path.rsplit("-", 1)[1]
    return shown(sinks.table_copy(spark, source, target, path=path))


@query
def sink_idempotent_month(spark, sf_dir):
    """File months with strays, and weather with a year and month of its own, run again."""
    path = scratch_folder(spark, "replaced")
    raw = derived.staged(spark, sf_dir, "file_months")
    weather = derived.staged(spark, sf_dir, "weather_months")
    for months in ([1, 2, 3], [2]):
        plans.enrich_months(spark, raw, weather, path, 2024, months, replace=True)
    return op.count_by_month(sources.read_months(spark, path))


# --- projections, casts, cleaning ---------------------------------------------------


@query
def parse_timestamps(spark, sf_dir):
    return op.parse_timestamps(_csv(spark, sf_dir)).select("ride_id", "started_at", "ended_at")


@query
def cast_trips(spark, sf_dir):
    return shown(op.cast_trips(op.parse_timestamps(_csv(spark, sf_dir)), null_text="nan"))


@query
def drop_na_any(spark, sf_dir):
    return shown(op.drop_na_any(derived.stored_trips(spark, sf_dir)))


@query
def rename_weather_key(spark, sf_dir):
    return op.rename_weather_key(derived.weather(spark, sf_dir))


@query
def add_date_key(spark, sf_dir):
    return op.add_date_key(derived.stored_trips(spark, sf_dir), as_text=True).select("ride_id", "date")


@query
def weather_date_text(spark, sf_dir):
    weather = derived.weather(spark, sf_dir)
    return op.weather_date_text(
        weather.withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))
    )


@query
def project_trips(spark, sf_dir):
    dated = op.add_date_key(derived.stored_trips(spark, sf_dir), as_text=True)
    return shown(op.project_trips(dated, 100, order_by="ride_id"))


@query
def select_all_limit(spark, sf_dir):
    return shown(op.select_all_limit(derived.processed(spark, sf_dir), 100, order_by="ride_id"))


@query
def project_4_year(spark, sf_dir):
    return shown(op.project_day_and_year(derived.stored_trips(spark, sf_dir)))


@query
def drop_index_col(spark, sf_dir):
    indexed = derived.stored_trips(spark, sf_dir).withColumn("__index_level_0__", F.lit(0))
    return shown(op.drop_index_col(indexed))


@query
def column_overlap(spark, sf_dir):
    """Weather that also has a ``cost`` column: both survive, told apart by suffix."""
    trips = op.add_cost(op.add_distance(derived.stored_trips(spark, sf_dir)))
    weather = derived.weather(spark, sf_dir).withColumn("cost", F.col("tempmax") * 10)
    joined = op.join_weather(op.add_date_key(trips), weather)
    return joined.select("ride_id", "cost_x", "cost_y")


# --- join, aggregates, top-n ----------------------------------------------------------


@query
def join_weather(spark, sf_dir):
    dated = op.add_date_key(derived.stored_trips(spark, sf_dir))
    joined = op.join_weather(dated, derived.weather(spark, sf_dir))
    return shown(op.date_as_text(joined))


@query
def weather_daily_avg(spark, sf_dir):
    return rounded(op.weather_daily_avg(derived.processed(spark, sf_dir)), "distance")


@query
def count_table(spark, sf_dir):
    name = derived.staged(spark, sf_dir, "processed_table")
    return op.count_table(sources.read_table_for_counts(spark, name))


@query
def count_multi_month(spark, sf_dir):
    root = derived.staged(spark, sf_dir, "long")
    rows = sources.read_for_counts(spark, f"{root}/year=*/month=*", base_path=root)
    return op.count_by_month(rows)


@query
def count_before_clean(spark, sf_dir):
    return op.clean_report(derived.stored_trips(spark, sf_dir))


@query
def top10_distance_desc(spark, sf_dir):
    report = op.weather_daily_avg(derived.processed(spark, sf_dir))
    return rounded(op.top_distance(report, 10), "distance")


@query
def top10_distance_asc(spark, sf_dir):
    report = op.weather_daily_avg(derived.processed(spark, sf_dir))
    return rounded(op.top_distance(report, 10, ascending=True), "distance")


@query
def limit_n(spark, sf_dir):
    return op.limit_rows(derived.weather(spark, sf_dir), 5, order_by="datetime")


# --- rows that real files hold ------------------------------------------------------------
# Row numbers of pandas, trips that end before they start, days with two weather rows,
# unknown icons and temperatures.


def _harsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(derived.staged(spark, sf_dir, "harsh"))


@query
def harsh_index_col(spark, sf_dir):
    return shown(op.drop_index_col(_harsh(spark, sf_dir)))


@query
def harsh_travel_time(spark, sf_dir):
    return op.add_travel_time(op.drop_index_col(_harsh(spark, sf_dir))).select("ride_id", "travel_time")


@query
def harsh_join_weather(spark, sf_dir):
    joined = plans.join_only(op.drop_index_col(_harsh(spark, sf_dir)), derived.harsh_weather_rows(spark, sf_dir))
    return shown(joined)


@query
def harsh_daily_avg(spark, sf_dir):
    done = plans.enrich_trips(op.drop_index_col(_harsh(spark, sf_dir)), derived.harsh_weather_rows(spark, sf_dir))
    return rounded(op.weather_daily_avg(done), "distance")


# --- scalar functions -----------------------------------------------------------------


@query
def add_distance(spark, sf_dir):
    return op.add_distance(derived.stored_trips(spark, sf_dir)).select("ride_id", "distance")


@query
def add_distance_far(spark, sf_dir):
    """Lines across the globe, half of them between nearly antipodal points."""
    return op.add_distance(derived.far_points(spark, sf_dir)).select("ride_id", "distance")


@query
def add_travel_time(spark, sf_dir):
    return op.add_travel_time(derived.stored_trips(spark, sf_dir)).select("ride_id", "travel_time")


@query
def add_cost(spark, sf_dir):
    return op.add_cost(op.add_distance(derived.stored_trips(spark, sf_dir))).select(
        "ride_id", "rideable_type", "member_casual", "distance", "cost"
    )


@query
def day_format(spark, sf_dir):
    return derived.processed(spark, sf_dir).select("ride_id", day_text("date").alias("day"))


@query
def cast_to_text(spark, sf_dir):
    dated = op.add_date_key(derived.stored_trips(spark, sf_dir))
    return op.date_as_text(dated).select("ride_id", "date")


# --- SQL surface and programs -----------------------------------------------------------


@query
def sql_view(spark, sf_dir):
    view = op.register_view(derived.processed(spark, sf_dir), f"trips_{uuid.uuid4().hex}")
    return rounded(op.daily_report_sql(spark, view), "distance")


@query
def multi_month_union(spark, sf_dir):
    """The months that are there, one table each, whatever years they are of."""
    everything = _long(spark, sf_dir)
    halves = [everything.filter(F.col("month") % 2 == k) for k in (0, 1)]
    return shown(op.multi_month_union(*halves))


@query
def pipe_ingest(spark, sf_dir):
    """Archives to the raw table, and a row for each gap: March has no file, April's is empty."""
    path = scratch_folder(spark, "ingested")
    gaps = plans.ingest_months(spark, _archives(spark, sf_dir), 2024, [1, 2, 3, 4], path)
    missing = gaps.select(F.concat_ws("-", "year", "month").alias("gap"))
    return shown(sources.read_months(spark, path)).unionByName(missing, allowMissingColumns=True)


@query
def pipe_enrich(spark, sf_dir):
    path = scratch_folder(spark, "enriched")
    raw, weather = (derived.staged(spark, sf_dir, name) for name in ("raw", "weather"))
    plans.enrich_months(spark, raw, weather, path, 2024, range(1, 13))
    return shown(spark.read.parquet(path).drop("year", "month"))


@query
def pipe_combined(spark, sf_dir):
    path = scratch_folder(spark, "combined")
    weather = derived.staged(spark, sf_dir, "weather")
    plans.ingest_and_enrich_months(spark, _archives(spark, sf_dir), weather, path, 2024, [1, 2])
    return shown(spark.read.parquet(path))


@query
def pipe_spark_join(spark, sf_dir):
    path = scratch_folder(spark, "day-join")
    raw, weather = (derived.staged(spark, sf_dir, name) for name in ("raw", "weather"))
    plans.join_months(spark, raw, weather, path)
    return shown(spark.read.parquet(path))


@query
def report_days(spark, sf_dir):
    """From the stored enriched table to the best and worst days."""
    return rounded(plans.report_days(spark, derived.staged(spark, sf_dir, "processed")), "distance")


@query
def report_weather_km(spark, sf_dir):
    return rounded(op.report_weather_km(derived.processed(spark, sf_dir)), "avg_distance_km")


@query
def daily_extremes(spark, sf_dir):
    """Raw trips to the ten best and ten worst days, in one job."""
    ends = plans.daily_extremes(derived.stored_trips(spark, sf_dir), derived.weather(spark, sf_dir))
    return rounded(ends, "distance")


@query
def weather_daily_avg_from_trips(spark, sf_dir):
    measured = op.add_distance(op.drop_na_any(derived.stored_trips(spark, sf_dir)))
    report = op.weather_daily_avg_from_trips(measured, derived.weather(spark, sf_dir))
    return rounded(report, "distance")
