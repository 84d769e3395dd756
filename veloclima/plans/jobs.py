"""From files to files, for a choice of months: one Spark job each, not a loop."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..operators import both_ends, month_coverage, month_select, months_between, weather_daily_avg
from ..schema import TRIP_COLUMNS
from ..sinks import append_months, replace_months, write_parquet
from ..sources import (
    file_month,
    month_files,
    months_with_files,
    read_months,
    read_trips_csv,
    read_trips_zip,
    read_weather,
)
from .programs import enrich_trips, ingest_and_enrich, ingest_trips, join_only

Months = Iterable[int | str]

# The month a trip's file is of travels under these names, out of the way of the weather's
# columns, and becomes the table's partition again at the end.
_FILE_YEAR, _FILE_MONTH = "_file_year", "_file_month"


def _numbers(months: Months) -> list[int]:
    return sorted({int(m) for m in months})


def _monthly_files(
    spark: SparkSession,
    folder: str,
    year: int | str,
    months: list[int],
    ending: str,
    null_words: Iterable[str],
    multi_line: bool,
) -> tuple[DataFrame | None, list[int]]:
    """Text trips with the year and month of their file, and the asked months that have one."""
    held = months_with_files(spark, folder, year, months, ending)
    if not held:
        return None, []
    pattern = month_files(folder, year, held, ending)
    if ending.endswith(".zip"):
        found = read_trips_zip(spark, pattern, null_words)
    else:
        found = read_trips_csv(spark, pattern, null_words, multi_line, with_source=True)
    return file_month(found), held


def _gaps(spark: SparkSession, target: str, year: int | str, months: list[int]) -> DataFrame:
    """The asked months that the target lacks now: twelve rows at most, looked up at once."""
    layout = "year int, month int"
    if not months:
        return spark.createDataFrame([], layout)
    asked = months_between(spark, f"{year}-{months[0]:02d}", f"{year}-{months[-1]:02d}")
    wanted = month_select(asked, year, months)
    try:
        held = month_select(read_months(spark, target), year, months)
        lacking = month_coverage(held, wanted).collect()
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        lacking = wanted.collect()
    return spark.createDataFrame([(r["year"], r["month"]) for r in lacking], layout)


def ingest_months(
    spark: SparkSession,
    folder: str,
    year: int | str,
    months: Months,
    target: str,
    ending: str = ".zip",
    rebalance: bool = False,
    null_words: Iterable[str] = (),
    null_text: str | None = "nan",
    multi_line: bool = False,
) -> DataFrame:
    """Monthly files named ``yyyymm-...`` to the raw table; returns the months it still lacks.

    Partitions follow the file's month, so a trip that strays over midnight stays
    with its file, and running a month again replaces that month and no other: one whose files
    hold no trips any more ends up empty, and is a gap.  Months without a file are left as
    they are.  An archive is unpacked by one task;
    with ``rebalance`` a large one is at least written by many.
    """
    numbers = _numbers(months)
    found, held = _monthly_files(spark, folder, year, numbers, ending, null_words, multi_line)
    if found is not None:
        trips = ingest_trips(found, null_text, keep=("year", "month"))
        replace_months(trips, target, rebalance=rebalance, months=[(int(year), m) for m in held])
    return _gaps(spark, target, year, numbers)


def _with_partitions(joined: DataFrame) -> DataFrame:
    """The file's month as ``year`` and ``month``; the weather's columns of that name get ``_y``."""
    renamed = joined.withColumnsRenamed(
        {c: f"{c}_y" for c in joined.columns if c.lower() in ("year", "month")}
    )
    return renamed.withColumnsRenamed({_FILE_YEAR: "year", _FILE_MONTH: "month"})


def _reserved(trips: DataFrame) -> DataFrame:
    return trips.withColumnsRenamed({"year": _FILE_YEAR, "month": _FILE_MONTH})


def _store(
    done: DataFrame,
    target: str,
    year: int | str,
    months: list[int],
    replace: bool,
    rebalance: bool,
) -> None:
    if replace:
        asked = [(int(year), m) for m in months]
        replace_months(done, target, rebalance=rebalance, months=asked)
    else:
        append_months(done, target, rebalance=rebalance)


def enrich_months(
    spark: SparkSession,
    raw: str,
    weather: str,
    target: str,
    year: int | str,
    months: Months,
    replace: bool = False,
    rebalance: bool = False,
    **options,
) -> None:
    """Raw months to the enriched table: appended, or replacing the asked months.

    ``options`` are those of ``enrich_trips``.
    """
    numbers = _numbers(months)
    chosen = _reserved(month_select(read_months(spark, raw), year, numbers))
    done = _with_partitions(enrich_trips(chosen, read_weather(spark, weather), **options))
    _store(done, target, year, numbers, replace, rebalance)


def ingest_and_enrich_months(
    spark: SparkSession,
    folder: str,
    weather: str,
    target: str,
    year: int | str,
    months: Months,
    ending: str = ".zip",
    replace: bool = False,
    rebalance: bool = False,
    null_words: Iterable[str] = (),
    multi_line: bool = False,
    **options,
) -> DataFrame:
    """Monthly files to finished trips in one pass; returns the months still lacking.

    With ``replace``, months that have a file are replaced, the others left as they are.
    ``options`` are those of ``ingest_and_enrich``.
    """
    numbers = _numbers(months)
    found, held = _monthly_files(spark, folder, year, numbers, ending, null_words, multi_line)
    if found is not None:
        done = ingest_and_enrich(
            _reserved(found),
            read_weather(spark, weather),
            keep=(_FILE_YEAR, _FILE_MONTH),
            **options,
        )
        _store(_with_partitions(done), target, year, held, replace, rebalance)
    return _gaps(spark, target, year, numbers)


def join_months(
    spark: SparkSession, raw: str, weather: str, target: str, salt: int | None = None
) -> None:
    """All raw trips with their weather, nothing measured, overwriting the target."""
    trips = read_months(spark, raw).select(*TRIP_COLUMNS)
    joined = join_only(trips, read_weather(spark, weather), salt=salt)
    write_parquet(joined, target, mode="overwrite")


def report_days(spark: SparkSession, enriched: str, n: int = 10) -> DataFrame:
    """The n best and the n worst days of the enriched table."""
    return both_ends(weather_daily_avg(read_months(spark, enriched, schema=None)), n)
