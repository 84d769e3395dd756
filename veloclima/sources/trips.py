"""Trip readers: CSV, zipped CSV, Parquet, tables.  All use the fixed layout."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import swap
from ..schema import TRIP_COLUMNS, TRIPS, TRIPS_TEXT
from .archives import LAYOUT, Opener, first_member_rows, opened, read_archives


# --- fixed values: what pandas takes for missing unless told otherwise ---------------
PANDAS_NULL_WORDS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# -------------------------------------------------------------------------------------


def month_files(folder: str, year: int | str, months: Iterable[int | str], ending: str) -> str:
    """Wildcard for files named ``yyyymm-...`` of the given months.

    One pattern rather than a path per month: a month that is not there does not
    match, and the others are read.
    """
    stems = ",".join(f"{int(year):04d}{int(m):02d}" for m in months)
    return f"{folder.rstrip('/')}/{{{stems}}}-*{ending}"


def file_month(df: DataFrame) -> DataFrame:
    """``year`` and ``month`` from the name of the file in ``source``, which is dropped."""
    stem = F.regexp_extract("source", r"/(\d{6})-[^/]*$", 1)
    return df.withColumns(
        {
            "year": F.substring(stem, 1, 4).cast("int"),
            "month": F.substring(stem, 5, 2).cast("int"),
        }
    ).drop("source")


def read_trips_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    null_words: Iterable[str] = (),
    multi_line: bool = False,
    with_source: bool = False,
) -> DataFrame:
    """CSV with a header, every column as text; empty fields are NULL.

    Text keeps an id such as ``00123`` whole.  A header that does not match the
    layout, or a row of another width, is an error.  ``null_words`` names further
    spellings of a missing value, e.g. ``PANDAS_NULL_WORDS``.  Files are split by
    line across tasks unless ``multi_line`` allows line breaks inside quotes.
    """
    reader = (
        spark.read.schema(TRIPS_TEXT)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("escape", '"')
        .option("multiLine", multi_line)
    )
    df = reader.csv(paths if isinstance(paths, str) else list(paths))
    if with_source:
        df = df.withColumn("source", F.col("_metadata.file_path"))
    return _without_words(df, null_words)


def _without_words(df: DataFrame, words: Iterable[str]) -> DataFrame:
    words = list(words)
    if not words:
        return df
    return df.withColumns(
        {c: F.when(~F.col(c).isin(words), F.col(c)) for c in TRIP_COLUMNS if c in df.columns}
    )


# --- zipped CSV -----------------------------------------------------------------


def _unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            path = batch.column(0)[k].as_py()
            if batch.num_columns > 1:
                yield from first_member_rows(pa.BufferReader(batch.column(1)[k].as_buffer()), path)
                continue
            with opened(path) as archive:
                yield from first_member_rows(archive, path)


def trips_from_archives(archives: DataFrame, null_words: Iterable[str] = ()) -> DataFrame:
    """Unpack (path) or (path, content) rows to text trips plus ``source``, the archive's path.

    For archives that are already a table; ``read_trips_zip`` finds and deals them itself.
    With ``path`` alone the task opens the archive where it lies and holds one block of it.
    """
    columns = [c for c in ("path", "content") if c in archives.columns]
    return _without_words(archives.select(*columns).mapInArrow(_unzip, LAYOUT), null_words)


def read_trips_zip(
    spark: SparkSession,
    paths: str | Sequence[str],
    null_words: Iterable[str] = (),
    opener: Opener | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Monthly ZIP archives, first member only, as text trips plus ``source``.

    An archive is one task's work; archives are dealt to tasks by their size, see
    ``archives``.  ``opener`` opens stores that pyarrow does not open by itself, or opens
    them with credentials of one's own.
    """
    given = [paths] if isinstance(paths, str) else list(paths)
    return _without_words(read_archives(spark, given, opener, tasks), null_words)


# --- Parquet and tables -----------------------------------------------------------


def read_trips_parquet(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | None = TRIPS,
    with_source: bool = False,
    base_path: str | None = None,
) -> DataFrame:
    """One path, several, or a wildcard.

    Without a ``schema`` the files say theirs.  ``with_source`` adds the file each row came from.  A wildcard into
    ``year=/month=`` folders loses those two columns unless ``base_path`` says
    where the table starts.
    """
    given = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.schema(schema) if schema else spark.read
    if base_path:
        reader = reader.option("basePath", base_path)
    df = reader.parquet(*given)
    return df.withColumn("source", F.col("_metadata.file_path")) if with_source else df


_V1, _PUSHDOWN = "spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown"


def read_for_counts(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | None = TRIPS,
    base_path: str | None = None,
) -> DataFrame:
    """The same rows through Spark's newer Parquet reader, which counts from file footers.

    Counts of all rows, also by all partition columns and of chosen partitions, then read no
    column at all and handle one row per file instead of one per trip.  Anything else reads
    as usual.  Sets ``spark.sql.parquet.aggregatePushdown``, which no other reader looks at.
    """
    before = spark.conf.get(_V1)
    spark.conf.set(_V1, ",".join(name for name in before.split(",") if name.strip().lower() != "parquet"))
    try:
        df = read_trips_parquet(spark, paths, schema, base_path=base_path)
    finally:
        spark.conf.set(_V1, before)
    spark.conf.set(_PUSHDOWN, "true")
    return df


def read_table_for_counts(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table for counting: from footers where it is Parquet in one folder."""
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if told.get("Provider", "").lower() != "parquet" or "Location" not in told or "# Partition Information" in told:
        return spark.table(name)
    return read_for_counts(spark, told["Location"], spark.table(name).schema)


def read_months(spark: SparkSession, path: str, schema: T.StructType | None = TRIPS) -> DataFrame:
    """A table of months, whole or as a replacement that was cut off leaves it.

    Once ``sinks.replace_months`` has published new months, they are what is read, also
    where their files were not moved in yet.  Nothing is written.
    """
    pending = swap.current_files(spark, path)
    if pending is None:
        return read_trips_parquet(spark, path, schema)
    placed, staged, waiting = pending
    tables = [read_trips_parquet(spark, p, schema, base_path=root) for p, root in ((placed, path), (waiting, staged)) if p]
    if not tables:
        return read_trips_parquet(spark, path, schema)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def months_with_files(spark: SparkSession, folder: str, year: int | str, months: Iterable[int | str], ending: str) -> list[int]:
    """The months, of those asked for, that have a file named ``yyyymm-...``."""
    asked = sorted({int(m) for m in months})
    if not asked:
        return []
    pattern = spark._jvm.org.apache.hadoop.fs.Path(month_files(folder, year, asked, ending))
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    return sorted({int(s.getPath().getName()[4:6]) for s in found})


def timestamps_from_nanos(
    df: DataFrame, columns: Sequence[str] = ("started_at", "ended_at")
) -> DataFrame:
    """Nanosecond counts to timestamps, for Parquet that pandas wrote.

    Spark has no nanosecond type.  With ``spark.sql.legacy.parquet.nanosAsLong``
    set it reads such columns as numbers, which this turns into microsecond time.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")

    def moment(name: str):
        nanos = F.col(name)
        micros = F.call_function("div", nanos - F.pmod(nanos, F.lit(1000)), F.lit(1000))
        return F.timestamp_add("MICROSECOND", micros, epoch)

    return df.withColumns({c: moment(c) for c in columns})


def read_table(spark: SparkSession, name: str, parallelism: int | None = None) -> DataFrame:
    """A catalog table.

    File splits set the number of tasks; ``parallelism`` asks for another number
    at the price of a shuffle, so it is for small tables feeding heavy work.
    """
    df = spark.table(name)
    return df.repartition(parallelism) if parallelism else df
