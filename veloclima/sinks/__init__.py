"""Writers.

Month-partitioned writes add no shuffle of their own: monthly input reaches the
writer month by month, so each task opens few files.  Where it does not,
``rebalance=True`` gathers months first.  That shuffle is Spark's rebalance: a
month far larger than the others is split over several tasks, not squeezed
through one.

A task writes one file per month it meets.  ``rows_per_file`` cuts files shorter
(``CHUNK_ROWS`` is a customary load chunk); at many terabytes leave it off,
or the table turns into millions of small files.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from .. import swap
from ..operators.months import with_month

# --- fixed value: rows per appended chunk ---
CHUNK_ROWS = 500_000
# --------------------------------------------


def _writer(df: DataFrame, mode: str, rows_per_file: int) -> DataFrameWriter:
    return (
        df.write.mode(mode)
        .option("compression", "snappy")
        .option("maxRecordsPerFile", rows_per_file)
    )


def _by_month(
    df: DataFrame, stamp: str, mode: str, rows_per_file: int, rebalance: bool
) -> DataFrameWriter:
    df = with_month(df, stamp)
    if rebalance:
        df = df.hint("rebalance", F.col("year"), F.col("month"))
    return _writer(df, mode, rows_per_file).partitionBy("year", "month")


def write_months(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    stamp: str = "started_at",
    rows_per_file: int = 0,
    rebalance: bool = False,
) -> None:
    """Parquet under ``year=/month=`` folders."""
    _by_month(df, stamp, mode, rows_per_file, rebalance).parquet(path)


def append_months(df: DataFrame, path: str, **options) -> None:
    """Add the rows.  Appending the same month twice stores it twice."""
    swap.settle(df.sparkSession, path)
    write_months(df, path, mode="append", **options)


def replace_months(
    df: DataFrame,
    path: str,
    stamp: str = "started_at",
    rows_per_file: int = 0,
    rebalance: bool = False,
    months: Iterable[tuple[int, int]] | None = None,
) -> None:
    """Replace months, all at once; a re-run changes nothing.

    With ``months``, exactly these (year, month) are replaced: one without rows ends up
    empty, and a row of any other month is an error before anything is replaced.  Without,
    the months present in ``df`` are.  A job that is lost on the way leaves either the old
    months or the new ones, see ``swap``.
    """
    spark = df.sparkSession
    swap.settle(spark, path)
    df = with_month(df, stamp)
    emptied: list[str] = []
    if months is not None:
        asked = sorted({(int(y), int(m)) for y, m in months})
        emptied = [f"year={y}/month={m}" for y, m in asked]
        known = F.lit(False)
        for y, m in asked:
            known = known | ((F.col("year") == y) & (F.col("month") == m))
        complaint = F.concat_ws("-", F.lit("a row outside the months to replace:"), "year", "month")
        df = df.withColumn("year", F.when(known, F.col("year")).otherwise(F.raise_error(complaint)))
    staged = swap.stage_name()
    try:
        _by_month(df, stamp, "errorifexists", rows_per_file, rebalance).parquet(f"{path}/{staged}")
    except Exception:
        swap.Folder(spark, path).delete(staged)
        raise
    swap.publish(spark, path, staged, emptied)
    swap.settle(spark, path)


def write_parquet(
    df: DataFrame, path: str, mode: str = "errorifexists", rows_per_file: int = 0
) -> None:
    """Plain Parquet, e.g. the joined table: ``overwrite``, ``append`` or ``errorifexists``."""
    _writer(df, mode, rows_per_file).parquet(path)


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "errorifexists",
    path: str | None = None,
    rows_per_file: int = 0,
) -> None:
    """A catalog table stored as Parquet, in the warehouse or at ``path``."""
    writer = _writer(df, mode, rows_per_file).format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def table_copy(
    spark: SparkSession,
    source: str,
    target: str,
    mode: str = "errorifexists",
    path: str | None = None,
) -> DataFrame:
    """Copy a whole table and return the copy as read back."""
    write_table(spark.table(source), target, mode=mode, path=path)
    return spark.table(target)
