"""Helpers shared by the operators: written tables, row keys, arrays of words."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veloclima.session import scratch_folder

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Written:
    """Tables written to the shared folder on the way to a result.

    A written table cuts the lineage: a lost executor costs a read, not the steps before.
    Shuffle files of the job that wrote it go at once, and ``drop`` removes tables that a
    later written table has replaced.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths = spark, label, {}
        bounded_batches(spark)

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_folder(self.spark, f"{self.label}-{name}")
        before = self.spark.conf.get(_CLEANUP, None)
        self.spark.conf.set(_CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(_CLEANUP)
            else:
                self.spark.conf.set(_CLEANUP, before)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            conf = self.spark._jsc.hadoopConfiguration()
            path.getFileSystem(conf).delete(path, True)


BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Lets Arrow batches of this session hold ``BATCH_BYTES``, or less if it says so.

    A number of rows, the usual bound, is no bound on memory for whole texts.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
    if now > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the table does not have in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def _parts(columns: tuple[str, ...]) -> list[Column]:
    """Null counts as a value of its own."""
    return [part for name in columns for part in (F.col(name).isNull(), F.col(name))]


def row_key(*columns: str) -> Column:
    """64 bits for a row's content, to choose or order by; two different rows may share them."""
    return F.xxhash64(*_parts(columns))


def twin_key(*columns: str) -> Column:
    """Another 64 bits for a row's content."""
    return F.xxhash64(F.lit("twin"), *_parts(columns))


def row_identity(*columns: str) -> Column:
    """128 bits for a row's content, two hashes of 64: what rows are told apart and joined by.

    Rows that agree in these columns share an identity, and are treated alike.  Two of 10**12
    different rows share one with a chance of 2 in 10**15.
    """
    return F.struct(row_key(*columns).alias("a"), twin_key(*columns).alias("b"))


def texts_of(array: pa.Array) -> list[bytes]:
    """UTF-8 of each text, empty for null."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    binary = array.cast(pa.large_binary() if pa.types.is_large_string(array.type) else pa.binary())
    return [x or b"" for x in binary.to_pylist()]


def groups_of(sizes: list[int], most: int):
    """(first, end) of neighbours whose sizes add to ``most``, or one larger item alone."""
    first, total = 0, 0
    for k, size in enumerate(sizes):
        if k > first and total + size > most:
            yield first, k
            first, total = k, 0
        total += size
    if first < len(sizes):
        yield first, len(sizes)


def text_column_udf(fn: Callable, kind) -> Callable:
    """An Arrow function over whole batches; only its arguments leave the JVM."""
    return F.arrow_udf(fn, kind)


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit name for two, order kept (multiply, fold, multiply)."""
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x7F4A7C15F39CC060)
        x ^= x >> np.uint64(32)
        x = (x + b) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
    return x
