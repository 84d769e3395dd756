from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """The daily weather table; the Parquet files carry its columns, all are kept."""
    return spark.read.parquet(path)
