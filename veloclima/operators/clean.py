"""Typing and cleaning of raw trips.  Every operator is narrow: no shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import TRIPS


def parse_timestamps(
    df: DataFrame,
    columns: Sequence[str] = ("started_at", "ended_at"),
    on_error: str = "raise",
) -> DataFrame:
    """Text to zone-less timestamps.

    ``on_error='raise'`` stops on an unreadable value whatever the session's
    ANSI setting; ``'null'`` leaves NULL there for a later quarantine step.
    """
    if on_error not in ("raise", "null"):
        raise ValueError(f"on_error must be 'raise' or 'null', not {on_error!r}")

    def parsed(name: str) -> Column:
        value = F.col(name).try_cast("timestamp_ntz")
        if on_error == "null":
            return value
        complaint = F.concat(F.lit(f"{name} is not a timestamp: "), F.col(name).cast("string"))
        return F.coalesce(value, F.when(F.col(name).isNotNull(), F.raise_error(complaint)))

    known = dict(df.dtypes)
    todo = [c for c in columns if known[c] != "timestamp_ntz"]
    return df.withColumns({c: parsed(c) for c in todo})


def cast_trips(
    df: DataFrame, null_text: str | None = "nan", schema: T.StructType = TRIPS
) -> DataFrame:
    """Force the trip layout: its columns, its order, its types.

    ``null_text='nan'`` writes that word for a missing text value, so a later
    :func:`drop_na_any` keeps the row; ``None`` keeps real NULLs.
    """

    known = dict(df.dtypes)

    def forced(field: T.StructField) -> Column:
        value = F.col(field.name).cast(field.dataType)
        if known[field.name] == "string" and isinstance(field.dataType, T.NumericType):
            value = F.col(field.name).try_cast(field.dataType)  # an error under any ANSI setting
            complaint = F.concat(F.lit(f"{field.name} is not a number: "), F.col(field.name))
            bad = F.when(F.col(field.name).isNotNull(), F.raise_error(complaint))
            value = F.coalesce(value, bad.cast(field.dataType))
        if null_text is not None and isinstance(field.dataType, T.StringType):
            value = F.coalesce(value, F.lit(null_text))
        return value.alias(field.name)

    return df.select(*[forced(f) for f in schema.fields])


def _present(df: DataFrame, columns: Sequence[str] | None) -> list[Column]:
    """One test per column: not NULL and, for floating point, not NaN."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    tests = [F.col(f.name).isNotNull() for f in fields]
    tests += [
        ~F.isnan(f.name) for f in fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]
    return tests


def drop_na_any(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop a row if any (named) column is missing.

    ``dropna()`` gives the same rows but hides the test from the file reader;
    separate ``IS NOT NULL`` filters reach the Parquet scan.
    """
    tests = _present(df, columns)
    return df.filter(reduce(lambda a, b: a & b, tests)) if tests else df


def clean_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows before, dropped by and left after :func:`drop_na_any`, in one pass."""
    tests = _present(df, columns)
    whole = reduce(lambda a, b: a & b, tests) if tests else F.lit(True)
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(~whole).alias("rows_dropped"),
        F.count_if(whole).alias("rows_after"),
    )
