"""Calendar-day, duration and month expressions on zone-less timestamps."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_day(value: Column | str) -> Column:
    """Day of a text, date or timestamp column, as DATE (no time zone is involved)."""
    return F.to_date(F.col(value) if isinstance(value, str) else value)


def utc_day(value: Column, zone: str = "UTC") -> Column:
    """Day of a TIMESTAMP (a moment) in ``zone``, whatever the session's zone is."""
    seconds = F.unix_seconds(F.from_utc_timestamp(value, zone))
    return F.date_from_unix_date(F.floor(seconds / F.lit(86400)).cast("int"))


def day_text(value: Column | str) -> Column:
    """The day written ``yyyy-MM-dd``.  A DATE prints so without any time zone."""
    return calendar_day(value).cast("string")


def minutes_between(start: str, end: str) -> Column:
    """Wall-clock minutes between zone-less times.

    The difference of two such columns is an interval and knows no zone.  Anything
    that takes TIMESTAMP, ``timestamp_diff`` included, first casts them in the
    session's zone and moves times that a DST change skips there.
    """
    elapsed = (F.col(end) - F.col(start)).cast("interval second")
    seconds = elapsed.cast("decimal(18,6)").cast("double")
    return F.rint(seconds * F.lit(1e6)) / F.lit(60e6)  # whole microseconds, divided once


def month_runs(year: int, months: Iterable[int | str]) -> list[tuple[str, str]]:
    """Half-open day ranges covering the months, neighbours merged.

    ``(2022, [1, 2, 5])`` gives Jan 1 - Mar 1 and May 1 - Jun 1.
    """
    wanted = sorted({int(m) for m in months})
    if any(not 1 <= m <= 12 for m in wanted):
        raise ValueError(f"months run from 1 to 12, got {wanted}")

    def first_day(m: int) -> str:
        return f"{year + (m - 1) // 12:04d}-{(m - 1) % 12 + 1:02d}-01"

    runs: list[list[int]] = []
    for m in wanted:
        if runs and runs[-1][1] == m:
            runs[-1][1] = m + 1
        else:
            runs.append([m, m + 1])
    return [(first_day(a), first_day(b)) for a, b in runs]
