from .jobs import (
    enrich_months,
    ingest_and_enrich_months,
    ingest_months,
    join_months,
    report_days,
)
from .programs import daily_extremes, enrich_trips, ingest_and_enrich, ingest_trips, join_only

__all__ = [
    "daily_extremes",
    "enrich_months",
    "enrich_trips",
    "ingest_and_enrich",
    "ingest_and_enrich_months",
    "ingest_months",
    "ingest_trips",
    "join_months",
    "join_only",
    "report_days",
]
