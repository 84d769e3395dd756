from .clean import cast_trips, clean_report, drop_na_any, parse_timestamps
from .enrich import add_cost, add_date_key, add_distance, add_travel_time, date_as_text
from .months import (
    count_by_month,
    month_coverage,
    month_select,
    months_between,
    months_present,
    with_month,
)
from .reports import (
    both_ends,
    count_table,
    daily_report_sql,
    register_view,
    report_weather_km,
    top_distance,
    weather_daily_avg,
    weather_daily_avg_from_trips,
)
from .shape import (
    drop_index_col,
    limit_rows,
    multi_month_union,
    project_day_and_year,
    project_trips,
    select_all_limit,
)
from .weather import column_overlap, hot_days, join_weather, rename_weather_key, weather_date_text

__all__ = [
    "add_cost",
    "add_date_key",
    "add_distance",
    "add_travel_time",
    "both_ends",
    "cast_trips",
    "clean_report",
    "column_overlap",
    "count_by_month",
    "count_table",
    "daily_report_sql",
    "date_as_text",
    "drop_index_col",
    "drop_na_any",
    "hot_days",
    "join_weather",
    "limit_rows",
    "month_coverage",
    "month_select",
    "months_between",
    "months_present",
    "multi_month_union",
    "parse_timestamps",
    "project_day_and_year",
    "project_trips",
    "register_view",
    "rename_weather_key",
    "report_weather_km",
    "select_all_limit",
    "top_distance",
    "weather_daily_avg",
    "weather_daily_avg_from_trips",
    "weather_date_text",
    "with_month",
]
