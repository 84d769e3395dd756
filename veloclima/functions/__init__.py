from .days import calendar_day, day_text, minutes_between, month_runs, utc_day
from .fares import DEFAULT_TARIFF, fare
from .geodesic import ellipsoid_metres, geodesic_metres
from .rounding import round_half_even

__all__ = [
    "DEFAULT_TARIFF",
    "calendar_day",
    "day_text",
    "ellipsoid_metres",
    "fare",
    "geodesic_metres",
    "minutes_between",
    "month_runs",
    "round_half_even",
    "utc_day",
]
