"""Classification of delays and of the time of day. Arguments are column names or SQL
expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Delay limits in minutes, category names, rush hours (UTC, inclusive).
ON_TIME_LIMIT = 5
DELAY_LIMITS = {"on_time": 5, "slightly_late": 15, "late": 30}
DELAY_CATEGORIES = ["early", "on_time", "slightly_late", "late", "very_late", "unknown"]
RUSH_HOURS = {"morning_rush": (6, 9), "evening_rush": (16, 19)}
TIMES_OF_DAY = ["morning_rush", "off_peak", "evening_rush"]
WEEKEND_DAYS = (0, 6)


def is_on_time(delay: str) -> Column:
    """True up to the limit, early included; NULL when the delay is unknown."""
    return F.expr(f"{delay} <= {ON_TIME_LIMIT}")


def delay_category(delay: str) -> Column:
    limits = " ".join(f"WHEN {delay} <= {limit} THEN '{name}'" for name, limit in DELAY_LIMITS.items())
    known = f"WHEN {delay} < 0 THEN 'early' {limits} ELSE 'very_late'"
    return F.expr(f"CASE WHEN {delay} IS NULL THEN 'unknown' {known} END")


def time_of_day_category(hour: str) -> Column:
    rush = " ".join(f"WHEN {hour} BETWEEN {a} AND {b} THEN '{name}'" for name, (a, b) in RUSH_HOURS.items())
    return F.expr(f"CASE {rush} ELSE 'off_peak' END")


def is_weekend(dow: str) -> Column:
    return F.expr(f"coalesce({dow} IN {WEEKEND_DAYS}, false)")


def _rank(value: str, order: list[str]) -> Column:
    """Position of `value` in a fixed order; other values come last."""
    listed = ", ".join(f"'{v}'" for v in order)
    return F.expr(f"nullif(array_position(array({listed}), {value}), 0)").asc_nulls_last()


def delay_category_rank(category: str) -> Column:
    return _rank(category, DELAY_CATEGORIES)


def time_of_day_rank(category: str) -> Column:
    return _rank(category, TIMES_OF_DAY)
