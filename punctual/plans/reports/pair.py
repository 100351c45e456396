"""Head-to-head reports on two train types over the last N days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.functions import (
    average_delay,
    delay_category_rank,
    merged_measures,
    on_time_percentage,
    round2,
    share_of,
)
from punctual.operators.ranges import last_days
from punctual.plans.gold import PAIR
from punctual.plans.marts import Marts
from punctual.plans.reports.common import mean, otp, rolled_up, trains_per

# The default period, "all time", the volume gate and length of the
# route tables.
DEFAULT_DAYS = 7
ALL_TIME = 100_000
MIN_ROUTE_STOPS = 100
TOP = 10


def _recent(marts: Marts, table: str, days: int) -> DataFrame:
    return last_days(marts[table], "departureDate", marts["timetable_coverage"], days)


def period_metrics(marts: Marts, days: int = DEFAULT_DAYS, pair: tuple[str, str] = PAIR) -> DataFrame:
    stations = F.countDistinct("stationShortCode").alias("stations")
    per_station = rolled_up(_recent(marts, "pair_station_daily", days), "trainType", "stationShortCode")
    stops = per_station.groupBy("trainType").agg(
        *merged_measures("events", "on_time_events", "delay_sum", "delay_count"), stations
    )
    spans = _recent(marts, "train_spans", days).where(F.col("trainType").isin(*pair))
    return stops.join(trains_per(spans, "trainType"), "trainType", "left").select(
        F.col("trainType").alias("train_type"),
        on_time_percentage().alias("on_time_percentage"),
        average_delay().alias("avg_delay_minutes"),
        F.col("trains").alias("total_trains"),
        F.col("events").alias("total_stops"),
        F.col("stations").alias("stations_served"),
    )


def type_metrics(marts: Marts, train_type: str, days: int = DEFAULT_DAYS) -> DataFrame:
    return period_metrics(marts, days).where(F.col("train_type") == train_type)


def comparison_summary(marts: Marts, days: int = DEFAULT_DAYS) -> DataFrame:
    """Winner first."""
    return period_metrics(marts, days).orderBy(F.desc_nulls_last("on_time_percentage"), "train_type")


def _of(train_type: str, column: str) -> str:
    return f"max(if(train_type = '{train_type}', {column}, NULL))"


def _times(a: str, b: str) -> Column:
    """How many times more, one digit; NULL if either side is absent or zero."""
    return F.expr(f"if({a} <> 0 AND {b} <> 0, floor({a} / {b} * 10.0D + 0.5D) / 10.0D, NULL)")


def complexity_ratios(marts: Marts, days: int = DEFAULT_DAYS, pair: tuple[str, str] = PAIR) -> DataFrame:
    """How many times more trains and stations the first type has."""
    first, second = pair
    return period_metrics(marts, days, pair).agg(
        _times(_of(first, "total_trains"), _of(second, "total_trains")).alias("train_ratio"),
        _times(_of(first, "stations_served"), _of(second, "stations_served")).alias("station_ratio"),
    )


def performance_gap(marts: Marts, days: int = DEFAULT_DAYS, pair: tuple[str, str] = PAIR) -> DataFrame:
    """Gaps in percentage points and minutes, and the delay multiplier."""
    first, second = pair
    otp_, delay = "on_time_percentage", "avg_delay_minutes"
    return period_metrics(marts, days, pair).agg(
        round2(f"{_of(second, otp_)} - {_of(first, otp_)}").alias("otp_gap"),
        round2(f"{_of(first, delay)} - {_of(second, delay)}").alias("delay_gap"),
        round2(f"try_divide({_of(first, delay)}, {_of(second, delay)})").alias("delay_multiplier"),
    )


def delay_distribution(marts: Marts, days: int = DEFAULT_DAYS) -> DataFrame:
    recent = _recent(marts, "pair_hourly_daily", days)
    counts = recent.groupBy("trainType", "delay_category").agg(F.sum("events").alias("events"))
    return counts.select(
        F.col("trainType").alias("train_type"),
        "delay_category",
        "events",
        share_of("events", "trainType").alias("percentage"),
    ).orderBy("train_type", delay_category_rank("delay_category"))


def hourly_comparison(marts: Marts, days: int = DEFAULT_DAYS) -> DataFrame:
    by_hour = rolled_up(_recent(marts, "pair_hourly_daily", days), "scheduled_hour", "trainType")
    return by_hour.select(
        "scheduled_hour", F.col("trainType").alias("train_type"), otp(), mean(), "events"
    ).orderBy("scheduled_hour", "train_type")


def route_stations(
    marts: Marts, train_type: str, min_stops: int = MIN_ROUTE_STOPS, top: int = TOP
) -> DataFrame:
    """Most punctual stations of one train type, with enough stops."""
    daily = marts["pair_station_daily"].where(F.col("trainType") == train_type)
    per_station = rolled_up(daily, "stationShortCode").where(F.col("events") >= min_stops)
    return (
        per_station.join(marts["dim_stations"], "stationShortCode")
        .select("stationName", "stationShortCode", F.col("events").alias("stops"), otp(), mean())
        .orderBy(F.desc_nulls_last("otp_percentage"), "stationShortCode")
        .limit(top)
    )
