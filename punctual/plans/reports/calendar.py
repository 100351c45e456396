"""Patterns over the hours, weekdays and months."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.functions import (
    day_name,
    delay_category_rank,
    delay_stddev,
    month_name,
    round2,
    share_of,
    time_of_day_rank,
)
from punctual.plans.marts import Marts
from punctual.plans.reports.common import mean, otp, rolled_up

# The train types of the hourly chart.
HOURLY_TYPES = ["IC", "HDM", "S", "P", "HL", "T", "SAA", "VET"]


def _trains_with(marts: Marts, key: str, flags: dict[str, Column]) -> DataFrame:
    """One row per flag with the number of trains that carry it; a train with several
    flags counts in each. One pass over the spans, then unpivoted."""
    spans = marts["train_spans"]
    counted = spans.agg(*[F.sum(F.when(F.col(f), F.col("n_trains"))).alias(f) for f in flags])
    rows = [F.struct(value.alias(key), F.col(f).alias("trains")) for f, value in flags.items()]
    return counted.select(F.inline(F.array(*rows)))


def hourly_pattern(marts: Marts) -> DataFrame:
    by_hour = rolled_up(marts["hourly_delay_categories"], "scheduled_hour")
    return by_hour.select(
        "scheduled_hour", "events", otp(), mean(), delay_stddev().alias("delay_stddev")
    ).orderBy("scheduled_hour")


def rush_hour_performance(marts: Marts) -> DataFrame:
    key = "time_of_day_category"
    stops = rolled_up(marts["hourly_delay_categories"], key)
    trains = _trains_with(
        marts, key, {f"has_{c}": F.lit(c) for c in ("morning_rush", "off_peak", "evening_rush")}
    )
    return (
        stops.join(trains, key, "left")
        .select(key, "events", "trains", otp(), mean())
        .orderBy(time_of_day_rank(key))
    )


def rush_insight(marts: Marts) -> DataFrame:
    """Does the morning rush run better than off-peak hours?"""
    stops = rolled_up(marts["hourly_delay_categories"], "time_of_day_category").select(
        "time_of_day_category", otp()
    )

    def share(category: str) -> Column:
        value = F.max(F.when(F.col("time_of_day_category") == category, F.col("otp_percentage")))
        return F.coalesce(value, F.lit(0.0))

    return stops.agg(
        F.when(share("morning_rush") > share("off_peak"), "morning rush").otherwise("off-peak").alias("better")
    )


def weekday_performance(marts: Marts) -> DataFrame:
    by_day = rolled_up(marts["daily_performance"], "day_of_week")
    name = day_name("day_of_week").alias("day_name")
    return by_day.select("day_of_week", name, "events", otp(), mean()).orderBy("day_of_week")


def weekend_by_category(marts: Marts) -> DataFrame:
    groups = rolled_up(marts["daily_performance"], "is_weekend", "trainCategory")
    category = F.col("trainCategory").alias("category")
    return groups.select("is_weekend", category, "events", otp(), mean()).orderBy(
        "is_weekend", F.desc_nulls_last("otp_percentage"), F.asc_nulls_last("category")
    )


def weekend_summary(marts: Marts) -> DataFrame:
    stops = rolled_up(marts["daily_performance"], "is_weekend")
    trains = _trains_with(marts, "is_weekend", {"has_weekday": F.lit(False), "has_weekend": F.lit(True)})
    period = F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday").alias("period")
    return (
        stops.join(trains, "is_weekend", "left")
        .orderBy("is_weekend")
        .select(period, "events", "trains", otp(), mean())
    )


def weekend_pivot(marts: Marts) -> DataFrame:
    def share(weekend: bool) -> Column:
        def total(measure: str) -> str:
            return f"sum(if(is_weekend = {weekend}, {measure}, 0))"

        return round2(f"try_divide(cast({total('on_time_events')} AS double), {total('events')}) * 100.0D")

    return marts["daily_performance"].agg(share(False).alias("weekday_otp"), share(True).alias("weekend_otp"))


def monthly_trends(marts: Marts) -> DataFrame:
    by_month = rolled_up(marts["daily_performance"], "scheduled_month")
    name = month_name("scheduled_month").alias("month_name")
    return by_month.select("scheduled_month", name, "events", otp(), mean()).orderBy("scheduled_month")


def hourly_by_type(marts: Marts, types: list[str] | None = None) -> DataFrame:
    chosen = marts["hourly_delay_categories"].where(F.col("trainType").isin(types or HOURLY_TYPES))
    groups = rolled_up(chosen, "scheduled_hour", "trainType")
    return groups.select("scheduled_hour", F.col("trainType").alias("train_type"), otp()).orderBy(
        "scheduled_hour", "train_type"
    )


def best_worst_days(marts: Marts) -> DataFrame:
    """Weekdays by punctuality, the best and the worst marked. The window covers the
    seven weekdays."""
    days = weekday_performance(marts).where("day_name IS NOT NULL")
    week = Window.partitionBy(F.lit(1))
    share = F.col("otp_percentage")
    label = F.when(share == F.max(share).over(week), "best").when(share == F.min(share).over(week), "worst")
    return (
        days.withColumn("performance", label)
        .orderBy(F.desc_nulls_last("otp_percentage"), "day_of_week")
        .select("day_name", "otp_percentage", "performance")
    )


def delay_accumulation(marts: Marts) -> DataFrame:
    groups = marts["hourly_delay_categories"].groupBy("scheduled_hour", "delay_category")
    counts = groups.agg(F.sum("events").alias("events"))
    share = share_of("events", "scheduled_hour").alias("percentage")
    return counts.select("scheduled_hour", "delay_category", "events", share).orderBy(
        "scheduled_hour", delay_category_rank("delay_category")
    )


def delay_trend(marts: Marts) -> DataFrame:
    """Do late shares add up to more from 16:00 on than before noon?"""
    late = delay_accumulation(marts).where("delay_category = 'late'")
    hour, share = F.col("scheduled_hour"), F.col("percentage")

    def total(hours: Column) -> Column:
        return F.coalesce(F.sum(F.when(hours, share)), F.lit(0.0))

    evening, morning = total(hour >= 16), total(hour < 12)
    return late.agg(F.when(evening > morning, "accumulate").otherwise("stable").alias("trend"))
