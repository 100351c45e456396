"""Headline figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.functions import merged_measures, percentage
from punctual.plans.marts import Marts
from punctual.plans.reports.common import otp, rolled_up

# The categories on the front page.
MAIN_CATEGORIES = ["Long-distance", "Commuter", "Cargo", "Locomotive"]


def overall_metrics(marts: Marts) -> DataFrame:
    overall = marts["on_time_performance"].where("metric_scope = 'Overall'")
    return overall.select(
        "total_trains",
        "total_events",
        F.col("on_time_percentage").alias("otp_percentage"),
        "avg_delay_minutes",
        F.col("total_stations").alias("stations_served"),
    )


def rush_stats(marts: Marts) -> DataFrame:
    hours = marts["hourly_delay_categories"].where("time_of_day_category = 'morning_rush'")
    return rolled_up(hours).select(otp().alias("morning_rush_otp"))


def _main_categories(marts: Marts) -> DataFrame:
    return marts["on_time_performance"].where(F.col("metric_scope").isin(MAIN_CATEGORIES))


def category_ranking(marts: Marts) -> DataFrame:
    return (
        _main_categories(marts)
        .select(F.col("metric_scope").alias("category"), "on_time_percentage")
        .orderBy(F.desc_nulls_last("on_time_percentage"), "category")
    )


def category_extremes(marts: Marts) -> DataFrame:
    """First and last of the ranking; equal shares are ordered by name."""
    share = F.col("on_time_percentage")
    # the best of a tie is the first name, the worst is the last: the ranking's two ends
    first_of = F.min_by("metric_scope", F.struct((-share).alias("share"), "metric_scope"))
    last_of = F.max_by("metric_scope", F.struct((-share).alias("share"), "metric_scope"))
    return _main_categories(marts).agg(
        first_of.alias("best_category"),
        F.max(share).alias("best_otp"),
        last_of.alias("worst_category"),
        F.min(share).alias("worst_otp"),
    )


def category_table(marts: Marts) -> DataFrame:
    return (
        _main_categories(marts)
        .select(
            F.col("metric_scope").alias("train_category"),
            F.col("total_trains").alias("trains"),
            F.col("total_events").alias("stops"),
            F.col("on_time_percentage").alias("otp_percentage"),
            F.col("avg_delay_minutes").alias("avg_delay"),
        )
        .orderBy(F.desc_nulls_last("otp_percentage"), "train_category")
    )


def _coverage() -> tuple[Column, Column, Column]:
    return F.countDistinct("departureDate"), F.min("departureDate"), F.max("departureDate")


def data_coverage(marts: Marts) -> DataFrame:
    days, first, last = _coverage()
    return marts["timetable_coverage"].agg(
        days.alias("days_covered"), first.alias("oldest_day"), last.alias("newest_day")
    )


def data_period(marts: Marts) -> DataFrame:
    days, first, last = _coverage()
    return marts["timetable_coverage"].agg(
        first.alias("first_day"), last.alias("last_day"), days.alias("days_covered")
    )


def freshness(marts: Marts) -> DataFrame:
    """Newest actual time to the minute, as text."""
    newest = F.max("max_actual_time").cast("string")
    return marts["timetable_coverage"].agg(F.substring(newest, 1, 16).alias("latest_timestamp"))


def hourly_performance(marts: Marts) -> DataFrame:
    by_hour = rolled_up(marts["hourly_delay_categories"], "scheduled_hour")
    return by_hour.select("scheduled_hour", otp(), "events").orderBy("scheduled_hour")


def best_hour(marts: Marts) -> DataFrame:
    return hourly_performance(marts).orderBy(F.desc_nulls_last("otp_percentage"), "scheduled_hour").limit(1)


def worst_hour(marts: Marts) -> DataFrame:
    return hourly_performance(marts).orderBy(F.asc_nulls_last("otp_percentage"), "scheduled_hour").limit(1)


def rush_verdict(marts: Marts) -> DataFrame:
    """Morning rush against all events, as the headline sentence puts it."""
    rush = "FILTER (WHERE time_of_day_category = 'morning_rush')"
    totals = marts["hourly_delay_categories"].agg(
        F.expr(f"sum(on_time_events) {rush} AS rush_on_time"),
        F.expr(f"sum(events) {rush} AS rush_events"),
        *merged_measures("on_time_events", "events"),
    )
    rush_otp = percentage("rush_on_time", "rush_events").alias("morning_rush_otp")
    shares = totals.select(rush_otp, otp())
    below = F.col("morning_rush_otp") < F.col("otp_percentage")
    return shares.withColumn("verdict", F.when(below, "below").otherwise("slightly above"))
