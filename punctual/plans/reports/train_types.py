"""Reports per train type and category."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.functions import (
    average_delay,
    delay_category_rank,
    delay_stddev,
    merged_measures,
    round2,
    share_of,
)
from punctual.operators.histogram import weighted_percentile
from punctual.operators.ranges import in_range, overlaps
from punctual.plans.marts import Marts
from punctual.plans.reports.common import mean, otp, rolled_up, same_keys, trains_per

# Volume gates, the pattern for "all categories", groups and types of the
# comparison tables.
MIN_TRAINS = 50
MIN_ROWS = 1000
TOP = 5
ALL_CATEGORIES = "%"
COMPARED_CATEGORIES = ["Commuter", "Long-distance"]
WEEKEND_TYPES = ["IC", "HDM", "S", "P"]

KEYS = ["trainType", "trainCategory"]


def category_options(marts: Marts) -> DataFrame:
    coverage = marts["timetable_coverage"]
    category = F.col("trainCategory").alias("category")
    return coverage.select(category).where("category IS NOT NULL").distinct().orderBy("category")


def event_bounds(marts: Marts) -> DataFrame:
    """First and last actual time as two rows, the bounds of a date picker. The two
    values come from one pass."""
    bounds = marts["timetable_coverage"].agg(F.min("min_actual_time"), F.max("max_actual_time"))
    first, last = (F.col(f"`{c}`") for c in bounds.columns)
    return bounds.select(F.explode(F.array(first, last)).alias("actual_time"))


def _with_labels(stops: DataFrame, *columns: str | Column) -> DataFrame:
    return stops.select(F.col("trainType").alias("train_type"), *columns)


def train_rankings(
    marts: Marts,
    start: str | dt.date,
    end: str | dt.date,
    category: str = ALL_CATEGORIES,
    min_trains: int = MIN_TRAINS,
) -> DataFrame:
    """Types and categories by punctuality between midnight of `start` and of `end`.

    The category is a LIKE pattern, so rows without a category never match.
    """
    chosen = F.col("trainCategory").like(category)
    days = marts["daily_performance"].where(chosen & in_range("actual_bucket", start, end))
    spans = marts["train_spans"].where(chosen & overlaps(start, end))
    presence = marts["station_presence"].where(chosen & overlaps(start, end))

    trains = trains_per(spans, *KEYS).where(F.col("trains") >= min_trains)
    stations = presence.groupBy(*KEYS).agg(F.countDistinct("stationShortCode").alias("stations_served"))
    ranked = same_keys(same_keys(rolled_up(days, *KEYS), trains, KEYS), stations, KEYS, "left")
    return _with_labels(
        ranked,
        F.col("trainCategory").alias("category"),
        "trains",
        F.col("events").alias("total_stops"),
        otp(),
        mean(),
        delay_stddev().alias("delay_stddev"),
        "stations_served",
    ).orderBy(F.desc_nulls_last("otp_percentage"), F.asc_nulls_last("train_type"), F.asc_nulls_last("category"))


def category_performance(marts: Marts) -> DataFrame:
    per_type = rolled_up(marts["daily_performance"], *KEYS)
    stops = per_type.groupBy("trainCategory").agg(
        F.count("trainType").alias("train_types"),  # one row per type here, NULL not counted
        *merged_measures("events", "on_time_events", "delay_sum", "delay_count"),
    )
    trains = trains_per(marts["train_spans"], "trainCategory")
    return (
        same_keys(stops, trains, ["trainCategory"], "left")
        .select(
            F.col("trainCategory").alias("category"),
            "train_types",
            "trains",
            F.col("events").alias("stops"),
            otp(),
            mean(),
        )
        .orderBy(F.desc_nulls_last("otp_percentage"), F.asc_nulls_last("category"))
    )


def delay_by_type(marts: Marts, min_rows: int = MIN_ROWS) -> DataFrame:
    """Share of each delay category, for types with enough timetable rows of any kind."""
    rows = marts["timetable_coverage"].groupBy("trainType").agg(F.sum("events").alias("rows"))
    large = rows.where(F.col("rows") >= min_rows)
    groups = marts["hourly_delay_categories"].groupBy("trainType", "delay_category")
    counts = groups.agg(F.sum("events").alias("events")).join(large, "trainType", "left_semi")
    share = share_of("events", "trainType").alias("percentage")
    return _with_labels(counts, "delay_category", "events", share).orderBy(
        "train_type", delay_category_rank("delay_category")
    )


def top_performers(marts: Marts, min_trains: int = MIN_TRAINS, top: int = TOP) -> DataFrame:
    trains = trains_per(marts["train_spans"], *KEYS).where(F.col("trains") >= min_trains)
    ranked = same_keys(rolled_up(marts["daily_performance"], *KEYS), trains, KEYS)
    order = [F.desc_nulls_last("otp_percentage"), F.asc_nulls_last("train_type"), F.asc_nulls_last("category")]
    category = F.col("trainCategory").alias("category")
    return _with_labels(ranked, category, "trains", otp(), mean()).orderBy(*order).limit(top)


def consistency(marts: Marts, min_trains: int = MIN_TRAINS) -> DataFrame:
    """Spread of the delays per type, the median exact from the histogram."""
    stats = (
        marts["delay_histogram"]
        .groupBy("trainType")
        .agg(
            *merged_measures("delay_count", "delay_sum", "delay_sumsq"),
            F.min("delay_minutes").alias("min_delay"),
            F.max("delay_minutes").alias("max_delay"),
            weighted_percentile("delay_minutes", "delay_count", 0.5).alias("median"),
        )
    )
    trains = trains_per(marts["train_spans"], "trainType").where(F.col("trains") >= min_trains)
    return _with_labels(
        same_keys(stats, trains, ["trainType"]),
        "trains",
        average_delay().alias("avg_delay"),
        delay_stddev().alias("delay_stddev"),
        "min_delay",
        "max_delay",
        round2("median").alias("median_delay"),
    ).orderBy(F.asc_nulls_last("delay_stddev"), F.asc_nulls_last("train_type"))


def category_comparison(marts: Marts) -> DataFrame:
    group = F.col("trainCategory").alias("category_group")
    chosen = F.col("trainCategory").isin(COMPARED_CATEGORIES)
    stops = rolled_up(marts["daily_performance"].where(chosen), group)
    spans = marts["train_spans"].where(chosen)
    trains = spans.groupBy(group).agg(F.sum("n_trains").alias("trains"))
    return (
        stops.join(trains, "category_group", "left")
        .select("category_group", "trains", F.col("events").alias("stops"), otp(), mean())
        .orderBy(F.desc_nulls_last("otp_percentage"), "category_group")
    )


def category_pivot(marts: Marts) -> DataFrame:
    def share(category: str) -> Column:
        return F.max(F.when(F.col("category_group") == category, F.col("otp_percentage")))

    return category_comparison(marts).agg(
        share("Commuter").alias("commuter_otp"), share("Long-distance").alias("long_distance_otp")
    )


def weekend_comparison(marts: Marts, types: list[str] | None = None) -> DataFrame:
    chosen = marts["daily_performance"].where(F.col("trainType").isin(types or WEEKEND_TYPES))
    groups = rolled_up(chosen, "trainType", "is_weekend")
    return _with_labels(groups, "is_weekend", F.col("events").alias("stops"), otp(), mean()).orderBy(
        "train_type", "is_weekend"
    )
