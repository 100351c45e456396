"""The declared data tests of every table."""

from __future__ import annotations

from punctual.functions.delays import DELAY_CATEGORIES, TIMES_OF_DAY
from punctual.operators.quality import (
    WARN,
    ReferenceTest,
    TableTests,
    UniqueTest,
    accepted_values,
    expression_is_true,
    not_null,
)
from punctual.plans.gold import PAIR

# Accepted values of source columns.
STATION_TYPES = ["STATION", "STOPPING_POINT", "TURNOUT_IN_THE_OPEN_LINE"]
COUNTRIES = ["FI"]
TRAIN_CATEGORIES = ["Long-distance", "Commuter", "Cargo", "Locomotive", "On-track machines"]
EVENT_TYPES = ["ARRIVAL", "DEPARTURE"]

MEASURES_AGREE = expression_is_true("on_time_events <= events AND delay_count <= events")
PAIR_TYPES = accepted_values("trainType", list(PAIR))
DELAY_LABELS = accepted_values("delay_category", DELAY_CATEGORIES)


def _all_present(*columns: str) -> list:
    return [not_null(c) for c in columns]


def _expected(*columns: str) -> list:
    """Columns copied from the source: a NULL is reported and does not stop a build."""
    return [not_null(c, WARN) for c in columns]


SUITE: dict[str, TableTests] = {
    "stations": TableTests(
        rows=[
            *_all_present("stationShortCode", "stationName", "stationUICCode", "latitude", "longitude"),
            *_all_present("passengerTraffic", "type", "countryCode", "_loaded_at", "_source_file", "_run_id"),
            accepted_values("type", STATION_TYPES),
            accepted_values("countryCode", COUNTRIES, WARN),
        ],
        unique=[
            UniqueTest(("stationShortCode",), skip_nulls=True),
            UniqueTest(("stationUICCode",), skip_nulls=True, severity=WARN),
        ],
    ),
    "train_departures": TableTests(
        rows=[
            *_all_present("trainNumber", "departureDate", "operatorShortCode", "trainType", "trainCategory"),
            *_all_present("cancelled", "_loaded_at", "_source_file", "_run_id"),
            accepted_values("trainCategory", TRAIN_CATEGORIES, WARN),
        ],
        unique=[UniqueTest(("trainNumber", "departureDate"))],
    ),
    "timetable_unnested": TableTests(
        rows=_all_present("trainNumber", "departureDate", "stationShortCode", "scheduledTime")
    ),
    "fact_timetable_events": TableTests(
        rows=[
            *_all_present("sk_event", "trainNumber", "departureDate", "event_type"),
            accepted_values("event_type", EVENT_TYPES),
            DELAY_LABELS,
        ],
        # the key is made from the day among others
        unique=[UniqueTest(("sk_event",), skip_nulls=True, within_day=True)],
        references=[ReferenceTest("stationShortCode", "dim_stations")],
    ),
    "dim_stations": TableTests(
        rows=_all_present("sk_station", "stationShortCode"),
        unique=[
            UniqueTest(("sk_station",), skip_nulls=True),
            UniqueTest(("stationShortCode",), skip_nulls=True),
        ],
    ),
    "on_time_performance": TableTests(rows=_all_present("metric_scope")),
    "pair_comparison": TableTests(
        rows=[
            *_all_present("train_type", "on_time_percentage", "performance_verdict"),
            accepted_values("train_type", list(PAIR)),
        ]
    ),
    "station_performance": TableTests(
        rows=_all_present("station_code"), unique=[UniqueTest(("station_code",), skip_nulls=True)]
    ),
    "daily_performance": TableTests(
        rows=[
            *_all_present("actual_bucket", "day_of_week", "is_weekend", "events"),
            *_expected("trainType", "trainCategory"),
            MEASURES_AGREE,
        ],
        unique=[UniqueTest(("actual_bucket", "trainType", "trainCategory", "day_of_week", "scheduled_month"))],
    ),
    "hourly_delay_categories": TableTests(
        rows=[
            *_all_present("time_of_day_category", "delay_category", "events"),
            *_expected("scheduled_hour", "trainType", "trainCategory"),
            accepted_values("time_of_day_category", TIMES_OF_DAY),
            DELAY_LABELS,
            MEASURES_AGREE,
        ],
        unique=[UniqueTest(("scheduled_hour", "trainType", "trainCategory", "delay_category"))],
    ),
    "delay_histogram": TableTests(
        rows=[
            *_all_present("events"),
            *_expected("trainType"),
            expression_is_true("delay_count = CASE WHEN delay_minutes IS NULL THEN 0 ELSE events END"),
        ],
        unique=[UniqueTest(("trainType", "delay_minutes"))],
    ),
    "train_spans": TableTests(
        rows=[
            *_all_present("departureDate", "first_actual_bucket", "last_actual_bucket"),
            *_all_present("midnight_days", "n_trains"),
            *_expected("trainType", "trainCategory"),
            expression_is_true("first_actual_bucket <= last_actual_bucket AND n_trains >= 1"),
            # range filters on spans are exact while a train stays within two UTC days
            expression_is_true("datediff(last_actual_bucket, first_actual_bucket) <= 1", WARN),
        ],
        unique=[
            UniqueTest(
                (
                    *("departureDate", "trainType", "trainCategory"),
                    *("first_actual_bucket", "last_actual_bucket", "midnight_days"),
                    *("has_morning_rush", "has_off_peak", "has_evening_rush", "has_weekday", "has_weekend"),
                )
            )
        ],
    ),
    "station_presence": TableTests(
        rows=[
            *_all_present("first_actual_bucket", "midnight_days"),
            *_expected("trainType", "trainCategory", "stationShortCode"),
            expression_is_true("first_actual_bucket <= last_actual_bucket"),
        ],
        unique=[UniqueTest(("trainType", "trainCategory", "stationShortCode", "first_actual_bucket"))],
    ),
    "pair_station_daily": TableTests(
        rows=[*_all_present("departureDate", "trainType"), PAIR_TYPES, *_expected("stationShortCode")],
        unique=[UniqueTest(("departureDate", "trainType", "stationShortCode"))],
    ),
    "pair_hourly_daily": TableTests(
        rows=[*_all_present("departureDate", "trainType", "delay_category"), PAIR_TYPES, DELAY_LABELS],
        unique=[UniqueTest(("departureDate", "trainType", "scheduled_hour", "delay_category"))],
    ),
    "timetable_coverage": TableTests(
        rows=_all_present("departureDate", "events"),
        unique=[UniqueTest(("departureDate", "trainType", "trainCategory"))],
    ),
}
