"""Column helpers: plain functions that return Spark columns, no UDFs."""

from punctual.functions.calendar import (
    actual_bucket,
    day_name,
    day_of_week,
    midnight_day,
    month_name,
    parse_event_time,
)
from punctual.functions.delays import (
    delay_category,
    delay_category_rank,
    is_on_time,
    is_weekend,
    time_of_day_category,
    time_of_day_rank,
)
from punctual.functions.keys import surrogate_key
from punctual.functions.measures import (
    MEASURES,
    average_delay,
    delay_stddev,
    event_measures,
    merged_measures,
    on_time_percentage,
    percentage,
    round2,
    share_of,
)

__all__ = [
    "MEASURES",
    "actual_bucket",
    "average_delay",
    "day_name",
    "day_of_week",
    "delay_category",
    "delay_category_rank",
    "delay_stddev",
    "event_measures",
    "is_on_time",
    "is_weekend",
    "merged_measures",
    "midnight_day",
    "month_name",
    "on_time_percentage",
    "parse_event_time",
    "percentage",
    "round2",
    "share_of",
    "surrogate_key",
    "time_of_day_category",
    "time_of_day_rank",
]
