"""Additive measures and the ratios that follow from them.

A roll-up stores five sums. They can be added over any set of rows, and on-time
share, average and sample deviation of the union follow exactly, so a report never
has to go back to the events.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MEASURES = ["events", "on_time_events", "delay_sum", "delay_sumsq", "delay_count"]
EVENT_MEASURES = {
    "events": "count(1)",
    "on_time_events": "count_if(is_on_time)",
    "delay_sum": "sum(delay_minutes)",
    "delay_sumsq": "sum(delay_minutes * delay_minutes)",
    "delay_count": "count(delay_minutes)",
}


def event_measures() -> list[Column]:
    """The five measures over event rows."""
    return [F.expr(f"{text} AS {name}") for name, text in EVENT_MEASURES.items()]


def merged_measures(*names: str) -> list[Column]:
    """The five measures, or the named ones, over rows that already hold them."""
    return [F.expr(f"sum({name}) AS {name}") for name in names or MEASURES]


# Two digits, scaling first: on ties this is what DuckDB's round(x, 2) returns.
ROUND2 = "round(({0}) * 100.0D) / 100.0D"


def round2(value: str) -> Column:
    return F.expr(ROUND2.format(value))


def percentage(part: str, whole: str) -> Column:
    """100 * part / whole, two digits; NULL when the whole is 0."""
    return round2(f"try_divide(100.0D * {part}, {whole})")


def on_time_percentage() -> Column:
    return percentage("on_time_events", "events")


def average_delay() -> Column:
    return round2("try_divide(cast(delay_sum AS double), delay_count)")


def delay_stddev() -> Column:
    """Sample standard deviation from the sums; NULL below two known delays."""
    n, s, ss = (f"cast({c} AS double)" for c in ("delay_count", "delay_sum", "delay_sumsq"))
    spread = f"greatest({n} * {ss} - {s} * {s}, 0.0D)"  # rounding must not push it below 0
    return round2(f"sqrt(try_divide({spread}, {n} * ({n} - 1.0D)))")


def share_of(part: str, group: str) -> Column:
    """`part` as a percentage of its total over the group. Used on rolled-up rows
    only, where a group holds one row per delay category."""
    return percentage(part, f"sum({part}) OVER (PARTITION BY {group})")
