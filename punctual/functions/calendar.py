"""Dates and times. Arguments are column names or SQL expressions. Everything works on
timestamps without zone, so no result depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text format of event times, weekday names from 0 = Sunday,
# month names from 1 = January.
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June", "July",
    "August", "September", "October", "November", "December",
]


def parse_event_time(text: str) -> Column:
    """UTC text to timestamp without zone; malformed text raises in ANSI mode."""
    return F.expr(f'to_timestamp_ntz({text}, "{EVENT_TIME_FORMAT}")')


def _midnight(ts: str) -> str:
    return f"cast(cast({ts} AS date) AS timestamp_ntz)"


def actual_bucket(ts: str) -> Column:
    """The day of `ts` at noon; a stamp at exactly 00:00:00 stays as it is.

    Grouping by this keeps `BETWEEN day AND day` filters exact: a range that ends on
    a day includes that day's midnight stamp and nothing else of it.
    """
    return F.expr(f"if({ts} = {_midnight(ts)}, {ts}, {_midnight(ts)} + INTERVAL '12' HOUR)")


def midnight_day(ts: str) -> Column:
    """The ISO day of a stamp at exactly 00:00:00, else NULL."""
    return F.expr(f"if({ts} = {_midnight(ts)}, cast(cast({ts} AS date) AS string), NULL)")


def day_of_week(ts: str) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.expr(f"dayofweek({ts}) - 1")


def _nth(names: list[str], position: str) -> Column:
    listed = ", ".join(f"'{n}'" for n in names)
    return F.expr(f"try_element_at(array({listed}), cast({position} AS int))")


def day_name(dow: str) -> Column:
    return _nth(DAY_NAMES, f"{dow} + 1")


def month_name(month: str) -> Column:
    return _nth(MONTH_NAMES, month)
