"""Partial roll-ups per day, and the gold tables that follow from them.

The fact of a day changes only when that day is loaded again, so everything a roll-up needs of
it is kept as one small state per day: sums that can be added, value counts, and sets of
distinct keys. A reload replaces the states of its days; gold tables are merged from states and
never read an event. Trains belong to one departure day, so their numbers add up over days;
stations and scheduled days do not, and are kept as sets.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.functions import event_measures, merged_measures
from punctual.operators.runs import day_runs
from punctual.operators.scopes import BY_TYPE, CATEGORY, KEYS, TYPE, aggregate_scopes
from punctual.plans import gold
from punctual.plans.gold import TRAIN_KEYS
from punctual.sources.tables import DAY

STATION = "stationShortCode"
Read = Callable[[str], DataFrame]


def delay_counts(fact: DataFrame) -> DataFrame:
    """Measures per type, category, kind of event and delay."""
    keys = [DAY, TYPE, CATEGORY, "event_type", "delay_minutes"]
    return gold.commercial(fact).groupBy(*keys).agg(*event_measures())


def bucket_counts(fact: DataFrame) -> DataFrame:
    """The daily roll-up of each departure day: late trains reach into the next one."""
    return gold.with_bucket(gold.commercial(fact)).groupBy(DAY, *gold.DAILY_KEYS).agg(*event_measures())


def hour_counts(fact: DataFrame) -> DataFrame:
    return gold.commercial(fact).groupBy(DAY, *gold.HOURLY_KEYS).agg(*event_measures())


def station_counts(fact: DataFrame) -> DataFrame:
    """Measures and number of trains per station."""
    trains = F.countDistinct(*TRAIN_KEYS).alias("total_trains")
    return gold.commercial(fact).groupBy(DAY, STATION).agg(*event_measures(), trains)


def served_stations(fact: DataFrame) -> DataFrame:
    """The stations that a type and category served, by midnight."""
    events = gold.with_bucket(gold.commercial(fact))
    return events.select(DAY, TYPE, CATEGORY, STATION, "actual_bucket").distinct()


def scope_trains(fact: DataFrame) -> DataFrame:
    """Number of trains in all, per type and per category."""
    trains = gold.commercial(fact).select(*TRAIN_KEYS, TYPE, CATEGORY).distinct()
    return aggregate_scopes(trains, F.countDistinct(*TRAIN_KEYS).alias("total_trains"), within=[DAY])


def scheduled_days(fact: DataFrame) -> DataFrame:
    """The days that a type has events scheduled on."""
    day = F.col("scheduled_time").cast("date").alias("scheduled_day")
    return gold.commercial(fact).select(DAY, TYPE, day).distinct()


#: state -> function of the fact of some days; each has a departure day
STATES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "delay_counts": delay_counts,
    "bucket_counts": bucket_counts,
    "hour_counts": hour_counts,
    "station_counts": station_counts,
    "served_stations": served_stations,
    "scope_trains": scope_trains,
    "scheduled_days": scheduled_days,
}


# merging


def _merged(states: DataFrame, *keys: str) -> DataFrame:
    return states.groupBy(*keys).agg(*merged_measures())


def daily_performance(read: Read) -> DataFrame:
    return _merged(read("bucket_counts"), *gold.DAILY_KEYS)


def hourly_delay_categories(read: Read) -> DataFrame:
    return _merged(read("hour_counts"), *gold.HOURLY_KEYS)


def delay_histogram(read: Read) -> DataFrame:
    return _merged(read("delay_counts"), TYPE, "delay_minutes")


def station_presence(read: Read) -> DataFrame:
    keys = [TYPE, CATEGORY, STATION]
    return day_runs(read("served_stations").select(*keys, "actual_bucket").distinct(), keys, "actual_bucket")


def on_time_performance(read: Read) -> DataFrame:
    counts = gold.with_category(_merged(read("delay_counts"), TYPE, CATEGORY, "delay_minutes"))
    stations = read("served_stations").select(TYPE, CATEGORY, STATION).distinct()
    return gold.on_time_table(
        [
            aggregate_scopes(counts, *gold.scope_figures()),
            aggregate_scopes(stations, F.countDistinct(STATION).alias("total_stations")),
            read("scope_trains").groupBy(*KEYS).agg(F.sum("total_trains").alias("total_trains")),
        ]
    )


def pair_comparison(read: Read, pair: tuple[str, str] = gold.PAIR) -> DataFrame:
    own = F.col(TYPE).isin(*pair)
    counts = _merged(read("delay_counts").where(own), TYPE, "event_type", "delay_minutes")
    served = read("served_stations").where(own).groupBy(TYPE).agg(F.countDistinct(STATION).alias("stations_served"))
    days = read("scheduled_days").where(own).groupBy(TYPE)
    trains = read("scope_trains").where(F.col("scope_rank") == BY_TYPE).groupBy(F.col("scope_value").alias(TYPE))
    figures = gold.fold(
        [
            gold.with_category(counts).groupBy(TYPE).agg(*gold.pair_figures()),
            served,
            days.agg(F.countDistinct("scheduled_day").alias("operating_days")),
            trains.agg(F.sum("total_trains").alias("total_trains")).where(own),
        ],
        [TYPE],
    )
    return gold.pair_table(figures, pair)


def station_performance(read: Read, stations: DataFrame) -> DataFrame:
    per_station = read("station_counts").groupBy(STATION)
    return gold.station_figures(per_station.agg(*merged_measures(), *merged_measures("total_trains")), stations)


#: gold table -> function of the states
MERGED: dict[str, Callable[[Read], DataFrame]] = {
    "daily_performance": daily_performance,
    "hourly_delay_categories": hourly_delay_categories,
    "delay_histogram": delay_histogram,
    "station_presence": station_presence,
    "on_time_performance": on_time_performance,
    "pair_comparison": pair_comparison,
}
#: gold tables whose rows belong to a departure day: they are their own states
BY_DAY: dict[str, Callable[[DataFrame], DataFrame]] = {
    "train_spans": gold.train_spans,
    "pair_station_daily": gold.pair_station_daily,
    "pair_hourly_daily": gold.pair_hourly_daily,
    "timetable_coverage": gold.timetable_coverage,
}
