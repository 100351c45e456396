"""Roll-ups of the event fact.

Each function takes the fact (and the station dimension where needed). All of them
aggregate on the map side first, so a hot type, station or train costs its task one
partial row per group, not its events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.functions import (
    MEASURES,
    actual_bucket,
    average_delay,
    day_name,
    delay_category,
    delay_stddev,
    event_measures,
    merged_measures,
    midnight_day,
    on_time_percentage,
    percentage,
    round2,
)
from punctual.operators.histogram import weighted_percentile
from punctual.operators.runs import day_runs
from punctual.operators.scopes import CATEGORY, KEYS, OVERALL, TYPE, aggregate_scopes, empty_total, fold

# The compared pair of train types, volume gates, category names.
PAIR = ("IC", "HDM")
MIN_STATION_EVENTS = 100
MIN_PAIR_STATION_STOPS = 10
KNOWN_CATEGORIES = ["early", "on_time", "slightly_late", "late", "very_late"]

TRAIN_KEYS = ["trainNumber", "departureDate"]
DAILY_KEYS = ["actual_bucket", "trainType", "trainCategory", "day_of_week", "scheduled_month", "is_weekend"]
HOURLY_KEYS = ["scheduled_hour", "time_of_day_category", "trainType", "trainCategory", "delay_category"]


def commercial(fact: DataFrame) -> DataFrame:
    """Completed commercial stops: the base of every roll-up but the coverage."""
    return fact.where("commercial_stop AND actual_time IS NOT NULL")


def of_pair(fact: DataFrame, pair: tuple[str, str] = PAIR) -> DataFrame:
    return commercial(fact).where(F.col("trainType").isin(*pair))


def with_bucket(events: DataFrame) -> DataFrame:
    return events.withColumn("actual_bucket", actual_bucket("actual_time"))


def daily_performance(fact: DataFrame) -> DataFrame:
    return with_bucket(commercial(fact)).groupBy(*DAILY_KEYS).agg(*event_measures())


def hourly_delay_categories(fact: DataFrame) -> DataFrame:
    return commercial(fact).groupBy(*HOURLY_KEYS).agg(*event_measures())


def delay_histogram(fact: DataFrame) -> DataFrame:
    """Events per type and delay; the NULL delay keeps its own row."""
    return commercial(fact).groupBy("trainType", "delay_minutes").agg(*event_measures())


def train_spans(fact: DataFrame) -> DataFrame:
    """Number of trains per day span, midnight days and time-of-day flags.

    Events are folded to train days first. That step keeps fixed-width buffers only,
    so it runs as a plain hash aggregation; the set of midnight days, which needs an
    object buffer, is built from the few rows per train that remain.
    """
    keys = [*TRAIN_KEYS, "trainType", "trainCategory"]
    events = with_bucket(commercial(fact)).dropna(subset=TRAIN_KEYS)
    flags = {
        "has_morning_rush": "time_of_day_category = 'morning_rush'",
        "has_off_peak": "time_of_day_category = 'off_peak'",
        "has_evening_rush": "time_of_day_category = 'evening_rush'",
        "has_weekday": "NOT is_weekend",
        "has_weekend": "is_weekend",
    }
    train_days = events.groupBy(*keys, "actual_bucket").agg(
        *[F.expr(f"bool_or({flag}) AS {name}") for name, flag in flags.items()]
    )
    trains = train_days.groupBy(*keys).agg(
        F.min("actual_bucket").alias("first_actual_bucket"),
        F.max("actual_bucket").alias("last_actual_bucket"),
        F.concat_ws(",", F.array_sort(F.collect_set(midnight_day("actual_bucket")))).alias("midnight_days"),
        *[F.expr(f"bool_or({name}) AS {name}") for name in flags],
    )
    spans = [c for c in trains.columns if c != "trainNumber"]
    return trains.groupBy(*spans).agg(F.count(F.lit(1)).alias("n_trains"))


def station_presence(fact: DataFrame) -> DataFrame:
    """Runs of consecutive days on which a type and category served a station."""
    keys = ["trainType", "trainCategory", "stationShortCode"]
    days = with_bucket(commercial(fact)).select(*keys, "actual_bucket").distinct()
    return day_runs(days, keys, "actual_bucket")


def pair_station_daily(fact: DataFrame, pair: tuple[str, str] = PAIR) -> DataFrame:
    return of_pair(fact, pair).groupBy("departureDate", "trainType", "stationShortCode").agg(*event_measures())


def pair_hourly_daily(fact: DataFrame, pair: tuple[str, str] = PAIR) -> DataFrame:
    keys = ["departureDate", "trainType", "scheduled_hour", "delay_category"]
    return of_pair(fact, pair).groupBy(*keys).agg(*event_measures())


def timetable_coverage(fact: DataFrame) -> DataFrame:
    """Row count and first/last actual time over all events, commercial or not."""
    return fact.groupBy("departureDate", "trainType", "trainCategory").agg(
        F.count(F.lit(1)).alias("events"),
        F.min("actual_time").alias("min_actual_time"),
        F.max("actual_time").alias("max_actual_time"),
    )


def station_performance(
    fact: DataFrame, stations: DataFrame, min_events: int = MIN_STATION_EVENTS
) -> DataFrame:
    """Volume and punctuality per passenger station; the fact is reduced to one row
    per station before it meets the dimension."""
    trains = F.countDistinct(*TRAIN_KEYS).alias("total_trains")
    per_station = commercial(fact).groupBy("stationShortCode").agg(*event_measures(), trains)
    return station_figures(per_station, stations, min_events)


def station_figures(
    per_station: DataFrame, stations: DataFrame, min_events: int = MIN_STATION_EVENTS
) -> DataFrame:
    """The figures of passenger stations from one row of measures and trains for each."""
    return (
        per_station.where(F.col("events") >= min_events)
        .join(stations.where("passengerTraffic"), "stationShortCode")
        .select(
            F.col("stationShortCode").alias("station_code"),
            F.col("stationName").alias("station_name"),
            "latitude",
            "longitude",
            "region",
            F.col("events").alias("total_events"),
            "total_trains",
            on_time_percentage().alias("on_time_percentage"),
            average_delay().alias("avg_delay_minutes"),
        )
        .orderBy(F.desc("total_events"), "station_code")
    )


def _total(measure: str, condition: str, name: str) -> Column:
    return F.expr(f"coalesce(sum(if({condition}, {measure}, NULL)), 0) AS {name}")


def _category_events() -> list[Column]:
    return [_total("events", f"delay_category = '{c}'", f"n_{c}") for c in KNOWN_CATEGORIES]


def _category_shares() -> list[Column]:
    return [percentage(f"n_{c}", "events").alias(f"{c}_pct") for c in KNOWN_CATEGORIES]


def with_category(counts: DataFrame) -> DataFrame:
    return counts.withColumn("delay_category", delay_category("delay_minutes"))


def _side_by_side(events: DataFrame, shared: list[str], counted: list[str], *others: list[str]) -> DataFrame:
    """Value counts and distinct keys from one pass over the events.

    Each event takes part in every grouping (`shared` plus `counted`, `shared` plus one of
    `others`) and is folded on the map side. Rows of the first grouping hold the measures;
    in the others they are NULL, and so are key columns outside a row's own grouping. What
    is left follows the spread of delays and the number of keys, not of events.
    """
    groupings = [shared + own for own in (counted, *others)]
    columns = list(dict.fromkeys(c for own in groupings for c in own))
    sets = [[F.col(c) for c in own] for own in groupings]
    # bits of the columns that the first grouping leaves out
    first = sum(1 << at for at, c in enumerate(reversed(columns)) if c not in groupings[0])
    grouped = events.groupingSets(sets, *[F.col(c) for c in columns])
    rows = grouped.agg(F.grouping_id().alias("_grouping"), *event_measures())
    own = {m: F.when(F.col("_grouping") == first, F.col(m)) for m in MEASURES}
    return rows.withColumns(own)


def _with_numbers(rows: DataFrame, keys: list[str], counted: list[str], **items: list[str]) -> DataFrame:
    """Value counts per `keys` and `counted` from rows that hold each item once; `items` are
    numbers of rows whose columns of that item are all known. They stand beside the counts of
    no value, to be added up."""
    known = {n: " AND ".join(f"{c} IS NOT NULL" for c in columns) for n, columns in items.items()}
    numbers = [F.expr(f"count_if({condition}) AS {name}") for name, condition in known.items()]
    counts = rows.groupBy(*keys, "_grouping", *counted).agg(*merged_measures(), *numbers)
    return with_category(counts.drop("_grouping"))


def _delay_figures() -> list[Column]:
    return [
        *merged_measures(),
        F.max("delay_minutes").alias("max_delay_minutes"),
        F.min("delay_minutes").alias("min_delay_minutes"),
        *_category_events(),
    ]


def scope_figures() -> list[Column]:
    return [*_delay_figures(), weighted_percentile("delay_minutes", "delay_count", 0.5).alias("median")]


def on_time_performance(fact: DataFrame) -> DataFrame:
    """Metrics for all events, per train type and per train category, from one pass over the
    events; only what that pass has folded is expanded over the scopes."""
    items = ["stationShortCode", *TRAIN_KEYS]
    rows = _side_by_side(commercial(fact), [TYPE, CATEGORY], ["delay_minutes"], items[:1], TRAIN_KEYS)
    # an item that occurs with several types counts once in each wider scope
    rows = aggregate_scopes(rows, *merged_measures(), within=["_grouping", "delay_minutes", *items])
    numbers = {"total_stations": items[:1], "total_trains": TRAIN_KEYS}
    counts = _with_numbers(rows, KEYS, ["delay_minutes"], **numbers)
    return on_time_table([counts.groupBy(*KEYS).agg(*scope_figures(), *merged_measures(*numbers))])


def on_time_table(pieces: list[DataFrame]) -> DataFrame:
    """The table from figures per scope, which may come in several pieces."""
    scope_name = F.when(F.col("scope_rank") == OVERALL, "Overall").otherwise(F.col("scope_value"))
    counts = {c: f"{c}_count" for c in KNOWN_CATEGORIES} | {"on_time": "on_time_count_strict"}
    no_rows = empty_total(pieces[0].sparkSession, "events", "total_stations")
    result = fold([*pieces, no_rows], KEYS).select(
        "scope_rank",
        scope_name.alias("metric_scope"),
        F.col("events").alias("total_events"),
        F.coalesce("total_trains", F.lit(0)).alias("total_trains"),
        "total_stations",
        F.col("on_time_events").alias("on_time_count"),
        on_time_percentage().alias("on_time_percentage"),
        average_delay().alias("avg_delay_minutes"),
        round2("median").alias("median_delay_minutes"),
        "max_delay_minutes",
        "min_delay_minutes",
        *[F.col(f"n_{c}").alias(name) for c, name in counts.items()],
        *_category_shares(),
    )
    main_categories = F.col("metric_scope").isin("Long-distance", "Commuter")
    position = F.when(F.col("metric_scope") == "Overall", 1).when(main_categories, 2).otherwise(3)
    return result.orderBy(position, F.col("metric_scope").asc_nulls_last(), "scope_rank").drop("scope_rank")


def pair_figures() -> list[Column]:
    arrivals, departures = "event_type = 'ARRIVAL'", "event_type = 'DEPARTURE'"
    percentiles = [("median", 0.5), ("p25", 0.25), ("p75", 0.75), ("p90", 0.9), ("p95", 0.95)]
    return [
        *_delay_figures(),
        *[weighted_percentile("delay_minutes", "delay_count", at).alias(name) for name, at in percentiles],
        _total("events", arrivals, "arrival_count"),
        _total("events", departures, "departure_count"),
        _total("on_time_events", arrivals, "arrival_on_time"),
        _total("on_time_events", departures, "departure_on_time"),
    ]


def pair_comparison(fact: DataFrame, pair: tuple[str, str] = PAIR) -> DataFrame:
    """Volume, punctuality and delay distribution of two train types side by side, from one
    pass over their events."""
    events = of_pair(fact, pair).withColumn("scheduled_day", F.col("scheduled_time").cast("date"))
    counted = ["event_type", "delay_minutes"]
    numbers = {"stations_served": ["stationShortCode"], "operating_days": ["scheduled_day"], "total_trains": TRAIN_KEYS}
    rows = _side_by_side(events, [TYPE], counted, *numbers.values())
    counts = _with_numbers(rows, [TYPE], counted, **numbers)
    figures = counts.groupBy(TYPE).agg(*pair_figures(), *merged_measures(*numbers))
    return pair_table(figures, pair)


def pair_table(figures: DataFrame, pair: tuple[str, str] = PAIR) -> DataFrame:
    """The comparison from one row of figures per type."""
    result = figures.select(
        F.col("trainType").alias("train_type"),
        F.col("events").alias("total_stops"),
        "total_trains",
        "stations_served",
        "operating_days",
        F.col("on_time_events").alias("on_time_stops"),
        on_time_percentage().alias("on_time_percentage"),
        average_delay().alias("avg_delay_minutes"),
        round2("median").alias("median_delay_minutes"),
        delay_stddev().alias("stddev_delay_minutes"),
        "min_delay_minutes",
        "max_delay_minutes",
        *[round2(p).alias(f"{p}_delay") for p in ("p25", "p75", "p90", "p95")],
        *_category_shares(),
        "arrival_count",
        "departure_count",
        percentage("arrival_on_time", "arrival_count").alias("arrival_otp"),
        percentage("departure_on_time", "departure_count").alias("departure_otp"),
    )
    return _with_verdict(result, pair).orderBy(F.desc("on_time_percentage"), "train_type")


def _with_verdict(result: DataFrame, pair: tuple[str, str]) -> DataFrame:
    """Winner only with a strictly better share; a tie or an absent rival is 'Behind'.
    The window covers the two rows of the pair."""
    both = Window.partitionBy(F.lit(1))
    otp = F.col("on_time_percentage")
    first, second = pair

    def verdict(own: str, rival: str) -> Column:
        rival_otp = F.max(F.when(F.col("train_type") == rival, otp)).over(both)
        won = F.when(otp > rival_otp, "Winner: Better OTP").otherwise(f"Behind {rival}")
        return F.when(F.col("train_type") == own, won)

    return result.withColumn("performance_verdict", F.coalesce(verdict(first, second), verdict(second, first)))


def _pair_breakdown(fact: DataFrame, pair: tuple[str, str], key: str) -> DataFrame:
    return of_pair(fact, pair).groupBy("trainType", key).agg(*event_measures())


def _breakdown_columns() -> list[Column]:
    return [
        F.col("events").alias("stops"),
        on_time_percentage().alias("otp_pct"),
        average_delay().alias("avg_delay"),
    ]


def pair_by_hour(fact: DataFrame, pair: tuple[str, str] = PAIR) -> DataFrame:
    return _pair_breakdown(fact, pair, "scheduled_hour").select(
        "trainType", "scheduled_hour", *_breakdown_columns()
    )


def pair_by_weekday(fact: DataFrame, pair: tuple[str, str] = PAIR) -> DataFrame:
    name = day_name("day_of_week").alias("day_name")
    return _pair_breakdown(fact, pair, "day_of_week").select(
        "trainType", "day_of_week", name, *_breakdown_columns()
    )


def pair_by_station(
    fact: DataFrame, pair: tuple[str, str] = PAIR, min_stops: int = MIN_PAIR_STATION_STOPS
) -> DataFrame:
    stations = _pair_breakdown(fact, pair, "stationShortCode").where(F.col("events") >= min_stops)
    return stations.select("trainType", "stationShortCode", *_breakdown_columns())
