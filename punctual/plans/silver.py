"""The event fact and the station dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.functions import (
    day_of_week,
    delay_category,
    is_on_time,
    is_weekend,
    parse_event_time,
    surrogate_key,
    time_of_day_category,
)

# Type labels and the simplified regions by station code.
STATION_TYPE_LABELS = {
    "STATION": "Major Station",
    "STOPPING_POINT": "Stopping Point",
    "TURNOUT_IN_THE_OPEN_LINE": "Turnout",
}
REGIONS = {
    "Helsinki Region": ["HKI", "PSL", "LPV", "MLO", "KÄP", "OLK", "PLA", "AVP", "HPK", "TKL", "KEH"],
    "Tampere Region": ["TPE", "LPR", "VKS", "TRE"],
    "Turku Region": ["TKU", "KRS", "LIA", "SAV"],
    "Northern Finland": ["OUL", "KEM", "ROI"],
    "Central Finland": ["JY", "JPH", "JYS"],
}
OTHER_REGION = "Other Region"


def timetable_unnested(trains: DataFrame) -> DataFrame:
    """One row per timetable event of trains that ran; event times still text."""
    lineage = [c for c in ("_loaded_at", "_source_file") if c in trains.columns]
    events = trains.where(~F.col("cancelled")).select(
        "trainNumber",
        "departureDate",
        "operatorShortCode",
        "trainType",
        "trainCategory",
        F.explode("timeTableRows").alias("event"),
        *lineage,
    )
    return events.where("event.scheduledTime IS NOT NULL").select(
        "trainNumber",
        "departureDate",
        "operatorShortCode",
        "trainType",
        "trainCategory",
        "event.stationShortCode",
        "event.stationUICCode",
        F.col("event.type").alias("event_type"),
        F.col("event.trainStopping").alias("train_stopping"),
        F.col("event.commercialStop").alias("commercial_stop"),
        "event.scheduledTime",
        "event.actualTime",
        F.col("event.differenceInMinutes").alias("delay_minutes"),
        *lineage,
    )


def with_event_attributes(events: DataFrame) -> DataFrame:
    """Add everything that follows from scheduled_time and delay_minutes."""
    return events.withColumns(
        {
            "scheduled_hour": F.hour("scheduled_time"),
            "day_of_week": day_of_week("scheduled_time"),
            "scheduled_month": F.month("scheduled_time"),
            "scheduled_year": F.year("scheduled_time"),
            "is_on_time": is_on_time("delay_minutes"),
            "delay_category": delay_category("delay_minutes"),
            "time_of_day_category": time_of_day_category("hour(scheduled_time)"),
            "is_weekend": is_weekend("(dayofweek(scheduled_time) - 1)"),
        }
    )


def fact_timetable_events(unnested: DataFrame) -> DataFrame:
    """The event fact: key, parsed times, date parts and labels."""
    key = surrogate_key("trainNumber", "departureDate", "stationShortCode", "event_type", "scheduledTime")
    parsed = unnested.select(
        key.alias("sk_event"),
        *[c for c in unnested.columns if c not in ("scheduledTime", "actualTime")],
        parse_event_time("scheduledTime").alias("scheduled_time"),
        parse_event_time("actualTime").alias("actual_time"),
    )
    return with_event_attributes(parsed)


def dim_stations(stations: DataFrame) -> DataFrame:
    """The station dimension with labels and region."""
    code, kind = F.col("stationShortCode"), F.col("type")
    labels = F.create_map(*[F.lit(x) for pair in STATION_TYPE_LABELS.items() for x in pair])
    regions = {c: region for region, codes in REGIONS.items() for c in codes}
    region_of = F.create_map(*[F.lit(x) for pair in regions.items() for x in pair])
    serves = F.when(F.col("passengerTraffic"), "Passenger Service").otherwise("No Passenger Service")
    return stations.withColumns(
        {
            "station_type_label": F.coalesce(F.try_element_at(labels, kind), F.lit("Unknown")),
            "passenger_service_label": serves,
            "region": F.coalesce(F.try_element_at(region_of, code), F.lit(OTHER_REGION)),
            "dim_updated_at": F.current_timestamp(),
        }
    ).drop("_run_id")
