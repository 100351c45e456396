"""Ad-hoc reports on the fact and the station dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.functions import average_delay, event_measures, merged_measures, on_time_percentage
from punctual.plans.gold import commercial
from punctual.plans.marts import FACT, STATIONS, Marts


def _completed(marts: Marts) -> DataFrame:
    return marts[FACT].where("actual_time IS NOT NULL")


def otp_by_hour(marts: Marts) -> DataFrame:
    by_hour = commercial(marts[FACT]).groupBy("scheduled_hour").agg(*event_measures())
    return by_hour.select("scheduled_hour", on_time_percentage().alias("otp")).orderBy("scheduled_hour")


def rush_delay(marts: Marts) -> DataFrame:
    return (
        _completed(marts)
        .groupBy("time_of_day_category")
        .agg(F.avg("delay_minutes").alias("avg_delay"), F.count(F.lit(1)).alias("events"))
    )


def weekend_delay(marts: Marts) -> DataFrame:
    groups = _completed(marts).groupBy("is_weekend", "trainType").agg(*event_measures())
    return groups.select("is_weekend", "trainType", average_delay().alias("avg_delay"))


def region_delay(marts: Marts) -> DataFrame:
    """Distinct train numbers and mean delay per region.

    Events shrink to one row per station and train number before they meet the
    dimension, so a hot station does not travel row by row.
    """
    per_train = _completed(marts).groupBy("stationShortCode", "trainNumber").agg(*event_measures())
    stations = marts[STATIONS].select("stationShortCode", "region")
    regions = (
        per_train.join(stations, "stationShortCode")
        .groupBy("region")
        .agg(
            F.countDistinct("trainNumber").alias("trains"),
            *merged_measures("delay_sum", "delay_count"),
        )
    )
    return regions.select("region", "trains", average_delay().alias("avg_delay")).orderBy(
        F.desc_nulls_last("avg_delay"), "region"
    )


def station_labels(marts: Marts) -> DataFrame:
    labels = ["station_type_label", "passenger_service_label"]
    return marts[STATIONS].groupBy(*labels).agg(F.count(F.lit(1)).alias("station_count"))


def passenger_stations(marts: Marts) -> DataFrame:
    columns = ["stationName", "latitude", "longitude", "region", "passenger_service_label"]
    return marts[STATIONS].where("passengerTraffic").select(*columns).orderBy("region", "stationName")


def station_star(marts: Marts) -> DataFrame:
    """Events and mean delay per station, region and train type over the whole fact,
    reduced per station and type before the join."""
    per_station = marts[FACT].groupBy("stationShortCode", "trainType").agg(*event_measures())
    stations = marts[STATIONS].select("stationShortCode", "stationName", "region")
    groups = (
        per_station.join(stations, "stationShortCode")
        .groupBy("stationName", "region", "trainType")
        .agg(*merged_measures("events", "delay_sum", "delay_count"))
    )
    mean = F.expr("try_divide(cast(delay_sum AS double), delay_count) AS avg_delay")
    return groups.select("stationName", "region", "trainType", "events", mean)
