"""Station reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.plans.marts import Marts

TOP = 10
TABLE = [
    "station_name", "station_code", "region", "total_events",
    "total_trains", "on_time_percentage", "avg_delay_minutes",
]


def station_map(marts: Marts) -> DataFrame:
    return marts["station_performance"].orderBy(F.desc("total_events"), "station_code")


def most_delayed(marts: Marts, top: int = TOP) -> DataFrame:
    stations = marts["station_performance"].select(*TABLE)
    return stations.orderBy(F.desc_nulls_last("avg_delay_minutes"), "station_code").limit(top)


def busiest(marts: Marts, top: int = TOP) -> DataFrame:
    stations = marts["station_performance"].select(*TABLE)
    return stations.orderBy(F.desc("total_events"), "station_code").limit(top)
