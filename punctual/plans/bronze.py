"""Raw rows with a key and load metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.functions import surrogate_key
from punctual.operators.latest import latest_per_key

SOURCE_PATH = "_path"
# Fixed value: the part of a day file's path that is kept as its source name.
SOURCE_NAME = r"train_departure_date/.*\.json(\.gz)?"
STATION_SOURCE = "stations/stations.json"


def _metadata(source: Column, run_id: str) -> list[Column]:
    return [
        F.current_timestamp().alias("_loaded_at"),
        source.alias("_source_file"),
        F.lit(run_id).alias("_run_id"),
    ]


def stations(raw: DataFrame, run_id: str) -> DataFrame:
    key = surrogate_key("stationShortCode").alias("sk_station")
    return raw.select(key, *raw.columns, *_metadata(F.lit(STATION_SOURCE), run_id))


def train_departures(raw: DataFrame, run_id: str) -> DataFrame:
    """One row per train and day: the highest version, then the last file."""
    latest = latest_per_key(
        raw,
        ["trainNumber", "departureDate"],
        [F.col("version").desc_nulls_last(), F.col(SOURCE_PATH).desc_nulls_last()],
    )
    slashes = F.replace(F.col(SOURCE_PATH), F.lit("\\"), F.lit("/"))
    return latest.select(
        surrogate_key("trainNumber", "departureDate").alias("sk_train_departure"),
        *[c for c in raw.columns if c != SOURCE_PATH],
        *_metadata(F.regexp_extract(slashes, SOURCE_NAME, 0), run_id),
    )
