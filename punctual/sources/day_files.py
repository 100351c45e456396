"""Raw input files: one JSON array of trains per day, and one of stations.

Layout: <root>/train_departure_date/YYYY/MM/YYYY-MM-DD.json[.gz] and
<root>/stations/stations.json. Plain and gzipped files may be mixed. An array file is
one task, so the number of files gives the parallelism.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual import schemas
from punctual.plans.bronze import SOURCE_PATH, STATION_SOURCE
from punctual.sources import files

# How a finished day file is named.
DAY_PATTERN = r"(\d{4}-\d{2}-\d{2})\.json(\.gz)?$"
DAY_FOLDER = "train_departure_date"
DAY_FILES = f"{DAY_FOLDER}/*/*/*.json*"


class NoInputError(Exception):
    """A full load found no day file."""


def day_of(name: Column) -> Column:
    """The day in a file name, NULL for other names and impossible dates."""
    return F.regexp_extract(name, DAY_PATTERN, 1).try_cast("date")


def read_stations(spark: SparkSession, root: str) -> DataFrame:
    return (
        spark.read.schema(schemas.STATION)
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .json(f"{root}/{STATION_SOURCE}")
    )


def read_trains(spark: SparkSession, root: str, since: dt.date | None = None) -> DataFrame:
    """Trains of all finished day files, or of those from `since` on.

    Both filters use the file name only, so Spark drops the other files when it lists
    them: they are never opened, and an old unreadable file cannot fail a load.
    Malformed input raises. With `since`, no matching file gives an empty result;
    without it, that raises, also where only unfinished files are.
    """
    pattern = f"{root}/{DAY_FILES}"
    found = files.list_files(spark, pattern)
    if since is None and found.where(F.col("name").rlike(DAY_PATTERN)).isEmpty():
        raise NoInputError(f"no finished day files below {root}")
    if not files.exists(spark, pattern):
        return spark.createDataFrame([], schemas.TRAIN).withColumn(SOURCE_PATH, F.lit(None).cast("string"))
    raw = spark.read.schema(schemas.TRAIN).option("multiLine", True).option("mode", "FAILFAST").json(pattern)
    name = F.col("_metadata.file_name")
    finished = raw.where(name.rlike(DAY_PATTERN))
    if since is not None:
        finished = finished.where(day_of(name) >= F.lit(since))
    return finished.select("*", F.col("_metadata.file_path").alias(SOURCE_PATH))


def at_station(trains: DataFrame, code: str) -> DataFrame:
    """Trains that have a timetable row at the station."""
    return trains.where(F.exists("timeTableRows", lambda row: row["stationShortCode"] == code))


def passenger_station_names(stations: DataFrame) -> DataFrame:
    """Code and name of the stations with passenger traffic."""
    return stations.where("passengerTraffic").select("stationShortCode", "stationName")


def missing_days(spark: SparkSession, start: dt.date, end: dt.date, landed: DataFrame) -> DataFrame:
    """Days from `start` to `end` that `landed` (column departureDate) does not hold."""
    days = F.explode(F.sequence(F.lit(start), F.lit(end))).alias("departureDate")
    requested = spark.range(1).select(days)
    return requested.join(landed.select("departureDate").distinct(), "departureDate", "left_anti").orderBy(
        "departureDate"
    )
