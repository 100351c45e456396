"""Queries over lake files and over lake files joined with the tables.

Each takes DataFrames read with `sources.lake`. Fact rows are always reduced to the join
keys' grain before a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.functions import (
    average_delay,
    event_measures,
    merged_measures,
    on_time_percentage,
    percentage,
    round2,
)
from punctual.plans.gold import commercial

# Limits of the weather classes and the volume of a top list.
COLD_BELOW = 0.0
HEAVY_SNOW_CM, HEAVY_RAIN_MM, STRONG_WIND_KMH = 5, 5.0, 25.0
TOP = 10


def cold_days(weather: DataFrame, below: float = COLD_BELOW) -> DataFrame:
    return weather.where(F.col("temperature_c") < below).orderBy("temperature_c", "date", "city")


def archive_summary(archive: DataFrame) -> DataFrame:
    return (
        archive.groupBy("station_code")
        .agg(
            round2("avg(temp_avg_c)").alias("avg_temp"),
            round2("avg(precipitation_mm)").alias("avg_precip"),
            F.count(F.lit(1)).alias("days"),
        )
        .orderBy(F.desc("avg_temp"), "station_code")
    )


def weather_incidents(incidents: DataFrame, top: int = TOP) -> DataFrame:
    """Weather-related incidents with the largest total delay, from nested fields."""
    return (
        incidents.where("weather_related")
        .select(
            "incident_id",
            "date",
            "subcategory",
            "delay_minutes",
            "impact.affected_trains",
            "impact.total_delay_minutes",
        )
        .orderBy(F.desc("total_delay_minutes"), "incident_id")
        .limit(top)
    )


def same_day_rows(weather: DataFrame, archive: DataFrame, station_code: str) -> DataFrame:
    """Current readings next to the archive's of one station on the same date. The
    weather date may still be text."""
    one_station = archive.where(F.col("station_code") == station_code)
    readings = weather.select(F.col("date").cast("date").alias("date"), "city", "temperature_c")
    normal = one_station.select("date", "station_code", "temp_avg_c")
    return readings.join(normal, "date").select("date", "city", "station_code", "temperature_c", "temp_avg_c")


def temperature_anomaly(weather: DataFrame, archive: DataFrame, station_code: str) -> DataFrame:
    """Current temperature against the archive's mean of the same day of the year, since
    the two cover different years."""
    day_of_year = F.dayofyear("date").alias("day_of_year")
    normal = (
        archive.where(F.col("station_code") == station_code)
        .groupBy(day_of_year)
        .agg(F.avg("temp_avg_c").alias("normal_c"))
    )
    current = weather.select("date", "city", "temperature_c", day_of_year)
    anomaly = round2("temperature_c - normal_c").alias("anomaly_c")
    return current.join(normal, "day_of_year").select(
        "date", "city", "temperature_c", round2("normal_c").alias("normal_c"), anomaly
    )


def incident_share_of_journey(incidents: DataFrame, routes: DataFrame) -> DataFrame:
    """Delay as a share of the typical journey, for routes that start at the station."""
    journeys = routes.select("route_name", F.col("origin").alias("station"), "typical_duration_min")
    share = percentage("delay_minutes", "typical_duration_min").alias("delay_share")
    return incidents.join(journeys, "station").select(
        "incident_id", "station", "route_name", "delay_minutes", "typical_duration_min", share
    )


def _per_day(fact: DataFrame) -> DataFrame:
    return commercial(fact).groupBy(F.col("departureDate").alias("date")).agg(*event_measures())


def _per_weather_day(weather: DataFrame) -> DataFrame:
    """One row per date over all cities; dates are aligned before the join."""
    date = F.col("date").cast("date").alias("date")
    return weather.groupBy(date).agg(
        F.avg("temperature_c").alias("temperature_c"),
        F.max("precipitation_mm").alias("precipitation_mm"),
        F.max("snow_depth_cm").alias("snow_depth_cm"),
        F.max("wind_speed_kmh").alias("wind_speed_kmh"),
    )


def weather_vs_punctuality(weather: DataFrame, fact: DataFrame) -> DataFrame:
    return (
        _per_weather_day(weather)
        .join(_per_day(fact), "date")
        .select(
            "date",
            round2("temperature_c").alias("temperature_c"),
            "precipitation_mm",
            "events",
            on_time_percentage().alias("otp_percentage"),
            average_delay().alias("avg_delay"),
        )
        .orderBy("date")
    )


def weather_class(temperature: Column, rain: Column, snow: Column, wind: Column) -> Column:
    return (
        F.when(snow > HEAVY_SNOW_CM, "snow")
        .when(rain > HEAVY_RAIN_MM, "rain")
        .when(wind > STRONG_WIND_KMH, "wind")
        .when(temperature < COLD_BELOW, "cold")
        .otherwise("normal")
    )


def weather_impact(weather: DataFrame, fact: DataFrame) -> DataFrame:
    """Punctuality per weather class."""
    columns = ("temperature_c", "precipitation_mm", "snow_depth_cm", "wind_speed_kmh")
    class_ = weather_class(*[F.col(c) for c in columns]).alias("weather_class")
    days = _per_weather_day(weather).select("date", class_).join(_per_day(fact), "date")
    groups = days.groupBy("weather_class").agg(
        F.count(F.lit(1)).alias("days"),
        *merged_measures("events", "on_time_events", "delay_sum", "delay_count"),
    )
    return groups.select(
        "weather_class",
        "days",
        "events",
        on_time_percentage().alias("otp_percentage"),
        average_delay().alias("avg_delay"),
    ).orderBy("weather_class")


def stations_with_attributes(station_performance: DataFrame, attributes: DataFrame) -> DataFrame:
    """Station figures with population and platforms; stations without stay."""
    extra = attributes.select("station_code", "population_nearby", "platforms")
    per_thousand = round2("try_divide(total_events * 1000.0D, population_nearby)").alias("events_per_thousand")
    return station_performance.join(extra, "station_code", "left").select(
        *station_performance.columns, "population_nearby", "platforms", per_thousand
    )


def incidents_with_events(incidents: DataFrame, fact: DataFrame) -> DataFrame:
    """Incidents next to what the fact recorded for that train, station and day."""
    keys = ["trainNumber", "stationShortCode", "departureDate"]
    events = fact.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("events"), F.max("delay_minutes").alias("max_recorded_delay")
    )
    named = incidents.select(
        "incident_id",
        F.col("train_number").alias("trainNumber"),
        F.col("station").alias("stationShortCode"),
        F.col("date").alias("departureDate"),
        "category",
        F.col("delay_minutes").alias("reported_delay"),
    )
    return named.join(events, keys).select(
        "incident_id", *keys, "category", "reported_delay", "events", "max_recorded_delay"
    )


def monthly_weather(weather: DataFrame) -> DataFrame:
    date = F.col("date").cast("date")
    return (
        weather.groupBy("city", F.year(date).alias("year"), F.month(date).alias("month"))
        .agg(
            F.count(F.lit(1)).alias("days"),
            round2("avg(temperature_c)").alias("avg_temp"),
            F.min("temperature_c").alias("min_temp"),
            F.max("temperature_c").alias("max_temp"),
        )
        .orderBy("city", "year", "month")
    )


def raw_train_statistics(trains: DataFrame) -> DataFrame:
    """Figures per train type straight from raw day files."""
    return (
        trains.groupBy("trainType")
        .agg(
            F.count(F.lit(1)).alias("trains"),
            F.count_if("cancelled").alias("cancelled"),
            F.sum(F.coalesce(F.size("timeTableRows"), F.lit(0))).alias("timetable_rows"),
        )
        .orderBy(F.asc_nulls_last("trainType"))
    )


def lake_checks(weather: DataFrame, archive: DataFrame, incidents: DataFrame) -> DataFrame:
    """Row counts and number of cities as one row per check."""
    rows = [
        weather.agg(F.lit("weather_rows").alias("check"), F.count(F.lit(1)).alias("value")),
        weather.agg(F.lit("weather_cities").alias("check"), F.countDistinct("city").alias("value")),
        archive.agg(F.lit("archive_rows").alias("check"), F.count(F.lit(1)).alias("value")),
        incidents.agg(F.lit("incident_rows").alias("check"), F.count(F.lit(1)).alias("value")),
    ]
    first, *rest = rows
    for row in rest:
        first = first.unionByName(row)
    return first
