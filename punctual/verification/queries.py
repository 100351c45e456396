"""The registered queries: name -> (spark, folder of the driver's tables) -> DataFrame.

Queries that exercise writing put their tables into a new scratch folder.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.functions import surrogate_key
from punctual.operators.latest import latest_per_key
from punctual.operators.quality import ReferenceTest, TableTests, run_tests
from punctual.plans import bronze, daily_tests, gold, lake_queries, silver
from punctual.plans.build import (
    BRONZE,
    DAY_SOURCES,
    GOLD,
    SILVER,
    TRAINS,
    build_gold,
    load_bronze_trains,
    stored_marts,
)
from punctual.plans.marts import FACT, STATIONS, Marts
from punctual.plans.quality_suite import SUITE
from punctual.plans.reports import calendar, overview, pair, star, stations, train_types
from punctual.schemas import INCIDENT, STATION_ATTRIBUTES, WEATHER, WEATHER_ARCHIVE
from punctual.session import scratch_dir
from punctual.sources import day_files, files, lake, landing
from punctual.sources import sample_tables as sample
from punctual.sources.manifest import Manifest
from punctual.sources.tables import Warehouse
from punctual.streaming.reload import load_landed_days, load_new_days

Query = Callable[[SparkSession, str], DataFrame]

# Parameters that the SQL repeats.
RANGE = ("2024-01-05", "2024-01-20")
SINGLE_DAY = "2024-01-12"
RELOAD_FROM = dt.date(2024, 1, 22)
RETENTION_CUTOFF = dt.date(2024, 1, 11)
SHIP_RANGE = ("1996-03-01", "1997-09-30")


def comparable(df: DataFrame) -> DataFrame:
    """Result types that every engine has alike: whole numbers as bigint, decimals as
    double, dates as ISO text."""
    plain = {"tinyint": "bigint", "smallint": "bigint", "int": "bigint", "date": "string"}
    casts = []
    for name, kind in df.dtypes:
        target = "double" if kind.startswith("decimal") else plain.get(kind)
        casts.append(f"cast(`{name}` AS {target}) AS `{name}`" if target else f"`{name}`")
    return df.selectExpr(*casts)


def _on_events(report: Callable[..., DataFrame], *args, **kwargs) -> Query:
    """A report over the roll-ups of shape E."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        return report(Marts.from_fact(sample.event_fact(spark, folder)), *args, **kwargs)

    return query


def _on_events_with_stations(report: Callable[..., DataFrame], *args, **kwargs) -> Query:
    """Shape E with the suppliers as stations: both number their stations from 0."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        fact, dimension = sample.event_fact(spark, folder), sample.supplier_stations(spark, folder)
        return report(Marts.from_fact(fact, dimension), *args, **kwargs)

    return query


def _on_lineitem(
    report: Callable[..., DataFrame],
    *args,
    train_type: bool = False,
    category: bool = False,
    **kwargs,
) -> Query:
    """A report over shape L; only the joins it needs are made."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        fact = sample.lineitem_fact(spark, folder, train_type, category)
        return report(Marts.from_fact(fact, sample.supplier_stations(spark, folder)), *args, **kwargs)

    return query


def _rollup(name: str) -> Callable[[Marts], DataFrame]:
    return lambda marts: marts[name]


STORED: dict[tuple[str, str], str] = {}


def stored_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The gold tables of shape E, built once in a session and then by reload: the first build
    has half of the events of the newest days, and those days come again whole."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in STORED:
        warehouse = Warehouse(spark, scratch_dir(spark, "stored"))
        fact = sample.event_fact(spark, folder)
        newest = F.col("departureDate") >= F.lit(RELOAD_FROM)
        warehouse.overwrite(sample.supplier_stations(spark, folder), SILVER, STATIONS)
        warehouse.overwrite_days(fact.where(~newest | (F.col("trainNumber") % 2 == 0)), SILVER, FACT)
        build_gold(warehouse)
        warehouse.replace_days(fact.where(newest), SILVER, FACT, RELOAD_FROM)
        build_gold(warehouse, RELOAD_FROM)
        STORED[key] = warehouse.root
    return Warehouse(spark, STORED[key])


def _on_stored(report: Callable[..., DataFrame], *args, **kwargs) -> Query:
    """A report over stored gold tables, which reads no event."""
    return lambda spark, folder: report(stored_marts(stored_warehouse(spark, folder)), *args, **kwargs)


def gold_reload(spark: SparkSession, folder: str) -> DataFrame:
    """One day loaded again: its states are replaced and the gold tables merged anew. Shows
    what the day's tables hold."""
    warehouse = stored_warehouse(spark, folder)
    build_gold(warehouse, max(warehouse.days(SILVER, FACT)))
    covered = warehouse.read(GOLD, "timetable_coverage")
    return covered.groupBy("departureDate").agg(F.sum("events").alias("events"))


def _fact_function(function: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: function(sample.event_fact(spark, folder))


# event fact


def fact_events(spark: SparkSession, folder: str) -> DataFrame:
    """The fact with its derived attributes."""
    derived = ["scheduled_hour", "day_of_week", "scheduled_month", "scheduled_year", "is_on_time"]
    derived += ["delay_category", "time_of_day_category", "is_weekend"]
    return silver.with_event_attributes(sample.event_rows(spark, folder)).select(
        "event_id", "trainNumber", "departureDate", "actual_time", "delay_minutes", *derived
    )


def surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    rows = sample.event_rows(spark, folder)
    parts = ["trainNumber", "departureDate", "stationShortCode", "trainType", "event_type"]
    one = surrogate_key("stationShortCode").alias("sk_station")
    return rows.select("event_id", one, surrogate_key(*parts).alias("sk_event"))


def json_field_filter(spark: SparkSession, folder: str) -> DataFrame:
    """A nested JSON field read with a schema, filtered and counted."""
    parsed = sample.table(spark, folder, "events").select(
        "event_type", F.from_json("props", "k bigint").alias("props")
    )
    return (
        parsed.where("props.k >= 50")
        .groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.max("props.k").alias("max_k"))
    )


def dedup_latest_version(spark: SparkSession, folder: str) -> DataFrame:
    lines = sample.table(spark, folder, "lineitem")
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    newest = [F.col(c).desc_nulls_last() for c in ("l_partkey", "l_suppkey", "l_quantity")]
    return latest_per_key(lines.select(*columns), ["l_orderkey", "l_linenumber"], newest)


# shape N


def _per_type(fact: DataFrame) -> DataFrame:
    return fact.groupBy("trainType", "event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.countDistinct("trainNumber", "departureDate").alias("trains"),
        F.min("scheduled_time").alias("first_scheduled"),
        F.max("actual_time").alias("last_actual"),
        F.sum("delay_minutes").alias("delay_sum"),
    )


def nest_unnest_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Events nested into trains, unnested and parsed again."""
    trains = sample.nested_trains(spark, folder)
    return _per_type(silver.fact_timetable_events(silver.timetable_unnested(trains)))


def trains_at_station(spark: SparkSession, folder: str) -> DataFrame:
    trains = day_files.at_station(sample.nested_trains(spark, folder), "42")
    return trains.groupBy("departureDate").agg(F.count(F.lit(1)).alias("trains"))


def raw_train_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """Figures straight from landed JSON, without a load."""
    landed = scratch_dir(spark, "landed")
    landing.land(sample.nested_trains(spark, folder), landed)
    return lake_queries.raw_train_statistics(landing.read_landed(spark, landed))


def built_from_landing(spark: SparkSession, folder: str) -> DataFrame:
    """Landed JSON to bronze to silver, then the roll-up by scope."""
    root = scratch_dir(spark, "build")
    landing.land(sample.nested_trains(spark, folder), f"{root}/landed")
    warehouse = Warehouse(spark, f"{root}/warehouse")
    load_bronze_trains(warehouse, landing.read_landed(spark, f"{root}/landed"), "run", full=True)
    fact = silver.fact_timetable_events(silver.timetable_unnested(warehouse.read_days(BRONZE, TRAINS)))
    warehouse.overwrite_days(fact, SILVER, FACT)
    return gold.on_time_performance(warehouse.read_days(SILVER, FACT))


def streamed_from_landing(spark: SparkSession, folder: str) -> DataFrame:
    """The same bronze table, filled by a stream that runs until nothing is left."""
    root = scratch_dir(spark, "stream")
    trains = sample.nested_trains(spark, folder)
    warehouse = Warehouse(spark, f"{root}/warehouse")
    landing.land(trains, f"{root}/landed")
    load_landed_days(spark, f"{root}/landed", warehouse, f"{root}/checkpoint", "run")
    landing.land(trains.where(F.col("departureDate") >= F.lit(RELOAD_FROM)), f"{root}/landed")
    load_landed_days(spark, f"{root}/landed", warehouse, f"{root}/checkpoint", "run")
    return _per_day(warehouse.read_days(BRONZE, TRAINS))


# raw day files


def _write_day_files(rows: DataFrame, value: Column, path_of: Callable[[str], str], compress: bool) -> None:
    """One file per day, as the raw layout has them: `value` is an array of the day's rows."""
    spark = rows.sparkSession
    staged = scratch_dir(spark, "day-files")
    arrays = rows.groupBy("day").agg(F.to_json(F.array_sort(F.collect_list(value))).alias("text"))
    arrays.write.partitionBy("day").option("compression", "gzip" if compress else "none").text(staged)
    for found in files.list_files(spark, f"{staged}/*/part-*").collect():
        day = found.path.split("/day=", 1)[1].split("/", 1)[0]
        files.rename(spark, found.path, path_of(day))


def _staging(spark: SparkSession, folder: str) -> str:
    """The trains of shape N as day files, odd days plain and even days gzipped; a file that is
    not finished yet, and one that is no day file."""
    root = scratch_dir(spark, "staging")
    trains = sample.nested_trains(spark, folder).withColumn("day", F.col("departureDate"))
    value = F.struct(*[c for c in trains.columns if c != "day"])
    at = lambda day: f"{root}/{day_files.DAY_FOLDER}/{day[:4]}/{day[5:7]}/{day}.json"
    odd = F.day("day") % 2 == 1
    _write_day_files(trains.where(odd), value, at, compress=False)
    _write_day_files(trains.where(~odd), value, lambda day: f"{at(day)}.gz", compress=True)
    files.write_new(spark, f"{at('2024-01-03')}.part", "[{")
    files.write_new(spark, at("notes"), "[{")
    return root


def day_files_unnested(spark: SparkSession, folder: str) -> DataFrame:
    trains = bronze.train_departures(day_files.read_trains(spark, _staging(spark, folder)), "run")
    return _per_type(silver.fact_timetable_events(silver.timetable_unnested(trains)))


def _per_day(trains: DataFrame) -> DataFrame:
    return trains.groupBy("departureDate").agg(
        F.count(F.lit(1)).alias("trains"), F.sum(F.size("timeTableRows")).alias("timetable_rows")
    )


def day_files_window(spark: SparkSession, folder: str) -> DataFrame:
    """The newest days only, with the file that each train came from."""
    trains = day_files.read_trains(spark, _staging(spark, folder), RELOAD_FROM)
    loaded = bronze.train_departures(trains, "run")
    return loaded.groupBy("departureDate", "_source_file").agg(F.count(F.lit(1)).alias("trains"))


def day_files_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Even days come plain too, with a version more and no train cancelled: that one counts."""
    root = _staging(spark, folder)
    trains = sample.nested_trains(spark, folder).withColumn("day", F.col("departureDate"))
    again = trains.withColumns({"version": F.col("version") + 1, "cancelled": F.lit(False)})
    value = F.struct(*[c for c in trains.columns if c != "day"])
    at = lambda day: f"{root}/{day_files.DAY_FOLDER}/{day[:4]}/{day[5:7]}/{day}.json"
    _write_day_files(again.where(F.day("day") % 2 == 0), value, at, compress=False)
    loaded = bronze.train_departures(day_files.read_trains(spark, root), "run")
    return loaded.groupBy("departureDate", "version").agg(
        F.count(F.lit(1)).alias("trains"), F.count_if("cancelled").alias("cancelled")
    )


def day_files_streamed(spark: SparkSession, folder: str) -> DataFrame:
    root = scratch_dir(spark, "stream")
    warehouse = Warehouse(spark, f"{root}/warehouse")
    load_new_days(spark, _staging(spark, folder), warehouse, f"{root}/checkpoint", "run", max_files=20)
    return _per_day(warehouse.read_days(BRONZE, TRAINS))


def _loaded_stations(spark: SparkSession, folder: str) -> DataFrame:
    """The suppliers as stations, from a raw array file."""
    root = scratch_dir(spark, "stations")
    suppliers = sample.supplier_stations(spark, folder).withColumn("day", F.lit("stations"))
    place = F.col("stationUICCode") % 4
    code = F.when(place == 0, "HKI").when(place == 1, "TPE").otherwise(F.col("stationShortCode"))
    row = F.struct(
        code.alias("stationShortCode"),
        *["stationName", "stationUICCode", "latitude", "longitude", "passengerTraffic", "type"],
        F.lit("FI").alias("countryCode"),
    )
    _write_day_files(suppliers, row, lambda _: f"{root}/{bronze.STATION_SOURCE}", compress=False)
    return bronze.stations(day_files.read_stations(spark, root), "run")


def station_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """Stations from their raw array file to the dimension."""
    dimension = silver.dim_stations(_loaded_stations(spark, folder))
    labels = ["station_type_label", "passenger_service_label", "region"]
    return dimension.groupBy(*labels).agg(
        F.count(F.lit(1)).alias("stations"), F.countDistinct("sk_station").alias("codes"), F.max("latitude").alias("north")
    )


def lake_incident_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """Incidents as JSON arrays, one file per day."""
    root = scratch_dir(spark, "arrays")
    incidents = sample.incidents(spark, folder)
    days = incidents.withColumn("day", F.col("date"))
    _write_day_files(days, F.struct(*incidents.columns), lambda day: f"{root}/{day}.json", compress=False)
    return lake_queries.weather_incidents(lake.read_json_array(spark, root, INCIDENT))


# loading, retention, quarantine


def _day_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("departureDate").agg(
        F.count(F.lit(1)).alias("events"), F.sum("delay_minutes").alias("delay_sum")
    )


def reload_idempotent(spark: SparkSession, folder: str) -> DataFrame:
    """All days, then the window twice more: nothing changes."""
    rows = sample.event_rows(spark, folder)
    warehouse = Warehouse(spark, scratch_dir(spark, "reload"))
    warehouse.overwrite_days(rows, SILVER, "events")
    window = rows.where(F.col("departureDate") >= F.lit(RELOAD_FROM))
    for _ in range(2):
        warehouse.replace_days(window, SILVER, "events")
    return _day_counts(warehouse.read_days(SILVER, "events"))


def retention_delete(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = Warehouse(spark, scratch_dir(spark, "retention"))
    warehouse.overwrite_days(sample.event_rows(spark, folder), SILVER, "events")
    warehouse.drop_days_before(RETENTION_CUTOFF, SILVER, "events")
    return _day_counts(warehouse.read_days(SILVER, "events"))


def schema_append(spark: SparkSession, folder: str) -> DataFrame:
    """Later days bring a new column; earlier days read NULL there."""
    rows = sample.event_rows(spark, folder).drop("scheduled_time", "actual_time")
    warehouse = Warehouse(spark, scratch_dir(spark, "schema"))
    warehouse.overwrite_days(rows, SILVER, "events")
    window = rows.where(F.col("departureDate") >= F.lit(RELOAD_FROM))
    warehouse.replace_days(window.withColumn("delay_band", F.floor(F.col("delay_minutes") / 10)), SILVER, "events")
    return (
        warehouse.read_days(SILVER, "events")
        .groupBy("departureDate")
        .agg(F.count(F.lit(1)).alias("events"), F.count("delay_band").alias("with_band"))
    )


def quarantine_split(spark: SparkSession, folder: str) -> DataFrame:
    """JSON folders per day and kind; the `error` folders of odd days are cut off."""
    path = scratch_dir(spark, "quarantine")
    events = sample.table(spark, folder, "events")
    columns = ["event_id", "user_id", "value", "event_type"]
    text = F.to_json(F.struct(*columns))
    day = F.col("ts").cast("date")
    broken = (F.col("event_type") == "error") & (F.day(day) % 2 == 1)
    lines = events.select(
        day.alias("day"),
        F.col("event_type").alias("kind"),
        F.when(broken, F.substring(text, 1, 20)).otherwise(text).alias("line"),
    )
    spread = lines.hint("rebalance", F.col("day"), F.col("kind"))
    spread.write.partitionBy("day", "kind").text(path)
    schema = "event_id bigint, user_id bigint, value double, event_type string"
    rows = landing.read_permissive(spark, path, schema, multi_line=False)
    good, _ = landing.split_readable(rows, scratch_dir(spark, "parsed"))
    return good.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.sum("event_id").alias("id_sum"), F.max("value").alias("max_value")
    )


def load_record(spark: SparkSession, folder: str) -> DataFrame:
    rows = sample.event_rows(spark, folder)
    summary = landing.load_summary(rows, dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    return summary.drop("load_time")


def coverage_record(spark: SparkSession, folder: str) -> DataFrame:
    return landing.coverage_record(sample.event_rows(spark, folder))


def missing_days(spark: SparkSession, folder: str) -> DataFrame:
    """Requested days without an order, of a range that begins before the first one."""
    landed = sample.table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("departureDate"))
    return day_files.missing_days(spark, dt.date(1991, 12, 1), dt.date(1999, 12, 31), landed)


# data tests


def data_test_report(spark: SparkSession, folder: str) -> DataFrame:
    fact = sample.event_fact(spark, folder)
    parts = ["trainNumber", "departureDate", "stationShortCode", "event_type", "scheduled_time"]
    marts = Marts.from_fact(fact)
    tables = {name: marts[name] for name in ("daily_performance", "delay_histogram", "train_spans")}
    tables[FACT] = fact.withColumn("sk_event", surrogate_key(*parts))
    suite = {name: replace(SUITE[name], references=[]) for name in tables}
    return run_tests(tables, suite)


def more_data_tests(spark: SparkSession, folder: str) -> DataFrame:
    """The declared tests of four more roll-ups, over the stored tables."""
    marts = stored_marts(stored_warehouse(spark, folder))
    names = ("pair_station_daily", "pair_hourly_daily", "timetable_coverage", "hourly_delay_categories")
    return run_tests({n: marts[n] for n in names}, {n: SUITE[n] for n in names})


def unnested_tests(spark: SparkSession, folder: str) -> DataFrame:
    """The declared tests of the timetable rows before they become events."""
    rows = silver.timetable_unnested(sample.nested_trains(spark, folder))
    return run_tests({"timetable_unnested": rows}, {"timetable_unnested": SUITE["timetable_unnested"]})


def other_data_tests(spark: SparkSession, folder: str) -> DataFrame:
    """The declared tests of trains, stations, the station dimension and four stored roll-ups.
    Some of the stations share a code, which the uniqueness tests must find."""
    marts = stored_marts(stored_warehouse(spark, folder))
    names = ("on_time_performance", "pair_comparison", "station_performance", "station_presence")
    loaded = _loaded_stations(spark, folder)
    raw = sample.nested_trains(spark, folder).withColumn(bronze.SOURCE_PATH, F.lit("events"))
    tables = {n: marts[n] for n in names} | {
        "stations": loaded,
        STATIONS: silver.dim_stations(loaded),
        TRAINS: bronze.train_departures(raw, "run"),
    }
    return run_tests(tables, {n: SUITE[n] for n in tables})


def tests_by_day(spark: SparkSession, folder: str) -> DataFrame:
    """The declared tests of the tables by day, from stored results: the first run sees half of
    the events of the newest days, the second one tests those days again and no other."""
    warehouse = Warehouse(spark, scratch_dir(spark, "tests"))
    fact = sample.event_fact(spark, folder)
    parts = ["trainNumber", "departureDate", "stationShortCode", "event_type", "scheduled_time"]
    fact = fact.withColumn("sk_event", surrogate_key(*parts))
    code = F.concat(F.when(F.col("passengerTraffic"), "").otherwise("closed-"), "stationShortCode")
    known = sample.supplier_stations(spark, folder).withColumn("stationShortCode", code)
    warehouse.overwrite(sample.supplier_stations(spark, folder), SILVER, STATIONS)
    newest = F.col("departureDate") >= F.lit(RELOAD_FROM)
    names = [name for name, (layer, _) in DAY_SOURCES.items() if layer != BRONZE]
    suite, sources = {n: SUITE[n] for n in names}, {n: DAY_SOURCES[n] for n in names}
    warehouse.overwrite_days(fact.where(~newest | (F.col("trainNumber") % 2 == 0)), SILVER, FACT)
    for since in (None, RELOAD_FROM):
        if since is not None:
            warehouse.replace_days(fact.where(newest), SILVER, FACT, since)
        build_gold(warehouse, since)
        tables = {n: warehouse.read(*sources[n]) for n in names}
        daily_tests.refresh(warehouse, tables, sources, suite)
    return daily_tests.report(warehouse, tables | {STATIONS: known}, suite)


def reference_test(spark: SparkSession, folder: str) -> DataFrame:
    """Events whose station is not a known one: suppliers without passengers go by a code
    that no event has."""
    code = F.concat(F.when(F.col("passengerTraffic"), "").otherwise("closed-"), "stationShortCode")
    stations = sample.supplier_stations(spark, folder).withColumn("stationShortCode", code)
    tables = {"events": sample.event_rows(spark, folder), "dim_stations": stations}
    suite = {"events": TableTests(references=[ReferenceTest("stationShortCode", "dim_stations")])}
    return run_tests(tables, suite)


# manifest


def _manifest(spark: SparkSession, rows: list[DataFrame], partition: str) -> Manifest:
    """A dataset that grows by one batch per entry of `rows`."""
    root = scratch_dir(spark, "manifest")
    manifest = Manifest(spark, f"{root}/manifest")
    manifest.register_dataset("lines", "Order lines", f"{root}/data")
    for batch in rows:
        batch.hint("rebalance", F.col(partition)).write.mode("append").partitionBy(partition).parquet(f"{root}/data")
        manifest.register_files("lines", stats=["l_shipdate", "l_quantity"], distinct=["l_linenumber"])
    return manifest


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_quantity"]
    shipped = F.col("l_shipdate").cast("date")
    return sample.table(spark, folder, "lineitem").select(
        *columns, shipped.alias("l_shipdate"), F.year(shipped).alias("ship_year")
    )


def file_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics per folder, folded from those per file."""
    manifest = _manifest(spark, [_lines(spark, folder)], "ship_year")
    return (
        manifest.file_stats("lines", "l_shipdate")
        .groupBy("partition_key")
        .agg(
            F.min("min_value").alias("min_value"),
            F.max("max_value").alias("max_value"),
            F.sum("null_count").alias("null_count"),
            F.sum("row_count").alias("row_count"),
        )
    )


def pruned_read(spark: SparkSession, folder: str) -> DataFrame:
    """Files found by their statistics, then only those scanned."""
    manifest = _manifest(spark, [_lines(spark, folder)], "ship_year")
    rows = manifest.read_range("lines", "l_shipdate", *SHIP_RANGE)
    return rows.groupBy("ship_year", "l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity")
    )


def snapshot_read(spark: SparkSession, folder: str) -> DataFrame:
    """The dataset as of each of its two snapshots."""
    lines = _lines(spark, folder)
    half = F.col("l_orderkey") % 2 == 0
    manifest = _manifest(spark, [lines.where(half), lines.where(~half)], "ship_year")
    numbers = [row.number for row in manifest.snapshots("lines").collect()]
    first, second = [
        manifest.read_snapshot("lines", n).agg(
            F.lit(i + 1).alias("snapshot"), F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity")
        )
        for i, n in enumerate(numbers)
    ]
    return first.unionByName(second)


def snapshot_log(spark: SparkSession, folder: str) -> DataFrame:
    """Three batches, then a year that is gone: files and rows of each snapshot."""
    lines, root = _lines(spark, folder), scratch_dir(spark, "log")
    manifest = Manifest(spark, f"{root}/manifest")
    manifest.register_dataset("lines", "Order lines", f"{root}/data")
    for batch in range(3):
        own = lines.where(F.col("l_orderkey") % 3 == batch).repartition("ship_year")  # a file for each year
        own.write.mode("append").partitionBy("ship_year").parquet(f"{root}/data")
        manifest.register_files("lines")
    files.delete(spark, [f"{root}/data/ship_year=1996"])
    manifest.register_files("lines", operation="DELETE")
    return manifest.snapshots("lines").select("number", "operation", "files", "rows")


def rewritten_file_read(spark: SparkSession, folder: str) -> DataFrame:
    """A year's files are written anew in place, ten years later, and not registered: a read
    of the later range finds them."""
    lines, root = _lines(spark, folder), scratch_dir(spark, "rewritten")
    manifest = Manifest(spark, f"{root}/manifest")
    manifest.register_dataset("lines", "Order lines", f"{root}/data")
    lines.repartition("ship_year").write.partitionBy("ship_year").parquet(f"{root}/data")
    manifest.register_files("lines", stats=["l_shipdate"])
    year = f"{root}/data/ship_year=1997"
    later = spark.read.parquet(year).withColumn("l_shipdate", F.add_months("l_shipdate", 120))
    later.coalesce(1).write.parquet(f"{root}/later")
    written = files.list_files(spark, f"{root}/later/part-*").head().path
    files.rename(spark, written, files.list_files(spark, f"{year}/part-*").head().path)
    rows = manifest.read_range("lines", "l_shipdate", "2007-01-01", "2007-12-31")
    return rows.groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("n"), F.max("l_shipdate").alias("last_day"))


def time_zone_read(spark: SparkSession, folder: str) -> DataFrame:
    """Ranges of instants, registered in one session time zone and used in another."""
    root, zone = scratch_dir(spark, "zones"), "spark.sql.session.timeZone"
    events = sample.table(spark, folder, "events")
    instants = events.select("event_id", "event_type", F.col("ts").cast("timestamp").alias("at"))
    days = instants.withColumn("day", F.to_date("at")).repartition("day")
    days.write.partitionBy("day").parquet(f"{root}/data")
    manifest = Manifest(spark, f"{root}/manifest")
    manifest.register_dataset("events", "Events", f"{root}/data")
    before = spark.conf.get(zone)
    try:
        spark.conf.set(zone, "Asia/Tokyo")
        manifest.register_files("events", stats=["at"])
    finally:
        spark.conf.set(zone, before)
    rows = manifest.read_range("events", "at", "2024-01-05 00:00:00", "2024-01-06 00:00:00")
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_id"))


# lake


def _types(schema: str) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in T.StructType.fromDDL(schema)}


def _weather_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Weather as CSV, one folder per city, the second one with other column order."""
    path = scratch_dir(spark, "weather")
    rows = sample.weather(spark, folder)
    lake.write_csv(rows.where("city = 'Helsinki'"), f"{path}/helsinki")
    reordered = rows.where("city = 'Tampere'").select(*reversed(rows.columns))
    lake.write_csv(reordered, f"{path}/tampere")
    return lake.read_csv_by_name(spark, f"{path}/*/*.csv", _types(WEATHER))


def _archive(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "archive")
    lake.write_parquet(sample.weather_archive(spark, folder), path)
    return lake.read_parquet(spark, path)


def _incidents(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "incidents")
    lake.write_json(sample.incidents(spark, folder), path)
    return spark.read.schema(INCIDENT).json(path)


def lake_cold_days(spark: SparkSession, folder: str) -> DataFrame:
    return lake_queries.cold_days(_weather_csv(spark, folder))


def lake_archive_summary(spark: SparkSession, folder: str) -> DataFrame:
    return lake_queries.archive_summary(_archive(spark, folder))


def lake_weather_incidents(spark: SparkSession, folder: str) -> DataFrame:
    return lake_queries.weather_incidents(_incidents(spark, folder))


def lake_join_csv_parquet(spark: SparkSession, folder: str) -> DataFrame:
    rows = lake_queries.same_day_rows(_weather_csv(spark, folder), _archive(spark, folder), "HKI")
    return rows.groupBy("date", "city").agg(
        F.count(F.lit(1)).alias("n"), F.max("temperature_c").alias("temperature_c"), F.max("temp_avg_c").alias("max_archive")
    )


def lake_temperature_anomaly(spark: SparkSession, folder: str) -> DataFrame:
    return lake_queries.temperature_anomaly(_weather_csv(spark, folder), _archive(spark, folder), "HKI")


def lake_incident_share(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "routes")
    lake.write_csv(sample.routes(spark, folder), path)
    routes = lake.read_csv_by_name(
        spark, f"{path}/*.csv", {"route_name": "string", "origin": "string", "typical_duration_min": "int"}
    )
    return lake_queries.incident_share_of_journey(_incidents(spark, folder), routes)


def lake_weather_punctuality(spark: SparkSession, folder: str) -> DataFrame:
    weather = _weather_csv(spark, folder)
    return lake_queries.weather_vs_punctuality(weather, sample.event_fact(spark, folder))


def lake_weather_impact(spark: SparkSession, folder: str) -> DataFrame:
    weather = _weather_csv(spark, folder)
    return lake_queries.weather_impact(weather, sample.event_fact(spark, folder))


def lake_station_attributes(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "attributes")
    lake.write_csv(sample.station_attributes(spark, folder), path)
    attributes = lake.read_csv_by_name(spark, f"{path}/*.csv", _types(STATION_ATTRIBUTES))
    fact, dimension = sample.lineitem_fact(spark, folder), sample.supplier_stations(spark, folder)
    performance = gold.station_performance(fact, dimension).drop("latitude", "longitude")
    return lake_queries.stations_with_attributes(performance, attributes)


def lake_incident_events(spark: SparkSession, folder: str) -> DataFrame:
    return lake_queries.incidents_with_events(_incidents(spark, folder), sample.event_fact(spark, folder))


def lake_monthly_weather(spark: SparkSession, folder: str) -> DataFrame:
    return lake_queries.monthly_weather(_weather_csv(spark, folder))


def lake_format_parity(spark: SparkSession, folder: str) -> DataFrame:
    """The same aggregate over the same rows as CSV and as Parquet."""
    rows = sample.weather_archive(spark, folder)
    path = scratch_dir(spark, "parity")
    lake.write_csv(rows, f"{path}/csv")
    lake.write_parquet(rows, f"{path}/parquet")
    sources = {
        "csv": lake.read_csv(spark, f"{path}/csv", WEATHER_ARCHIVE),
        "parquet": lake.read_parquet(spark, f"{path}/parquet"),
    }
    parts = [
        lake_queries.archive_summary(df).withColumn("source", F.lit(name)) for name, df in sources.items()
    ]
    return parts[0].unionByName(parts[1])


def lake_check_counts(spark: SparkSession, folder: str) -> DataFrame:
    return lake_queries.lake_checks(
        _weather_csv(spark, folder), _archive(spark, folder), _incidents(spark, folder)
    )


QUERIES: dict[str, Query] = {
    # roll-ups
    "fact_events": fact_events,
    "otp_by_scope": _on_events(_rollup("on_time_performance")),
    "otp_by_scope_star": _on_lineitem(
        _rollup("on_time_performance"), train_type=True, category=True
    ),
    "daily_performance": _on_events(_rollup("daily_performance")),
    "hourly_delay_categories": _on_events(_rollup("hourly_delay_categories")),
    "delay_histogram": _on_events(_rollup("delay_histogram")),
    "train_spans": _on_events(_rollup("train_spans")),
    "station_presence": _on_events(_rollup("station_presence")),
    "pair_station_daily": _on_events(_rollup("pair_station_daily")),
    "pair_hourly_daily": _on_events(_rollup("pair_hourly_daily")),
    "timetable_coverage": _on_events(_rollup("timetable_coverage")),
    "station_performance": _on_lineitem(stations.station_map),
    "pair_comparison": _on_events(_rollup("pair_comparison")),
    "pair_by_hour": _fact_function(gold.pair_by_hour),
    "pair_by_weekday": _fact_function(gold.pair_by_weekday),
    "pair_by_station": _fact_function(gold.pair_by_station),
    # stored roll-ups
    "gold_reload": gold_reload,
    "stored_otp_by_scope": _on_stored(_rollup("on_time_performance")),
    "stored_pair_comparison": _on_stored(_rollup("pair_comparison")),
    "stored_daily_performance": _on_stored(_rollup("daily_performance")),
    "stored_hourly_delay_categories": _on_stored(_rollup("hourly_delay_categories")),
    "stored_delay_histogram": _on_stored(_rollup("delay_histogram")),
    "stored_train_spans": _on_stored(_rollup("train_spans")),
    "stored_station_presence": _on_stored(_rollup("station_presence")),
    "stored_pair_station_daily": _on_stored(_rollup("pair_station_daily")),
    "stored_pair_hourly_daily": _on_stored(_rollup("pair_hourly_daily")),
    "stored_timetable_coverage": _on_stored(_rollup("timetable_coverage")),
    "stored_station_performance": _on_stored(stations.station_map),
    "stored_headline": _on_stored(overview.overall_metrics),
    "stored_rush_hour": _on_stored(calendar.rush_hour_performance),
    "stored_weekend_summary": _on_stored(calendar.weekend_summary),
    "stored_period_metrics": _on_stored(pair.period_metrics, 7),
    "stored_rankings_range": _on_stored(train_types.train_rankings, *RANGE, min_trains=5),
    "stored_consistency_median": _on_stored(train_types.consistency),
    # overview
    "headline": _on_events(overview.overall_metrics),
    "rush_stats": _on_events(overview.rush_stats),
    "rush_verdict": _on_events(overview.rush_verdict),
    "category_ranking": _on_events(overview.category_ranking),
    "category_extremes": _on_events(overview.category_extremes),
    "category_table": _on_events(overview.category_table),
    "data_coverage": _on_events(overview.data_coverage),
    "data_period": _on_events(overview.data_period),
    "freshness": _on_events(overview.freshness),
    "hourly_performance": _on_events(overview.hourly_performance),
    "best_hour": _on_events(overview.best_hour),
    "worst_hour": _on_events(overview.worst_hour),
    # pair over a period
    "period_metrics": _on_events(pair.period_metrics, 7),
    "period_metrics_all_time": _on_events(pair.period_metrics, pair.ALL_TIME),
    "period_metrics_hdm": _on_events(pair.type_metrics, "HDM", 7),
    "period_metrics_ic": _on_events(pair.type_metrics, "IC", 7),
    "period_summary": _on_events(pair.comparison_summary, 7),
    "period_complexity": _on_events(pair.complexity_ratios, 7),
    "period_gap": _on_events(pair.performance_gap, 7),
    "period_delay_share": _on_events(pair.delay_distribution, 7),
    "period_hourly": _on_events(pair.hourly_comparison, 7),
    # stations
    "route_station_top10": _on_events_with_stations(pair.route_stations, "HDM", min_stops=10),
    "route_station_top10_ic": _on_events_with_stations(pair.route_stations, "IC", min_stops=10),
    "station_top10_delay": _on_lineitem(stations.most_delayed),
    "station_top10_volume": _on_lineitem(stations.busiest),
    # calendar
    "hourly_pattern_stddev": _on_events(calendar.hourly_pattern),
    "rush_hour": _on_events(calendar.rush_hour_performance),
    "rush_insight": _on_events(calendar.rush_insight),
    "weekday": _on_events(calendar.weekday_performance),
    "weekend_by_category": _on_events(calendar.weekend_by_category),
    "weekend_summary": _on_events(calendar.weekend_summary),
    "weekend_pivot": _on_events(calendar.weekend_pivot),
    "monthly": _on_lineitem(calendar.monthly_trends, train_type=True, category=True),
    "hourly_by_type": _on_events(calendar.hourly_by_type),
    "best_worst_days": _on_events(calendar.best_worst_days),
    "delay_share_by_hour": _on_events(calendar.delay_accumulation),
    "delay_trend": _on_events(calendar.delay_trend),
    # train types
    "category_list": _on_events(train_types.category_options),
    "event_bounds": _on_events(train_types.event_bounds),
    "rankings_range": _on_events(train_types.train_rankings, *RANGE, min_trains=5),
    "rankings_category": _on_events(
        train_types.train_rankings, *RANGE, category="Long%", min_trains=5
    ),
    "rankings_single_day": _on_events(
        train_types.train_rankings, SINGLE_DAY, SINGLE_DAY, min_trains=1
    ),
    "rankings_empty": _on_events(train_types.train_rankings, *reversed(RANGE), min_trains=1),
    "category_summary": _on_events(train_types.category_performance),
    "delay_share_by_type": _on_events(train_types.delay_by_type),
    "top_performers": _on_events(train_types.top_performers),
    "consistency_median": _on_events(train_types.consistency),
    "consistency_median_star": _on_lineitem(
        train_types.consistency, train_type=True, category=True
    ),
    "category_versus": _on_events(train_types.category_comparison),
    "category_pivot": _on_events(train_types.category_pivot),
    "weekend_by_type": _on_events(train_types.weekend_comparison),
    # fact and dimension
    "fact_by_hour": _on_events(star.otp_by_hour),
    "fact_rush": _on_events(star.rush_delay),
    "fact_weekend": _on_events(star.weekend_delay),
    "region_delay": _on_lineitem(star.region_delay),
    "station_label_counts": _on_lineitem(star.station_labels),
    "station_list": _on_lineitem(star.passenger_stations),
    "station_star": _on_lineitem(star.station_star, train_type=True),
    # operators and loading
    "dedup_latest_version": dedup_latest_version,
    "surrogate_key": surrogate_keys,
    "json_field_filter": json_field_filter,
    "nest_unnest_roundtrip": nest_unnest_roundtrip,
    "trains_at_station": trains_at_station,
    "raw_train_statistics": raw_train_statistics,
    "built_from_landing": built_from_landing,
    "streamed_from_landing": streamed_from_landing,
    "day_files_unnested": day_files_unnested,
    "day_files_window": day_files_window,
    "day_files_versions": day_files_versions,
    "day_files_streamed": day_files_streamed,
    "station_dimension": station_dimension,
    "reload_idempotent": reload_idempotent,
    "retention_delete": retention_delete,
    "schema_append": schema_append,
    "quarantine_split": quarantine_split,
    "load_record": load_record,
    "coverage_record": coverage_record,
    "missing_days": missing_days,
    "dq_report": data_test_report,
    "dq_references": reference_test,
    "dq_more": more_data_tests,
    "dq_unnested": unnested_tests,
    "dq_others": other_data_tests,
    "dq_by_day": tests_by_day,
    # manifest
    "file_stats": file_stats,
    "pruned_read": pruned_read,
    "snapshot_read": snapshot_read,
    "snapshot_log": snapshot_log,
    "rewritten_file_read": rewritten_file_read,
    "time_zone_read": time_zone_read,
    # lake
    "lake_cold_days": lake_cold_days,
    "lake_archive_summary": lake_archive_summary,
    "lake_weather_incidents": lake_weather_incidents,
    "lake_incident_arrays": lake_incident_arrays,
    "lake_join_csv_parquet": lake_join_csv_parquet,
    "lake_temperature_anomaly": lake_temperature_anomaly,
    "lake_incident_share": lake_incident_share,
    "lake_weather_punctuality": lake_weather_punctuality,
    "lake_weather_impact": lake_weather_impact,
    "lake_station_attributes": lake_station_attributes,
    "lake_incident_events": lake_incident_events,
    "lake_monthly_weather": lake_monthly_weather,
    "lake_format_parity": lake_format_parity,
    "lake_check_counts": lake_check_counts,
}


def _comparable(query: Query) -> Query:
    return lambda spark, folder: comparable(query(spark, folder))


def registered() -> dict[str, Query]:
    return {name: _comparable(query) for name, query in QUERIES.items()}
