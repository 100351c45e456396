"""The driver's tables in the shapes this library works on.

Shape E maps `events` to an event fact, shape L maps the `lineitem` star, and shape N
nests `events` into trains. The lake frames are weather, incidents, routes and station
attributes derived from the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.plans.silver import with_event_attributes
from punctual.sources import files

ROWS_PER_TRAIN = 64  # shape N: no nested array is longer
PART_BYTES = 8 << 20  # shape L: stored bytes of lines and orders that a task joins

# Pinned, so that opening a table costs no pass over its files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


# shape E

STATION = "get_json_object(props, '$.k')"
KIND = "if(event_id % 2 = 0, 'ARRIVAL', 'DEPARTURE')"
DELAY = "if(event_id % 97 <> 0, floor(value) - 3, NULL)"
ACTUAL_TIME = """
    CASE WHEN event_id % 89 = 0 THEN NULL
         WHEN event_id % 53 = 0 THEN cast(cast(ts AS date) AS timestamp_ntz)
         ELSE ts + make_dt_interval(0, 0, cast(floor(value) - 3 AS int)) END"""
TYPE = "CASE event_type WHEN 'click' THEN 'IC' WHEN 'view' THEN 'HDM' WHEN 'purchase' THEN 'S' WHEN 'signup' THEN 'HL' END"
CATEGORY = """
    CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'Long-distance'
         WHEN event_type = 'signup' THEN 'Commuter' ELSE 'Cargo' END"""


def event_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Shape E before the derived attributes, with the event's own id kept."""
    return table(spark, folder, "events").selectExpr(
        "event_id",
        "user_id * 10 + length(event_type) AS trainNumber",
        "cast(ts AS date) AS departureDate",
        f"{TYPE} AS trainType",
        f"{CATEGORY} AS trainCategory",
        f"{STATION} AS stationShortCode",
        f"{KIND} AS event_type",
        "event_id % 7 <> 0 AS commercial_stop",
        "ts AS scheduled_time",
        f"{ACTUAL_TIME} AS actual_time",
        f"{DELAY} AS delay_minutes",
    )


def event_fact(spark: SparkSession, folder: str) -> DataFrame:
    return with_event_attributes(event_rows(spark, folder))


# shape L


def _by_order(spark: SparkSession, folder: str, lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines with their orders. The parts of the join follow the size of the tables, so a task
    sorts and groups the same number of rows at any size; adaptive execution by itself merges
    parts until they are as many as cores, or 64 MB each. Tables of fewer parts than cores
    are left to it."""
    stored = sum(files.size(spark, f"{folder}/{name}.parquet") for name in ("lineitem", "orders"))
    parts = -(-stored // PART_BYTES)
    if parts > spark.sparkContext.defaultParallelism:
        lines, orders = lines.repartition(parts, "l_orderkey"), orders.repartition(parts, "o_orderkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def lineitem_rows(
    spark: SparkSession, folder: str, train_type: bool = False, category: bool = False
) -> DataFrame:
    """Shape L. Type and category each cost a join, so they are added on request. The join by
    order comes last: what it has put together by train is grouped without another exchange."""
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    extra = []
    if train_type:
        lines = lines.join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        extra.append("p_type AS trainType")
    if category:
        orders = orders.join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        extra.append("c_mktsegment AS trainCategory")
    lines = _by_order(spark, folder, lines, orders)
    return lines.selectExpr(
        "l_orderkey AS trainNumber",
        "cast(o_orderdate AS date) AS departureDate",
        "cast(l_suppkey AS string) AS stationShortCode",
        "if(l_linestatus = 'F', 'ARRIVAL', 'DEPARTURE') AS event_type",
        "l_returnflag <> 'A' AS commercial_stop",
        "o_orderdate + make_dt_interval(0, l_linenumber) AS scheduled_time",
        "l_shipdate AS actual_time",
        "cast(datediff(l_shipdate, o_orderdate) AS bigint) AS delay_minutes",
        *extra,
    )


def lineitem_fact(
    spark: SparkSession, folder: str, train_type: bool = False, category: bool = False
) -> DataFrame:
    return with_event_attributes(lineitem_rows(spark, folder, train_type, category))


def supplier_stations(spark: SparkSession, folder: str) -> DataFrame:
    """The station dimension of shape L."""
    suppliers = table(spark, folder, "supplier")
    nations = table(spark, folder, "nation")
    regions = table(spark, folder, "region")
    kinds = ["STATION", "STOPPING_POINT", "TURNOUT_IN_THE_OPEN_LINE"]
    labels = ["Major Station", "Stopping Point", "Turnout"]
    position = (F.col("s_suppkey") % 3 + 1).cast("int")
    serves = F.col("s_acctbal") > 0
    return (
        suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").cast("string").alias("stationShortCode"),
            F.col("s_name").alias("stationName"),
            F.col("s_suppkey").alias("stationUICCode"),
            (60 + F.col("n_nationkey") / 10).alias("latitude"),
            (20 + F.col("n_nationkey") / 10).alias("longitude"),
            serves.alias("passengerTraffic"),
            F.element_at(F.array(*[F.lit(k) for k in kinds]), position).alias("type"),
            F.element_at(F.array(*[F.lit(x) for x in labels]), position).alias("station_type_label"),
            F.when(serves, "Passenger Service").otherwise("No Passenger Service").alias("passenger_service_label"),
            F.col("r_name").alias("region"),
        )
    )


# shape N


TIME_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def nested_trains(spark: SparkSession, folder: str) -> DataFrame:
    """`events` nested into trains of the pinned input schema. A train is a block of 64
    event ids, so an array has at most 64 rows, whatever the key distribution. A block whose
    number does not fit the input's int fails the cast (ANSI mode); none is wrapped."""
    row = f"""struct(
        {KIND} AS type, event_id % 7 <> 0 AS commercialStop,
        date_format(ts, "{TIME_TEXT}") AS scheduledTime,
        date_format({ACTUAL_TIME}, "{TIME_TEXT}") AS actualTime,
        {DELAY} AS differenceInMinutes, {STATION} AS stationShortCode,
        cast(NULL AS bigint) AS stationUICCode, true AS trainStopping)"""
    rows = table(spark, folder, "events").selectExpr(
        f"event_id div {ROWS_PER_TRAIN} AS block", "cast(ts AS date) AS day", f"{row} AS row"
    )
    blocks = rows.groupBy("block").agg(
        F.min("day").alias("departureDate"), F.collect_list("row").alias("timeTableRows")
    )
    return blocks.selectExpr(
        "cast(block AS int) AS trainNumber",
        "departureDate",
        "'vr' AS operatorShortCode",
        "element_at(array('IC', 'HDM', 'S', 'HL'), cast(block % 4 AS int) + 1) AS trainType",
        "element_at(array('Long-distance', 'Commuter', 'Cargo'), cast(block % 3 AS int) + 1) AS trainCategory",
        "block % 11 = 0 AS cancelled",
        "cast(1 AS bigint) AS version",
        "timeTableRows",
    )


# lake frames


def weather(spark: SparkSession, folder: str) -> DataFrame:
    """One row per day and city; each kind of event belongs to a city."""
    cities = table(spark, folder, "events").selectExpr(
        "cast(ts AS date) AS date",
        "if(event_type IN ('view', 'error'), 'Tampere', 'Helsinki') AS city",
        "event_id",
    )
    days = cities.groupBy("date", "city")
    return days.agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last")).selectExpr(
        "date",
        "city",
        "(n % 41 - 20) / 2.0D AS temperature_c",
        "(last % 13) / 2.0D AS precipitation_mm",
        "cast(last % 31 AS double) AS wind_speed_kmh",
        "cast(n % 9 AS int) AS snow_depth_cm",
        "if(n % 9 > 5, 'Snowy', 'Cloudy') AS conditions",
    )


def weather_archive(spark: SparkSession, folder: str) -> DataFrame:
    """One reading per order, spread over two years and five stations."""
    return table(spark, folder, "orders").selectExpr(
        "date_add(date'2023-01-01', cast(o_orderkey % 731 AS int)) AS date",
        "element_at(array('HKI', 'TPE', 'TKU', 'OL', 'JY'), cast(o_custkey % 5 AS int) + 1) AS station_code",
        "(o_orderkey % 400 - 200) / 10.0D AS temp_avg_c",
        "(o_orderkey % 400 - 230) / 10.0D AS temp_min_c",
        "(o_orderkey % 400 - 170) / 10.0D AS temp_max_c",
        "(o_orderkey % 17) / 2.0D AS precipitation_mm",
        "cast(o_orderkey % 6 AS int) AS snow_depth_cm",
        "cast(o_orderkey % 23 AS double) AS wind_speed_kmh",
        "cast(o_orderkey % 20 + 5 AS double) AS visibility_km",
    )


def incidents(spark: SparkSession, folder: str) -> DataFrame:
    """One incident per event, with a nested impact."""
    return table(spark, folder, "events").selectExpr(
        "concat('INC-', event_id) AS incident_id",
        "cast(ts AS date) AS date",
        "user_id * 10 + length(event_type) AS train_number",
        f"{STATION} AS station",
        "floor(value) AS delay_minutes",
        "if(event_id % 4 = 0, 'weather', 'technical') AS category",
        "if(event_id % 4 = 0, 'storm', 'engine_issue') AS subcategory",
        "event_id % 4 = 0 AS weather_related",
        "floor(value) * 2 AS resolved_time_minutes",
        "struct(event_id % 7 + 1 AS affected_trains, floor(value) * 3 AS total_delay_minutes) AS impact",
    )


def routes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").selectExpr(
        "concat('R', n_nationkey) AS route_id",
        "n_name AS route_name",
        "cast(n_nationkey AS string) AS origin",
        "cast(n_nationkey + 1 AS string) AS destination",
        "n_nationkey * 10 + 100 AS distance_km",
        "n_nationkey * 5 + 60 AS typical_duration_min",
        "n_nationkey % 7 + 2 AS stops",
        "'IC' AS train_types",
    )


def station_attributes(spark: SparkSession, folder: str) -> DataFrame:
    """For all suppliers; every third goes by a code that no station has."""
    return table(spark, folder, "supplier").selectExpr(
        "concat(if(s_suppkey % 3 = 0, 'old-', ''), s_suppkey) AS station_code",
        "s_suppkey * 1000 + 5000 AS population_nearby",
        "cast(s_suppkey % 9 + 1 AS int) AS platforms",
        "if(s_suppkey % 2 = 0, 'Yes', 'No') AS has_restaurant",
        "cast(s_suppkey % 300 AS int) AS parking_spaces",
        "cast(s_suppkey % 120 AS int) AS elevation_m",
        "s_name AS region",
    )
