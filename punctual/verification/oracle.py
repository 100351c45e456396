"""The same results as DuckDB SQL over the driver's tables.

Roll-ups and reports are written against event rows, never against a roll-up, so the SQL
checks that the merged measures, spans, runs and histograms lose nothing. Dates come out
as ISO text, whole numbers as BIGINT, like `queries.comparable` does it.
"""

from __future__ import annotations

# shape E as `fact`, its completed commercial stops as `ev`

EVENT_ROWS = """
rows_e AS (
  SELECT event_id,
         user_id * 10 + length(event_type) AS "trainNumber",
         CAST(ts AS DATE) AS "departureDate",
         CASE event_type WHEN 'click' THEN 'IC' WHEN 'view' THEN 'HDM'
                         WHEN 'purchase' THEN 'S' WHEN 'signup' THEN 'HL' END AS "trainType",
         CASE event_type WHEN 'signup' THEN 'Commuter' WHEN 'error' THEN 'Cargo'
                         ELSE 'Long-distance' END AS "trainCategory",
         regexp_extract(props, '"k": *([0-9]+)', 1) AS "stationShortCode",
         CASE WHEN event_id % 2 = 0 THEN 'ARRIVAL' ELSE 'DEPARTURE' END AS event_type,
         event_id % 7 <> 0 AS commercial_stop,
         ts AS scheduled_time,
         CASE WHEN event_id % 89 = 0 THEN NULL
              WHEN event_id % 53 = 0 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP)
              ELSE ts + to_minutes(CAST(floor(value) - 3 AS BIGINT)) END AS actual_time,
         CASE WHEN event_id % 97 <> 0 THEN CAST(floor(value) AS BIGINT) - 3 END AS delay_minutes
  FROM events
)"""

DERIVED = """
  SELECT *,
         CAST(hour(scheduled_time) AS BIGINT) AS scheduled_hour,
         CAST(dayofweek(scheduled_time) AS BIGINT) AS day_of_week,
         CAST(month(scheduled_time) AS BIGINT) AS scheduled_month,
         CAST(year(scheduled_time) AS BIGINT) AS scheduled_year,
         delay_minutes <= 5 AS is_on_time,
         CASE WHEN delay_minutes IS NULL THEN 'unknown'
              WHEN delay_minutes < 0 THEN 'early'
              WHEN delay_minutes < 6 THEN 'on_time'
              WHEN delay_minutes < 16 THEN 'slightly_late'
              WHEN delay_minutes < 31 THEN 'late'
              ELSE 'very_late' END AS delay_category,
         CASE WHEN hour(scheduled_time) IN (6, 7, 8, 9) THEN 'morning_rush'
              WHEN hour(scheduled_time) IN (16, 17, 18, 19) THEN 'evening_rush'
              ELSE 'off_peak' END AS time_of_day_category,
         dayofweek(scheduled_time) IN (0, 6) AS is_weekend,
         CAST(actual_time AS DATE) AS actual_day,
         actual_time = CAST(CAST(actual_time AS DATE) AS TIMESTAMP) AS at_midnight"""

STOPS = """
ev AS (
  SELECT *, CASE WHEN at_midnight THEN actual_time
                 ELSE CAST(actual_day AS TIMESTAMP) + INTERVAL 12 HOUR END AS actual_bucket
  FROM fact WHERE commercial_stop AND actual_time IS NOT NULL
)"""

E = f"WITH {EVENT_ROWS}, fact AS ({DERIVED} FROM rows_e), {STOPS}"

# shape L with its station dimension `dim`

DIM = """
dim AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS "stationShortCode", s_name AS "stationName",
         60 + n_nationkey / 10 AS latitude, 20 + n_nationkey / 10 AS longitude,
         s_acctbal > 0 AS "passengerTraffic",
         CASE s_suppkey % 3 WHEN 0 THEN 'Major Station' WHEN 1 THEN 'Stopping Point'
                            ELSE 'Turnout' END AS station_type_label,
         CASE WHEN s_acctbal > 0 THEN 'Passenger Service'
              ELSE 'No Passenger Service' END AS passenger_service_label,
         r_name AS region
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

LINE_ROWS = """
rows_l AS (
  SELECT l_orderkey AS "trainNumber", CAST(o_orderdate AS DATE) AS "departureDate",
         p_type AS "trainType", c_mktsegment AS "trainCategory",
         CAST(l_suppkey AS VARCHAR) AS "stationShortCode",
         CASE l_linestatus WHEN 'F' THEN 'ARRIVAL' ELSE 'DEPARTURE' END AS event_type,
         l_returnflag <> 'A' AS commercial_stop,
         o_orderdate + to_hours(l_linenumber) AS scheduled_time,
         l_shipdate AS actual_time,
         date_diff('day', o_orderdate, l_shipdate) AS delay_minutes
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey
)"""

L = f"WITH {LINE_ROWS}, {DIM}, fact AS ({DERIVED} FROM rows_l), {STOPS}"
E_DIM = f"{E}, {DIM}"

# aggregates over event rows

TRAIN = """CAST("trainNumber" AS VARCHAR) || '/' || CAST("departureDate" AS VARCHAR)"""
TRAINS = f"COUNT(DISTINCT {TRAIN})"
# a train with two types or categories is one run per type and category
RUN = f"""{TRAIN} || '/' || COALESCE("trainType", '') || '/' || COALESCE("trainCategory", '')"""
RUNS = f"COUNT(DISTINCT {RUN})"
OTP = "ROUND(100.0 * COUNT(*) FILTER (WHERE is_on_time) / COUNT(*), 2)"
MEAN = "ROUND(AVG(delay_minutes), 2)"
STDDEV = "ROUND(STDDEV_SAMP(delay_minutes), 2)"
MEASURES = """COUNT(*) AS events, COUNT(*) FILTER (WHERE is_on_time) AS on_time_events,
  CAST(SUM(delay_minutes) AS BIGINT) AS delay_sum,
  CAST(SUM(delay_minutes * delay_minutes) AS BIGINT) AS delay_sumsq,
  COUNT(delay_minutes) AS delay_count"""
DAY_NAME = "dayname(DATE '2024-01-07' + CAST(day_of_week AS INTEGER))"
RECENT = """ "departureDate" > (SELECT MAX("departureDate") FROM fact) - 7"""
PAIR = """ "trainType" IN ('IC', 'HDM')"""
MAIN = """ "trainCategory" IN ('Long-distance', 'Commuter', 'Cargo', 'Locomotive')"""


def _share(category: str) -> str:
    return f"ROUND(100.0 * COUNT(*) FILTER (WHERE delay_category = '{category}') / COUNT(*), 2)"


def _count(category: str) -> str:
    return f"COUNT(*) FILTER (WHERE delay_category = '{category}')"


def _grouped(base: str, keys: str, values: str, source: str = "ev", where: str = "TRUE") -> str:
    return f"{base} SELECT {keys}, {values} FROM {source} WHERE {where} GROUP BY {keys}"


def _scopes(base: str) -> str:
    """One SELECT per scope over the event rows."""
    figures = f"""COUNT(*) AS total_events, {TRAINS} AS total_trains,
      COUNT(DISTINCT "stationShortCode") AS total_stations,
      COUNT(*) FILTER (WHERE is_on_time) AS on_time_count, {OTP} AS on_time_percentage,
      {MEAN} AS avg_delay_minutes, ROUND(MEDIAN(delay_minutes), 2) AS median_delay_minutes,
      MAX(delay_minutes) AS max_delay_minutes, MIN(delay_minutes) AS min_delay_minutes,
      {_count("early")} AS early_count, {_count("on_time")} AS on_time_count_strict,
      {_count("slightly_late")} AS slightly_late_count, {_count("late")} AS late_count,
      {_count("very_late")} AS very_late_count,
      {_share("early")} AS early_pct, {_share("on_time")} AS on_time_pct,
      {_share("slightly_late")} AS slightly_late_pct, {_share("late")} AS late_pct,
      {_share("very_late")} AS very_late_pct"""
    return f"""{base}
    SELECT 'Overall' AS metric_scope, {figures} FROM ev
    UNION ALL SELECT "trainType", {figures} FROM ev GROUP BY "trainType"
    UNION ALL SELECT "trainCategory", {figures} FROM ev GROUP BY "trainCategory" """


def _shares(base: str, key: str, name: str, where: str = "TRUE") -> str:
    return f"""{base}, parts AS (
      SELECT {key} AS {name}, delay_category, COUNT(*) AS events FROM ev WHERE {where} GROUP BY ALL
    ), totals AS (SELECT {name}, SUM(events) AS total FROM parts GROUP BY {name})
    SELECT p.{name}, p.delay_category, p.events, ROUND(100.0 * p.events / t.total, 2) AS percentage
    FROM parts p JOIN totals t ON p.{name} IS NOT DISTINCT FROM t.{name}"""


PERIOD = f""" "trainType" AS train_type, {OTP} AS on_time_percentage, {MEAN} AS avg_delay_minutes,
  {TRAINS} AS total_trains, COUNT(*) AS total_stops,
  COUNT(DISTINCT "stationShortCode") AS stations_served"""


def _period(where: str = RECENT) -> str:
    return f"""SELECT {PERIOD} FROM ev WHERE {PAIR} AND {where} GROUP BY "trainType" """


def _hours() -> str:
    return f"SELECT scheduled_hour, {OTP} AS otp_percentage, COUNT(*) AS events FROM ev GROUP BY scheduled_hour"


def _one_hour(order: str) -> str:
    return f"{E} SELECT * FROM ({_hours()}) ORDER BY otp_percentage {order}, scheduled_hour LIMIT 1"


def _rankings(start: str, end: str, pattern: str, min_trains: int) -> str:
    """Straight from the events: everything between two midnights."""
    return f"""{E}
    SELECT "trainType" AS train_type, "trainCategory" AS category, {TRAINS} AS trains,
      COUNT(*) AS total_stops, {OTP} AS otp_percentage, {MEAN} AS avg_delay,
      {STDDEV} AS delay_stddev, COUNT(DISTINCT "stationShortCode") AS stations_served
    FROM ev
    WHERE "trainCategory" LIKE '{pattern}'
      AND actual_time BETWEEN TIMESTAMP '{start}' AND TIMESTAMP '{end}'
    GROUP BY ALL HAVING {TRAINS} >= {min_trains}"""


def _route(train_type: str) -> str:
    return f"""{E_DIM}
    SELECT "stationName", "stationShortCode", COUNT(*) AS stops, {OTP} AS otp_percentage, {MEAN} AS avg_delay
    FROM ev JOIN dim USING ("stationShortCode") WHERE "trainType" = '{train_type}'
    GROUP BY ALL HAVING COUNT(*) >= 10
    ORDER BY otp_percentage DESC, "stationShortCode" LIMIT 10"""


STATION_FIGURES = f"""total AS (
  SELECT "stationShortCode" AS station_code, "stationName" AS station_name, latitude, longitude, region,
    COUNT(*) AS total_events, {TRAINS} AS total_trains, {OTP} AS on_time_percentage,
    {MEAN} AS avg_delay_minutes
  FROM ev JOIN dim USING ("stationShortCode") WHERE "passengerTraffic"
  GROUP BY ALL HAVING COUNT(*) >= 100
)"""
STATION_COLUMNS = """station_name, station_code, region, total_events, total_trains,
  on_time_percentage, avg_delay_minutes"""


def _consistency(base: str) -> str:
    return f"""{base}
    SELECT "trainType" AS train_type, {RUNS} AS trains, {MEAN} AS avg_delay, {STDDEV} AS delay_stddev,
      MIN(delay_minutes) AS min_delay, MAX(delay_minutes) AS max_delay,
      ROUND(MEDIAN(delay_minutes), 2) AS median_delay
    FROM ev GROUP BY "trainType" HAVING {RUNS} >= 50"""


# shape N: blocks of 64 events as trains

N_FACT = """
blocks AS (
  SELECT event_id // 64 AS block, MIN(CAST(ts AS DATE)) AS day FROM events GROUP BY ALL
), trains AS (
  SELECT block, day, block AS "trainNumber", day AS "departureDate",
    CASE block % 4 WHEN 0 THEN 'IC' WHEN 1 THEN 'HDM' WHEN 2 THEN 'S' ELSE 'HL' END AS "trainType",
    CASE block % 3 WHEN 0 THEN 'Long-distance' WHEN 1 THEN 'Commuter' ELSE 'Cargo' END AS "trainCategory",
    block % 11 = 0 AS cancelled
  FROM blocks
), rows_n AS (
  SELECT t."trainNumber", t."departureDate", t."trainType", t."trainCategory",
    e."stationShortCode", e.event_type, e.commercial_stop, e.delay_minutes,
    date_trunc('millisecond', e.scheduled_time) AS scheduled_time,
    date_trunc('millisecond', e.actual_time) AS actual_time
  FROM rows_e e JOIN trains t ON e.event_id // 64 = t.block WHERE NOT t.cancelled
)"""
N = f"WITH {EVENT_ROWS}, {N_FACT}, fact AS ({DERIVED} FROM rows_n), {STOPS}"
N_TRAINS = f"WITH {EVENT_ROWS}, {N_FACT}"

# lake frames

WEATHER = """
days AS (
  SELECT CAST(ts AS DATE) AS date,
    CASE WHEN event_type IN ('view', 'error') THEN 'Tampere' ELSE 'Helsinki' END AS city,
    COUNT(*) AS n, MAX(event_id) AS last
  FROM events GROUP BY ALL
), weather AS (
  SELECT date, city, (n % 41 - 20) / 2.0 AS temperature_c, (last % 13) / 2.0 AS precipitation_mm,
    CAST(last % 31 AS DOUBLE) AS wind_speed_kmh, n % 9 AS snow_depth_cm,
    CASE WHEN n % 9 > 5 THEN 'Snowy' ELSE 'Cloudy' END AS conditions
  FROM days
)"""
ARCHIVE = """
archive AS (
  SELECT DATE '2023-01-01' + CAST(o_orderkey % 731 AS INTEGER) AS date,
    CASE o_custkey % 5 WHEN 0 THEN 'HKI' WHEN 1 THEN 'TPE' WHEN 2 THEN 'TKU' WHEN 3 THEN 'OL'
                       ELSE 'JY' END AS station_code,
    CAST((o_orderkey % 400 - 200) / 10.0 AS DOUBLE) AS temp_avg_c,
    CAST((o_orderkey % 17) / 2.0 AS DOUBLE) AS precipitation_mm
  FROM orders
)"""
INCIDENTS = """
incidents AS (
  SELECT 'INC-' || event_id AS incident_id, CAST(ts AS DATE) AS date, user_id * 10 + length(event_type) AS train_number,
    regexp_extract(props, '"k": *([0-9]+)', 1) AS station, CAST(floor(value) AS BIGINT) AS delay_minutes,
    event_id % 4 = 0 AS weather_related, event_id % 7 + 1 AS affected_trains
  FROM events
)"""
PER_DAY = """
weather_days AS (
  SELECT date, AVG(temperature_c) AS temperature_c, MAX(precipitation_mm) AS precipitation_mm,
    MAX(snow_depth_cm) AS snow_depth_cm, MAX(wind_speed_kmh) AS wind_speed_kmh
  FROM weather GROUP BY date
)"""
SUMMARY = """SELECT station_code, ROUND(AVG(temp_avg_c), 2) AS avg_temp,
  ROUND(AVG(precipitation_mm), 2) AS avg_precip, COUNT(*) AS days FROM archive GROUP BY station_code"""


def _test_row(table: str, test: str, failures: str, severity: str = "error") -> str:
    text = test.replace("'", "''")
    return f"""SELECT '{table}' AS table_name, '{text}' AS test, '{severity}' AS severity,
      ({failures}) AS failures, ({failures}) = 0 AS passed"""


def _test_bad(table: str, source: str, test: str, condition: str, severity: str = "error") -> str:
    return _test_row(table, test, f"SELECT COUNT(*) FILTER (WHERE {condition}) FROM {source}", severity)


def _test_repeated(table: str, source: str, test: str, keys: str) -> str:
    return _test_row(table, test, f"SELECT COUNT(*) FROM (SELECT {keys} FROM {source} GROUP BY ALL HAVING COUNT(*) > 1)")


def _test_nulls(table: str, source: str, columns: list[str], severity: str = "error") -> list[str]:
    return [_test_bad(table, source, f"not_null({c})", f'"{c}" IS NULL', severity) for c in columns]


def _data_tests() -> str:
    """One SELECT per declared test of the four tables."""
    tables = f"""{E}, daily AS (
      SELECT actual_bucket, "trainType", "trainCategory", day_of_week, scheduled_month, is_weekend, {MEASURES}
      FROM ev GROUP BY ALL
    ), histogram AS (SELECT "trainType", delay_minutes, {MEASURES} FROM ev GROUP BY ALL),
    spans AS ({_spans()})"""

    bad, repeated, nulls, row = _test_bad, _test_repeated, _test_nulls, _test_row
    agree = "on_time_events <= events AND delay_count <= events"
    identity = "delay_count = CASE WHEN delay_minutes IS NULL THEN 0 ELSE events END"
    order = "first_actual_bucket <= last_actual_bucket AND n_trains >= 1"
    two_days = "datediff(last_actual_bucket, first_actual_bucket) <= 1"
    event_key = """ "trainNumber", "departureDate", "stationShortCode", event_type, scheduled_time"""
    span_columns = [
        *["departureDate", "trainType", "trainCategory", "first_actual_bucket", "last_actual_bucket"],
        *["midnight_days", "has_morning_rush", "has_off_peak", "has_evening_rush", "has_weekday", "has_weekend"],
    ]
    daily_key = ["actual_bucket", "trainType", "trainCategory", "day_of_week", "scheduled_month"]
    quoted = {k: ", ".join(f'"{c}"' for c in v) for k, v in {"daily": daily_key, "spans": span_columns}.items()}
    types = ["trainType", "trainCategory"]
    tests = [
        *nulls("daily_performance", "daily", ["actual_bucket", "day_of_week", "is_weekend", "events"]),
        *nulls("daily_performance", "daily", types, "warn"),
        bad("daily_performance", "daily", f"expression({agree})", f"NOT ({agree})"),
        repeated("daily_performance", "daily", f"unique_combination({', '.join(daily_key)})", quoted["daily"]),
        *nulls("delay_histogram", "histogram", ["events"]),
        *nulls("delay_histogram", "histogram", ["trainType"], "warn"),
        bad("delay_histogram", "histogram", f"expression({identity})", f"NOT ({identity})"),
        repeated("delay_histogram", "histogram", "unique_combination(trainType, delay_minutes)", '"trainType", delay_minutes'),
        *nulls("train_spans", "spans", ["departureDate", "first_actual_bucket", "last_actual_bucket"]),
        *nulls("train_spans", "spans", ["midnight_days", "n_trains"]),
        *nulls("train_spans", "spans", types, "warn"),
        bad("train_spans", "spans", f"expression({order})", f"NOT ({order})"),
        bad(
            "train_spans",
            "spans",
            f"expression({two_days})",
            "date_diff('day', first_actual_bucket, last_actual_bucket) > 1",
            "warn",
        ),
        repeated("train_spans", "spans", f"unique_combination({', '.join(span_columns)})", quoted["spans"]),
        row("fact_timetable_events", "not_null(sk_event)", "SELECT 0"),
        *nulls("fact_timetable_events", "fact", ["trainNumber", "departureDate", "event_type"]),
        bad(
            "fact_timetable_events",
            "fact",
            "accepted_values(event_type)",
            "event_type NOT IN ('ARRIVAL', 'DEPARTURE')",
        ),
        bad(
            "fact_timetable_events",
            "fact",
            "accepted_values(delay_category)",
            "delay_category NOT IN ('early', 'on_time', 'slightly_late', 'late', 'very_late', 'unknown')",
        ),
        repeated("fact_timetable_events", "fact", "unique(sk_event)", event_key),
    ]
    return f"{tables} " + " UNION ALL ".join(tests)


def _spans() -> str:
    return """
    SELECT "departureDate", "trainType", "trainCategory", first_actual_bucket, last_actual_bucket,
      midnight_days, has_morning_rush, has_off_peak, has_evening_rush, has_weekday, has_weekend,
      COUNT(*) AS n_trains
    FROM (
      SELECT "departureDate", "trainType", "trainCategory",
        MIN(actual_bucket) AS first_actual_bucket, MAX(actual_bucket) AS last_actual_bucket,
        COALESCE(array_to_string(list_sort(list(DISTINCT CAST(actual_day AS VARCHAR))
          FILTER (WHERE at_midnight)), ','), '') AS midnight_days,
        COUNT(*) FILTER (WHERE time_of_day_category = 'morning_rush') > 0 AS has_morning_rush,
        COUNT(*) FILTER (WHERE time_of_day_category = 'off_peak') > 0 AS has_off_peak,
        COUNT(*) FILTER (WHERE time_of_day_category = 'evening_rush') > 0 AS has_evening_rush,
        COUNT(*) FILTER (WHERE NOT is_weekend) > 0 AS has_weekday,
        COUNT(*) FILTER (WHERE is_weekend) > 0 AS has_weekend
      FROM ev WHERE "trainNumber" IS NOT NULL AND "departureDate" IS NOT NULL
      GROUP BY "trainNumber", "departureDate", "trainType", "trainCategory"
    ) GROUP BY ALL"""


PRESENCE = f"""{E}, stamps AS (
  SELECT DISTINCT "trainType", "trainCategory", "stationShortCode", actual_bucket AS b FROM ev
), linked AS (
  SELECT s.*, EXISTS (
    SELECT 1 FROM stamps p
    WHERE p."trainType" IS NOT DISTINCT FROM s."trainType"
      AND p."trainCategory" IS NOT DISTINCT FROM s."trainCategory"
      AND p."stationShortCode" IS NOT DISTINCT FROM s."stationShortCode"
      AND p.b < s.b AND p.b >= s.b - INTERVAL 1 DAY) AS follows
  FROM stamps s
), numbered AS (
  SELECT *, COUNT(*) FILTER (WHERE NOT follows) OVER (
    PARTITION BY "trainType", "trainCategory", "stationShortCode" ORDER BY b) AS run
  FROM linked
)
SELECT "trainType", "trainCategory", "stationShortCode",
  MIN(b) AS first_actual_bucket, MAX(b) AS last_actual_bucket,
  COALESCE(array_to_string(list_sort(list(CAST(CAST(b AS DATE) AS VARCHAR))
    FILTER (WHERE b = CAST(CAST(b AS DATE) AS TIMESTAMP))), ','), '') AS midnight_days
FROM numbered GROUP BY "trainType", "trainCategory", "stationShortCode", run"""

PAIR_FIGURES = f""" "trainType" AS train_type, COUNT(*) AS total_stops, {TRAINS} AS total_trains,
  COUNT(DISTINCT "stationShortCode") AS stations_served,
  COUNT(DISTINCT CAST(scheduled_time AS DATE)) AS operating_days,
  COUNT(*) FILTER (WHERE is_on_time) AS on_time_stops, {OTP} AS on_time_percentage,
  {MEAN} AS avg_delay_minutes, ROUND(MEDIAN(delay_minutes), 2) AS median_delay_minutes,
  {STDDEV} AS stddev_delay_minutes, MIN(delay_minutes) AS min_delay_minutes,
  MAX(delay_minutes) AS max_delay_minutes,
  ROUND(quantile_cont(delay_minutes, 0.25), 2) AS p25_delay,
  ROUND(quantile_cont(delay_minutes, 0.75), 2) AS p75_delay,
  ROUND(quantile_cont(delay_minutes, 0.90), 2) AS p90_delay,
  ROUND(quantile_cont(delay_minutes, 0.95), 2) AS p95_delay,
  {_share("early")} AS early_pct, {_share("on_time")} AS on_time_pct,
  {_share("slightly_late")} AS slightly_late_pct, {_share("late")} AS late_pct,
  {_share("very_late")} AS very_late_pct,
  COUNT(*) FILTER (WHERE event_type = 'ARRIVAL') AS arrival_count,
  COUNT(*) FILTER (WHERE event_type = 'DEPARTURE') AS departure_count,
  ROUND(100.0 * COUNT(*) FILTER (WHERE event_type = 'ARRIVAL' AND is_on_time)
    / NULLIF(COUNT(*) FILTER (WHERE event_type = 'ARRIVAL'), 0), 2) AS arrival_otp,
  ROUND(100.0 * COUNT(*) FILTER (WHERE event_type = 'DEPARTURE' AND is_on_time)
    / NULLIF(COUNT(*) FILTER (WHERE event_type = 'DEPARTURE'), 0), 2) AS departure_otp"""

PAIR_SHORT = f"COUNT(*) AS stops, {OTP} AS otp_pct, {MEAN} AS avg_delay"
DEPARTURE_TEXT = 'CAST("departureDate" AS VARCHAR) AS "departureDate"'
CATEGORY_FIGURES = f"{OTP} AS on_time_percentage"


def _dates_as_text(sql: str, *columns: str) -> str:
    """Wrap a query so that the date columns come out as ISO text."""
    casts = ", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in columns)
    return f"SELECT * REPLACE ({casts}) FROM ({sql})"


def _day_counts(where: str) -> str:
    return f"""WITH {EVENT_ROWS} SELECT {DEPARTURE_TEXT}, COUNT(*) AS events,
      CAST(SUM(delay_minutes) AS BIGINT) AS delay_sum FROM rows_e WHERE {where} GROUP BY "departureDate" """


ORACLE: dict[str, str] = {
    "fact_events": f"""{E} SELECT event_id, "trainNumber", {DEPARTURE_TEXT}, actual_time, delay_minutes,
      scheduled_hour, day_of_week, scheduled_month, scheduled_year, is_on_time, delay_category,
      time_of_day_category, is_weekend FROM fact""",
    "otp_by_scope": _scopes(E),
    "otp_by_scope_star": _scopes(L),
    "daily_performance": _grouped(
        E, 'actual_bucket, "trainType", "trainCategory", day_of_week, scheduled_month, is_weekend', MEASURES
    ),
    "hourly_delay_categories": _grouped(
        E, 'scheduled_hour, time_of_day_category, "trainType", "trainCategory", delay_category', MEASURES
    ),
    "delay_histogram": _grouped(E, '"trainType", delay_minutes', MEASURES),
    "train_spans": _dates_as_text(f"{E} {_spans()}", "departureDate"),
    "station_presence": PRESENCE,
    "pair_station_daily": _dates_as_text(
        _grouped(E, '"departureDate", "trainType", "stationShortCode"', MEASURES, where=PAIR), "departureDate"
    ),
    "pair_hourly_daily": _dates_as_text(
        _grouped(E, '"departureDate", "trainType", scheduled_hour, delay_category', MEASURES, where=PAIR),
        "departureDate",
    ),
    "timetable_coverage": _dates_as_text(
        _grouped(
            E,
            '"departureDate", "trainType", "trainCategory"',
            "COUNT(*) AS events, MIN(actual_time) AS min_actual_time, MAX(actual_time) AS max_actual_time",
            source="fact",
        ),
        "departureDate",
    ),
    "station_performance": f"{L}, {STATION_FIGURES} SELECT * FROM total",
    "pair_comparison": f"""{E}, both_types AS (
        SELECT {PAIR_FIGURES} FROM ev WHERE {PAIR} GROUP BY "trainType")
      SELECT o.*, CASE WHEN o.on_time_percentage > r.on_time_percentage THEN 'Winner: Better OTP'
                       ELSE 'Behind ' || CASE o.train_type WHEN 'IC' THEN 'HDM' ELSE 'IC' END
                  END AS performance_verdict
      FROM both_types o LEFT JOIN both_types r ON o.train_type <> r.train_type""",
    "pair_by_hour": _grouped(E, '"trainType", scheduled_hour', PAIR_SHORT, where=PAIR),
    "pair_by_weekday": f"""{E} SELECT "trainType", day_of_week, {DAY_NAME} AS day_name, {PAIR_SHORT}
      FROM ev WHERE {PAIR} GROUP BY "trainType", day_of_week""",
    "pair_by_station": _grouped(E, '"trainType", "stationShortCode"', PAIR_SHORT, where=PAIR)
    + " HAVING COUNT(*) >= 10",
    "headline": f"""{E} SELECT {TRAINS} AS total_trains, COUNT(*) AS total_events, {OTP} AS otp_percentage,
      {MEAN} AS avg_delay_minutes, COUNT(DISTINCT "stationShortCode") AS stations_served FROM ev""",
    "rush_stats": f"{E} SELECT {OTP} AS morning_rush_otp FROM ev WHERE time_of_day_category = 'morning_rush'",
    "rush_verdict": f"""{E}, shares AS (
        SELECT (SELECT {OTP} FROM ev WHERE time_of_day_category = 'morning_rush') AS morning_rush_otp,
               (SELECT {OTP} FROM ev) AS otp_percentage)
      SELECT *, CASE WHEN morning_rush_otp < otp_percentage THEN 'below' ELSE 'slightly above' END AS verdict
      FROM shares""",
    "category_ranking": f"""{E} SELECT "trainCategory" AS category, {CATEGORY_FIGURES}
      FROM ev WHERE {MAIN} GROUP BY "trainCategory" """,
    "category_extremes": f"""{E}, ranked AS (
        SELECT "trainCategory" AS category, {CATEGORY_FIGURES},
          ROW_NUMBER() OVER (ORDER BY {OTP} DESC, "trainCategory") AS place
        FROM ev WHERE {MAIN} GROUP BY "trainCategory"
      ), ends AS (SELECT MAX(place) AS last FROM ranked)
      SELECT b.category AS best_category, b.on_time_percentage AS best_otp,
             w.category AS worst_category, w.on_time_percentage AS worst_otp
      FROM ranked b, ranked w, ends WHERE b.place = 1 AND w.place = ends.last""",
    "category_table": f"""{E} SELECT "trainCategory" AS train_category, {TRAINS} AS trains,
      COUNT(*) AS stops, {OTP} AS otp_percentage, {MEAN} AS avg_delay
      FROM ev WHERE {MAIN} GROUP BY "trainCategory" """,
    "data_coverage": f"""{E} SELECT COUNT(DISTINCT "departureDate") AS days_covered,
      CAST(MIN("departureDate") AS VARCHAR) AS oldest_day, CAST(MAX("departureDate") AS VARCHAR) AS newest_day
      FROM fact""",
    "data_period": f"""{E} SELECT CAST(MIN("departureDate") AS VARCHAR) AS first_day,
      CAST(MAX("departureDate") AS VARCHAR) AS last_day, COUNT(DISTINCT "departureDate") AS days_covered
      FROM fact""",
    "freshness": f"{E} SELECT strftime(MAX(actual_time), '%Y-%m-%d %H:%M') AS latest_timestamp FROM fact",
    "hourly_performance": f"{E} {_hours()}",
    "best_hour": _one_hour("DESC"),
    "worst_hour": _one_hour("ASC"),
    "period_metrics": f"{E} {_period()}",
    "period_metrics_all_time": f"{E} {_period('TRUE')}",
    "period_metrics_hdm": f"{E} SELECT * FROM ({_period()}) WHERE train_type = 'HDM'",
    "period_metrics_ic": f"{E} SELECT * FROM ({_period()}) WHERE train_type = 'IC'",
    "period_summary": f"{E} {_period()}",
    "period_complexity": f"""{E}, m AS ({_period()})
      SELECT ROUND(10.0 * i.total_trains / h.total_trains) / 10 AS train_ratio,
             ROUND(10.0 * i.stations_served / h.stations_served) / 10 AS station_ratio
      FROM m i, m h WHERE i.train_type = 'IC' AND h.train_type = 'HDM'""",
    "period_gap": f"""{E}, m AS ({_period()})
      SELECT ROUND(h.on_time_percentage - i.on_time_percentage, 2) AS otp_gap,
             ROUND(i.avg_delay_minutes - h.avg_delay_minutes, 2) AS delay_gap,
             ROUND(i.avg_delay_minutes / NULLIF(h.avg_delay_minutes, 0), 2) AS delay_multiplier
      FROM m i, m h WHERE i.train_type = 'IC' AND h.train_type = 'HDM'""",
    "period_delay_share": _shares(E, '"trainType"', "train_type", f"{PAIR} AND {RECENT}"),
    "period_hourly": f"""{E} SELECT scheduled_hour, "trainType" AS train_type, {OTP} AS otp_percentage,
      {MEAN} AS avg_delay, COUNT(*) AS events FROM ev WHERE {PAIR} AND {RECENT}
      GROUP BY scheduled_hour, "trainType" """,
    "route_station_top10": _route("HDM"),
    "route_station_top10_ic": _route("IC"),
    "station_top10_delay": f"""{L}, {STATION_FIGURES} SELECT {STATION_COLUMNS} FROM total
      ORDER BY avg_delay_minutes DESC, station_code LIMIT 10""",
    "station_top10_volume": f"""{L}, {STATION_FIGURES} SELECT {STATION_COLUMNS} FROM total
      ORDER BY total_events DESC, station_code LIMIT 10""",
    "hourly_pattern_stddev": f"""{E} SELECT scheduled_hour, COUNT(*) AS events, {OTP} AS otp_percentage,
      {MEAN} AS avg_delay, {STDDEV} AS delay_stddev FROM ev GROUP BY scheduled_hour""",
    "rush_hour": f"""{E} SELECT time_of_day_category, COUNT(*) AS events, {RUNS} AS trains,
      {OTP} AS otp_percentage, {MEAN} AS avg_delay FROM ev GROUP BY time_of_day_category""",
    "rush_insight": f"""{E} SELECT CASE
        WHEN COALESCE((SELECT {OTP} FROM ev WHERE time_of_day_category = 'morning_rush'), 0)
           > COALESCE((SELECT {OTP} FROM ev WHERE time_of_day_category = 'off_peak'), 0)
        THEN 'morning rush' ELSE 'off-peak' END AS better""",
    "weekday": f"""{E} SELECT day_of_week, {DAY_NAME} AS day_name, COUNT(*) AS events,
      {OTP} AS otp_percentage, {MEAN} AS avg_delay FROM ev GROUP BY day_of_week""",
    "weekend_by_category": f"""{E} SELECT is_weekend, "trainCategory" AS category, COUNT(*) AS events,
      {OTP} AS otp_percentage, {MEAN} AS avg_delay FROM ev GROUP BY is_weekend, "trainCategory" """,
    "weekend_summary": f"""{E} SELECT CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS period,
      COUNT(*) AS events, {RUNS} AS trains, {OTP} AS otp_percentage, {MEAN} AS avg_delay
      FROM ev GROUP BY is_weekend""",
    "weekend_pivot": f"""{E} SELECT (SELECT {OTP} FROM ev WHERE NOT is_weekend) AS weekday_otp,
      (SELECT {OTP} FROM ev WHERE is_weekend) AS weekend_otp""",
    "monthly": f"""{L} SELECT scheduled_month,
      monthname(make_date(2024, CAST(scheduled_month AS INTEGER), 1)) AS month_name,
      COUNT(*) AS events, {OTP} AS otp_percentage, {MEAN} AS avg_delay FROM ev GROUP BY scheduled_month""",
    "hourly_by_type": f"""{E} SELECT scheduled_hour, "trainType" AS train_type, {OTP} AS otp_percentage
      FROM ev WHERE "trainType" IN ('IC', 'HDM', 'S', 'P', 'HL', 'T', 'SAA', 'VET')
      GROUP BY scheduled_hour, "trainType" """,
    "best_worst_days": f"""{E}, d AS (
        SELECT day_of_week, {DAY_NAME} AS day_name, {OTP} AS otp_percentage FROM ev GROUP BY day_of_week)
      SELECT day_name, otp_percentage,
        CASE otp_percentage WHEN (SELECT MAX(otp_percentage) FROM d) THEN 'best'
                            WHEN (SELECT MIN(otp_percentage) FROM d) THEN 'worst' END AS performance
      FROM d""",
    "delay_share_by_hour": _shares(E, "scheduled_hour", "scheduled_hour"),
    "delay_trend": f"""WITH shares AS ({_shares(E, "scheduled_hour", "scheduled_hour")})
      SELECT CASE WHEN COALESCE(SUM(percentage) FILTER (WHERE scheduled_hour >= 16), 0)
                     > COALESCE(SUM(percentage) FILTER (WHERE scheduled_hour < 12), 0)
                  THEN 'accumulate' ELSE 'stable' END AS trend
      FROM shares WHERE delay_category = 'late'""",
    "category_list": f"""{E} SELECT DISTINCT "trainCategory" AS category FROM fact
      WHERE "trainCategory" IS NOT NULL""",
    "event_bounds": f"""{E} SELECT MIN(actual_time) AS actual_time FROM fact
      UNION ALL SELECT MAX(actual_time) FROM fact""",
    "rankings_range": _rankings("2024-01-05", "2024-01-20", "%", 5),
    "rankings_category": _rankings("2024-01-05", "2024-01-20", "Long%", 5),
    "rankings_single_day": _rankings("2024-01-12", "2024-01-12", "%", 1),
    "rankings_empty": _rankings("2024-01-20", "2024-01-05", "%", 1),
    "category_summary": f"""{E} SELECT "trainCategory" AS category,
      COUNT(DISTINCT "trainType") AS train_types, {RUNS} AS trains, COUNT(*) AS stops,
      {OTP} AS otp_percentage, {MEAN} AS avg_delay FROM ev GROUP BY "trainCategory" """,
    "delay_share_by_type": _shares(
        E,
        '"trainType"',
        "train_type",
        '"trainType" IN (SELECT "trainType" FROM fact GROUP BY "trainType" HAVING COUNT(*) >= 1000)',
    ),
    "top_performers": f"""{E} SELECT "trainType" AS train_type, "trainCategory" AS category, {RUNS} AS trains,
      {OTP} AS otp_percentage, {MEAN} AS avg_delay FROM ev GROUP BY ALL HAVING {RUNS} >= 50
      ORDER BY otp_percentage DESC, train_type, category LIMIT 5""",
    "consistency_median": _consistency(E),
    "consistency_median_star": _consistency(L),
    "category_versus": f"""{E} SELECT "trainCategory" AS category_group, {RUNS} AS trains, COUNT(*) AS stops,
      {OTP} AS otp_percentage, {MEAN} AS avg_delay FROM ev
      WHERE "trainCategory" IN ('Commuter', 'Long-distance') GROUP BY "trainCategory" """,
    "category_pivot": f"""{E}
      SELECT (SELECT {OTP} FROM ev WHERE "trainCategory" = 'Commuter') AS commuter_otp,
             (SELECT {OTP} FROM ev WHERE "trainCategory" = 'Long-distance') AS long_distance_otp""",
    "weekend_by_type": f"""{E} SELECT "trainType" AS train_type, is_weekend, COUNT(*) AS stops,
      {OTP} AS otp_percentage, {MEAN} AS avg_delay FROM ev
      WHERE "trainType" IN ('IC', 'HDM', 'S', 'P') GROUP BY "trainType", is_weekend""",
    "fact_by_hour": f"{E} SELECT scheduled_hour, {OTP} AS otp FROM ev GROUP BY scheduled_hour",
    "fact_rush": f"""{E} SELECT time_of_day_category, AVG(delay_minutes) AS avg_delay, COUNT(*) AS events
      FROM fact WHERE actual_time IS NOT NULL GROUP BY time_of_day_category""",
    "fact_weekend": f"""{E} SELECT is_weekend, "trainType", {MEAN} AS avg_delay
      FROM fact WHERE actual_time IS NOT NULL GROUP BY is_weekend, "trainType" """,
    "region_delay": f"""{L} SELECT region, COUNT(DISTINCT "trainNumber") AS trains, {MEAN} AS avg_delay
      FROM fact JOIN dim USING ("stationShortCode") WHERE actual_time IS NOT NULL GROUP BY region""",
    "station_label_counts": f"""WITH {DIM} SELECT station_type_label, passenger_service_label,
      COUNT(*) AS station_count FROM dim GROUP BY ALL""",
    "station_list": f"""WITH {DIM} SELECT "stationName", latitude, longitude, region, passenger_service_label
      FROM dim WHERE "passengerTraffic" """,
    "station_star": f"""{L} SELECT "stationName", region, "trainType", COUNT(*) AS events,
      AVG(delay_minutes) AS avg_delay FROM fact JOIN dim USING ("stationShortCode") GROUP BY ALL""",
    "dedup_latest_version": """
      SELECT DISTINCT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity
      FROM lineitem a WHERE NOT EXISTS (
        SELECT 1 FROM lineitem b WHERE b.l_orderkey = a.l_orderkey AND b.l_linenumber = a.l_linenumber
          AND (b.l_partkey, b.l_suppkey, b.l_quantity) > (a.l_partkey, a.l_suppkey, a.l_quantity))""",
    "surrogate_key": f"""WITH {EVENT_ROWS}, k AS (
        SELECT event_id, CAST("trainNumber" AS VARCHAR) AS a, CAST("departureDate" AS VARCHAR) AS b,
          COALESCE("stationShortCode", '_dbt_utils_surrogate_key_null_') AS c,
          COALESCE("trainType", '_dbt_utils_surrogate_key_null_') AS d, event_type AS e FROM rows_e)
      SELECT event_id, md5(c) AS sk_station, md5(a || '-' || b || '-' || c || '-' || d || '-' || e) AS sk_event
      FROM k""",
    "json_field_filter": """
      WITH p AS (SELECT event_type, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k FROM events)
      SELECT event_type, COUNT(*) AS n, MAX(k) AS max_k FROM p WHERE k >= 50 GROUP BY event_type""",
    "nest_unnest_roundtrip": f"""{N} SELECT "trainType", event_type, COUNT(*) AS events, {TRAINS} AS trains,
      MIN(scheduled_time) AS first_scheduled, MAX(actual_time) AS last_actual,
      CAST(SUM(delay_minutes) AS BIGINT) AS delay_sum FROM fact GROUP BY "trainType", event_type""",
    "trains_at_station": f"""{N_TRAINS} SELECT {DEPARTURE_TEXT}, COUNT(*) AS trains FROM trains
      WHERE block IN (SELECT event_id // 64 FROM rows_e WHERE "stationShortCode" = '42')
      GROUP BY "departureDate" """,
    "raw_train_statistics": f"""{N_TRAINS} SELECT "trainType", COUNT(DISTINCT block) AS trains,
      COUNT(DISTINCT block) FILTER (WHERE cancelled) AS cancelled, COUNT(*) AS timetable_rows
      FROM trains JOIN events ON event_id // 64 = block GROUP BY "trainType" """,
    "built_from_landing": _scopes(N),
    "streamed_from_landing": f"""{N_TRAINS} SELECT {DEPARTURE_TEXT}, COUNT(DISTINCT block) AS trains,
      COUNT(*) AS timetable_rows FROM trains JOIN events ON event_id // 64 = block GROUP BY "departureDate" """,
    "reload_idempotent": _day_counts("TRUE"),
    "retention_delete": _day_counts(""" "departureDate" >= DATE '2024-01-11' """),
    "schema_append": f"""WITH {EVENT_ROWS} SELECT {DEPARTURE_TEXT}, COUNT(*) AS events,
      COUNT(delay_minutes) FILTER (WHERE "departureDate" >= DATE '2024-01-22') AS with_band
      FROM rows_e GROUP BY "departureDate" """,
    "quarantine_split": """SELECT event_type, COUNT(*) AS events, CAST(SUM(event_id) AS BIGINT) AS id_sum,
      MAX(value) AS max_value FROM events WHERE NOT (event_type = 'error' AND day(ts) % 2 = 1)
      GROUP BY event_type""",
    "load_record": f"""WITH {EVENT_ROWS} SELECT '2024-01-01' AS start_date, '2024-01-31' AS end_date,
      CAST(31 AS BIGINT) AS days_requested, COUNT(DISTINCT "departureDate") AS days_loaded,
      COUNT(*) AS total_trains, CAST(NULL AS VARCHAR) AS station_filter, TRUE AS compress FROM rows_e""",
    "coverage_record": f"""WITH {EVENT_ROWS} SELECT CAST(MIN("departureDate") AS VARCHAR) AS data_from,
      CAST(MAX("departureDate") AS VARCHAR) AS data_through, COUNT(DISTINCT "departureDate") AS days
      FROM rows_e""",
    "missing_days": """
      SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS "departureDate"
      FROM generate_series(DATE '1991-12-01', DATE '1999-12-31', INTERVAL 1 DAY) AS g(d)
      WHERE CAST(d AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)""",
    "dq_report": _data_tests(),
    "dq_references": f"""WITH {EVENT_ROWS}, {DIM}, f AS (
        SELECT COUNT(*) AS failures FROM rows_e WHERE "stationShortCode" IS NOT NULL
          AND "stationShortCode" NOT IN (
            SELECT CASE WHEN "passengerTraffic" THEN '' ELSE 'closed-' END || "stationShortCode" FROM dim))
      SELECT 'events' AS table_name, 'references(stationShortCode, dim_stations)' AS test,
        'warn' AS severity, failures, failures = 0 AS passed FROM f""",
    "file_stats": """SELECT 'ship_year=' || year(l_shipdate) AS partition_key,
      CAST(MIN(CAST(l_shipdate AS DATE)) AS VARCHAR) AS min_value,
      CAST(MAX(CAST(l_shipdate AS DATE)) AS VARCHAR) AS max_value,
      CAST(0 AS BIGINT) AS null_count, COUNT(*) AS row_count FROM lineitem GROUP BY year(l_shipdate)""",
    "pruned_read": """SELECT CAST(year(l_shipdate) AS BIGINT) AS ship_year,
      CAST(l_linenumber AS BIGINT) AS l_linenumber, COUNT(*) AS n, SUM(l_quantity) AS quantity FROM lineitem
      WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1997-09-30' GROUP BY ALL""",
    "snapshot_read": """
      SELECT CAST(1 AS BIGINT) AS snapshot, COUNT(*) AS n, SUM(l_quantity) AS quantity
      FROM lineitem WHERE l_orderkey % 2 = 0
      UNION ALL SELECT CAST(2 AS BIGINT), COUNT(*), SUM(l_quantity) FROM lineitem""",
    "lake_cold_days": f"""WITH {WEATHER} SELECT CAST(date AS VARCHAR) AS date, * EXCLUDE (date)
      FROM weather WHERE temperature_c < 0""",
    "lake_archive_summary": f"WITH {ARCHIVE} {SUMMARY}",
    "lake_weather_incidents": f"""WITH {INCIDENTS} SELECT incident_id, CAST(date AS VARCHAR) AS date,
      'storm' AS subcategory, delay_minutes, affected_trains, delay_minutes * 3 AS total_delay_minutes
      FROM incidents WHERE weather_related ORDER BY total_delay_minutes DESC, incident_id LIMIT 10""",
    "lake_join_csv_parquet": f"""WITH {WEATHER}, {ARCHIVE}
      SELECT CAST(date AS VARCHAR) AS date, city, COUNT(*) AS n, MAX(temperature_c) AS temperature_c,
        MAX(temp_avg_c) AS max_archive
      FROM weather JOIN archive USING (date) WHERE station_code = 'HKI' GROUP BY ALL""",
    "lake_temperature_anomaly": f"""WITH {WEATHER}, {ARCHIVE}, normal AS (
        SELECT dayofyear(date) AS d, AVG(temp_avg_c) AS normal_c FROM archive
        WHERE station_code = 'HKI' GROUP BY dayofyear(date))
      SELECT CAST(date AS VARCHAR) AS date, city, temperature_c, ROUND(normal_c, 2) AS normal_c,
        ROUND(temperature_c - normal_c, 2) AS anomaly_c
      FROM weather JOIN normal ON dayofyear(date) = d""",
    "lake_incident_share": f"""WITH {INCIDENTS} SELECT incident_id, station, n_name AS route_name, delay_minutes,
      CAST(n_nationkey * 5 + 60 AS BIGINT) AS typical_duration_min,
      ROUND(100.0 * delay_minutes / (n_nationkey * 5 + 60), 2) AS delay_share
      FROM incidents JOIN nation ON station = CAST(n_nationkey AS VARCHAR)""",
    "lake_weather_punctuality": f"""{E}, {WEATHER}, {PER_DAY}, f AS (
        SELECT "departureDate" AS date, COUNT(*) AS events, {OTP} AS otp_percentage, {MEAN} AS avg_delay
        FROM ev GROUP BY "departureDate")
      SELECT CAST(date AS VARCHAR) AS date, ROUND(temperature_c, 2) AS temperature_c, precipitation_mm,
        events, otp_percentage, avg_delay FROM weather_days JOIN f USING (date)""",
    "lake_weather_impact": f"""{E}, {WEATHER}, {PER_DAY}, classed AS (
        SELECT date, CASE WHEN snow_depth_cm > 5 THEN 'snow' WHEN precipitation_mm > 5 THEN 'rain'
          WHEN wind_speed_kmh > 25 THEN 'wind' WHEN temperature_c < 0 THEN 'cold'
          ELSE 'normal' END AS weather_class FROM weather_days)
      SELECT weather_class, COUNT(DISTINCT date) AS days, COUNT(*) AS events, {OTP} AS otp_percentage,
        {MEAN} AS avg_delay FROM ev JOIN classed ON "departureDate" = date GROUP BY weather_class""",
    "lake_station_attributes": f"""{L}, {STATION_FIGURES}, attributes AS (
        SELECT CASE s_suppkey % 3 WHEN 0 THEN 'old-' ELSE '' END || s_suppkey AS station_code, s_suppkey * 1000 + 5000 AS population_nearby,
          s_suppkey % 9 + 1 AS platforms FROM supplier)
      SELECT total.* EXCLUDE (latitude, longitude), population_nearby, platforms,
        ROUND(total_events * 1000.0 / population_nearby, 2) AS events_per_thousand
      FROM total LEFT JOIN attributes USING (station_code)""",
    "lake_incident_events": f"""{E}, {INCIDENTS}, recorded AS (
        SELECT "trainNumber", "stationShortCode", "departureDate", COUNT(*) AS events,
          MAX(delay_minutes) AS max_recorded_delay FROM fact GROUP BY ALL)
      SELECT incident_id, "trainNumber", "stationShortCode", {DEPARTURE_TEXT},
        CASE WHEN weather_related THEN 'weather' ELSE 'technical' END AS category,
        i.delay_minutes AS reported_delay, events, max_recorded_delay
      FROM incidents i JOIN recorded r
        ON train_number = "trainNumber" AND station = "stationShortCode" AND date = "departureDate" """,
    "lake_monthly_weather": f"""WITH {WEATHER} SELECT city, CAST(year(date) AS BIGINT) AS year,
      CAST(month(date) AS BIGINT) AS month, COUNT(*) AS days, ROUND(AVG(temperature_c), 2) AS avg_temp,
      MIN(temperature_c) AS min_temp, MAX(temperature_c) AS max_temp FROM weather GROUP BY ALL""",
    "lake_format_parity": f"""WITH {ARCHIVE}, s AS ({SUMMARY})
      SELECT *, 'csv' AS source FROM s UNION ALL SELECT *, 'parquet' FROM s""",
    "lake_check_counts": f"""WITH {WEATHER}, {INCIDENTS}
      SELECT 'weather_rows' AS check, COUNT(*) AS value FROM weather
      UNION ALL SELECT 'weather_cities', COUNT(DISTINCT city) FROM weather
      UNION ALL SELECT 'archive_rows', COUNT(*) FROM orders
      UNION ALL SELECT 'incident_rows', COUNT(*) FROM incidents""",
}

# stored roll-ups give what those over events give
ORACLE |= {
    f"stored_{name}": ORACLE[name]
    for name in (
        "otp_by_scope pair_comparison daily_performance hourly_delay_categories delay_histogram train_spans "
        "station_presence pair_station_daily pair_hourly_daily timetable_coverage headline rush_hour "
        "weekend_summary period_metrics rankings_range consistency_median"
    ).split()
}
ORACLE["stored_station_performance"] = f"{E_DIM}, {STATION_FIGURES} SELECT * FROM total"
ORACLE["gold_reload"] = f"""{E} SELECT CAST("departureDate" AS VARCHAR) AS "departureDate", COUNT(*) AS events
FROM fact GROUP BY ALL"""

# manifest: one file for each year and batch
ORACLE["snapshot_log"] = """WITH held AS (
    SELECT l_orderkey % 3 + 1 AS batch, year(l_shipdate) AS y, COUNT(*) AS n FROM lineitem GROUP BY ALL)
  SELECT CAST(number AS BIGINT) AS number, 'INSERT' AS operation, COUNT(*) AS files, CAST(SUM(n) AS BIGINT) AS rows
  FROM held JOIN (VALUES (1), (2), (3)) AS numbers(number) ON batch <= number GROUP BY number
  UNION ALL SELECT 4, 'DELETE', COUNT(*), CAST(SUM(n) AS BIGINT) FROM held WHERE y <> 1996"""
ORACLE["rewritten_file_read"] = """SELECT CAST(l_linenumber AS BIGINT) AS l_linenumber, COUNT(*) AS n,
    CAST(MAX(CAST(l_shipdate AS DATE) + INTERVAL 10 YEAR)::DATE AS VARCHAR) AS last_day
  FROM lineitem WHERE year(l_shipdate) = 1997 GROUP BY ALL"""
ORACLE["time_zone_read"] = """SELECT event_type, COUNT(*) AS n, MAX(event_id) AS last_id FROM events
  WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-06 00:00:00' GROUP BY ALL"""

# raw day files: odd days plain, even days gzipped
ORACLE["day_files_unnested"] = ORACLE["nest_unnest_roundtrip"]
ORACLE["day_files_streamed"] = ORACLE["streamed_from_landing"]
ORACLE["lake_incident_arrays"] = ORACLE["lake_weather_incidents"]
ORACLE["day_files_window"] = f"""{N_TRAINS} SELECT {DEPARTURE_TEXT}, COUNT(*) AS trains,
    strftime("departureDate", 'train_departure_date/%Y/%m/%Y-%m-%d.json')
      || CASE WHEN day("departureDate") % 2 = 0 THEN '.gz' ELSE '' END AS _source_file
  FROM trains WHERE "departureDate" >= DATE '2024-01-22' GROUP BY "departureDate" """
ORACLE["day_files_versions"] = f"""{N_TRAINS} SELECT {DEPARTURE_TEXT}, COUNT(*) AS trains,
    CAST(2 - day("departureDate") % 2 AS BIGINT) AS version,
    COUNT(*) FILTER (WHERE cancelled AND day("departureDate") % 2 = 1) AS cancelled
  FROM trains GROUP BY "departureDate" """
ORACLE["station_dimension"] = """SELECT
    CASE s_suppkey % 3 WHEN 0 THEN 'Major Station' WHEN 1 THEN 'Stopping Point' ELSE 'Turnout' END AS station_type_label,
    CASE WHEN s_acctbal > 0 THEN 'Passenger Service' ELSE 'No Passenger Service' END AS passenger_service_label,
    CASE s_suppkey % 4 WHEN 0 THEN 'Helsinki Region' WHEN 1 THEN 'Tampere Region' ELSE 'Other Region' END AS region,
    COUNT(*) AS stations,
    COUNT(DISTINCT CASE s_suppkey % 4 WHEN 0 THEN 'HKI' WHEN 1 THEN 'TPE' ELSE CAST(s_suppkey AS VARCHAR) END) AS codes,
    MAX(60 + s_nationkey / 10) AS north
  FROM supplier GROUP BY ALL"""


def _more_data_tests() -> str:
    """One SELECT per declared test of four more roll-ups."""
    station = ["departureDate", "trainType", "stationShortCode"]
    hour = ["departureDate", "trainType", "scheduled_hour", "delay_category"]
    coverage = ["departureDate", "trainType", "trainCategory"]
    category = ["scheduled_hour", "trainType", "trainCategory", "delay_category"]
    names = lambda columns: ", ".join(f'"{c}"' for c in columns)
    labels = "delay_category NOT IN ('early', 'on_time', 'slightly_late', 'late', 'very_late', 'unknown')"
    times = "time_of_day_category NOT IN ('morning_rush', 'off_peak', 'evening_rush')"
    agree, other = "on_time_events <= events AND delay_count <= events", """ "trainType" NOT IN ('IC', 'HDM')"""
    tables = f"""{E}, by_station AS (SELECT {names(station)}, {MEASURES} FROM ev WHERE {PAIR} GROUP BY ALL),
      by_hour AS (SELECT {names(hour)}, {MEASURES} FROM ev WHERE {PAIR} GROUP BY ALL),
      coverage AS (SELECT {names(coverage)}, COUNT(*) AS events FROM fact GROUP BY ALL),
      hours AS (SELECT {names(category)}, time_of_day_category, {MEASURES} FROM ev GROUP BY ALL)"""
    unique = lambda table, source, keys: _test_repeated(table, source, f"unique_combination({', '.join(keys)})", names(keys))
    tests = [
        *_test_nulls("pair_station_daily", "by_station", ["departureDate", "trainType"]),
        *_test_nulls("pair_station_daily", "by_station", ["stationShortCode"], "warn"),
        _test_bad("pair_station_daily", "by_station", "accepted_values(trainType)", other),
        unique("pair_station_daily", "by_station", station),
        *_test_nulls("pair_hourly_daily", "by_hour", ["departureDate", "trainType", "delay_category"]),
        _test_bad("pair_hourly_daily", "by_hour", "accepted_values(trainType)", other),
        _test_bad("pair_hourly_daily", "by_hour", "accepted_values(delay_category)", labels),
        unique("pair_hourly_daily", "by_hour", hour),
        *_test_nulls("timetable_coverage", "coverage", ["departureDate", "events"]),
        unique("timetable_coverage", "coverage", coverage),
        *_test_nulls("hourly_delay_categories", "hours", ["time_of_day_category", "delay_category", "events"]),
        *_test_nulls("hourly_delay_categories", "hours", ["scheduled_hour", "trainType", "trainCategory"], "warn"),
        _test_bad("hourly_delay_categories", "hours", "accepted_values(time_of_day_category)", times),
        _test_bad("hourly_delay_categories", "hours", "accepted_values(delay_category)", labels),
        _test_bad("hourly_delay_categories", "hours", f"expression({agree})", f"NOT ({agree})"),
        unique("hourly_delay_categories", "hours", category),
    ]
    return f"{tables} " + " UNION ALL ".join(tests)


ORACLE["dq_more"] = _more_data_tests()
ORACLE["dq_unnested"] = f"{N} " + " UNION ALL ".join(
    _test_bad("timetable_unnested", "fact", f"not_null({name})", f'"{column}" IS NULL')
    for name, column in (
        *((c, c) for c in ("trainNumber", "departureDate", "stationShortCode")),
        ("scheduledTime", "scheduled_time"),
    )
)


def _other_data_tests() -> str:
    """One SELECT per declared test of trains, stations, their dimension and four roll-ups."""
    code = "CASE s_suppkey % 4 WHEN 0 THEN 'HKI' WHEN 1 THEN 'TPE' ELSE CAST(s_suppkey AS VARCHAR) END"
    tables = f"""{E}, {DIM}, loaded AS (
      SELECT {code} AS "stationShortCode", s_name AS "stationName", s_suppkey AS "stationUICCode",
        s_nationkey AS latitude, s_nationkey AS longitude, s_acctbal > 0 AS "passengerTraffic",
        s_suppkey % 3 AS type, 'FI' AS "countryCode" FROM supplier
    ), trains AS (
      SELECT event_id // 64 AS "trainNumber", MIN(CAST(ts AS DATE)) AS "departureDate" FROM events GROUP BY 1
    ), performance AS (
      SELECT "stationShortCode" AS station_code FROM ev JOIN dim USING ("stationShortCode") GROUP BY ALL
    ), scopes AS ({ORACLE["otp_by_scope"]}), pairs AS ({ORACLE["pair_comparison"]}), presence AS ({ORACLE["station_presence"]})"""
    bad, repeated, nulls = _test_bad, _test_repeated, _test_nulls
    metadata = ["_loaded_at", "_source_file", "_run_id"]
    none = lambda table, tests, severity="error": [_test_row(table, t, "SELECT 0", severity) for t in tests]
    station = ["stationShortCode", "stationName", "stationUICCode", "latitude", "longitude"]
    presence = ["trainType", "trainCategory", "stationShortCode", "first_actual_bucket"]
    order = "first_actual_bucket <= last_actual_bucket"
    presence_key = ", ".join(f'"{c}"' for c in presence)
    tests = [
        *nulls("stations", "loaded", [*station, "passengerTraffic", "type", "countryCode"]),
        *none("stations", [*(f"not_null({c})" for c in metadata), "accepted_values(type)"]),
        *none("stations", ["accepted_values(countryCode)"], "warn"),
        repeated("stations", "loaded", "unique(stationShortCode)", '"stationShortCode"'),
        repeated("stations", "loaded", "unique(stationUICCode)", '"stationUICCode"').replace("'error'", "'warn'"),
        *none("dim_stations", ["not_null(sk_station)"]),
        *nulls("dim_stations", "loaded", ["stationShortCode"]),
        repeated("dim_stations", "loaded", "unique(sk_station)", '"stationShortCode"'),
        repeated("dim_stations", "loaded", "unique(stationShortCode)", '"stationShortCode"'),
        *nulls("train_departures", "trains", ["trainNumber", "departureDate"]),
        *none("train_departures", [f"not_null({c})" for c in ("operatorShortCode", "trainType", "trainCategory")]),
        *none("train_departures", [f"not_null({c})" for c in ("cancelled", *metadata)]),
        *none("train_departures", ["accepted_values(trainCategory)"], "warn"),
        repeated("train_departures", "trains", "unique_combination(trainNumber, departureDate)", '"trainNumber", "departureDate"'),
        *nulls("on_time_performance", "scopes", ["metric_scope"]),  # events without a type have a scope too
        *nulls("pair_comparison", "pairs", ["train_type", "on_time_percentage", "performance_verdict"]),
        bad("pair_comparison", "pairs", "accepted_values(train_type)", "train_type NOT IN ('IC', 'HDM')"),
        *nulls("station_performance", "performance", ["station_code"]),
        repeated("station_performance", "performance", "unique(station_code)", "station_code"),
        *nulls("station_presence", "presence", ["first_actual_bucket", "midnight_days"]),
        *nulls("station_presence", "presence", ["trainType", "trainCategory", "stationShortCode"], "warn"),
        bad("station_presence", "presence", f"expression({order})", f"NOT ({order})"),
        repeated("station_presence", "presence", f"unique_combination({', '.join(presence)})", presence_key),
    ]
    return f"{tables} " + " UNION ALL ".join(tests)


ORACLE["dq_others"] = _other_data_tests()
ORACLE["dq_by_day"] = f"""
  SELECT * FROM ({ORACLE["dq_report"]}) WHERE table_name IN ('fact_timetable_events', 'train_spans')
  UNION ALL SELECT * FROM ({ORACLE["dq_more"]}) WHERE table_name <> 'hourly_delay_categories'
  UNION ALL SELECT 'fact_timetable_events', * EXCLUDE (table_name) FROM ({ORACLE["dq_references"]})"""
