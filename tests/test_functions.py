import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from punctual import functions as fn


def rows(spark, values, kind, **columns):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [tuple(r)[1:] for r in df.select("v", *[c.alias(n) for n, c in columns.items()]).collect()]


def test_delay_borders(spark):
    delays = [None, -1, 0, 5, 6, 15, 16, 30, 31]
    got = rows(spark, delays, "bigint", on=fn.is_on_time("v"), cat=fn.delay_category("v"))
    assert got == [
        (None, "unknown"),
        (True, "early"),
        (True, "on_time"),
        (True, "on_time"),
        (False, "slightly_late"),
        (False, "slightly_late"),
        (False, "late"),
        (False, "late"),
        (False, "very_late"),
    ]


def test_rush_hours(spark):
    got = rows(spark, [5, 6, 9, 10, 15, 16, 19, 20, None], "int", c=fn.time_of_day_category("v"))
    off, am, pm = "off_peak", "morning_rush", "evening_rush"
    assert [g[0] for g in got] == [off, am, am, off, off, pm, pm, off, off]


def test_week(spark):
    days = [dt.datetime(2024, 1, d, 10) for d in (5, 6, 7, 8)]  # Friday to Monday
    dow = fn.day_of_week("v")
    got = rows(spark, days, "timestamp_ntz", dow=dow, name=fn.day_name("(dayofweek(v) - 1)"), weekend=fn.is_weekend("(dayofweek(v) - 1)"))
    assert got == [(5, "Friday", False), (6, "Saturday", True), (0, "Sunday", True), (1, "Monday", False)]


def test_month_names(spark):
    got = rows(spark, [1, 12, 13, None], "int", name=fn.month_name("v"))
    assert [g[0] for g in got] == ["January", "December", None, None]


def test_buckets(spark):
    stamps = [
        dt.datetime(2024, 1, 1),
        dt.datetime(2024, 1, 1, 0, 0, 0, 1),
        dt.datetime(2024, 1, 1, 23, 59, 59, 999000),
        None,
    ]
    got = rows(spark, stamps, "timestamp_ntz", b=fn.actual_bucket("v"), m=fn.midnight_day("v"))
    noon = dt.datetime(2024, 1, 1, 12)
    assert got == [(dt.datetime(2024, 1, 1), "2024-01-01"), (noon, None), (noon, None), (None, None)]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Helsinki", "America/New_York"])
def test_buckets_do_not_depend_on_the_session_zone(spark, zone):
    # 03:30 does not exist in Helsinki on that day, 02:30 not in New York on the other
    stamps = [dt.datetime(2024, 3, 31, 3, 30), dt.datetime(2024, 3, 10, 2, 30)]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        columns = {"b": fn.actual_bucket("v"), "h": F.hour("v"), "d": fn.day_of_week("v")}
        got = rows(spark, stamps, "timestamp_ntz", **columns)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [(dt.datetime(2024, 3, 31, 12), 3, 0), (dt.datetime(2024, 3, 10, 12), 2, 0)]


def test_parse_event_time(spark):
    got = rows(spark, ["2024-01-02T03:04:05.678Z", None], "string", t=fn.parse_event_time("v"))
    assert got == [(dt.datetime(2024, 1, 2, 3, 4, 5, 678000),), (None,)]


@pytest.mark.parametrize("text", ["2024-01-02T03:04:05Z", "yesterday", "2024-01-02T03:04:05.678+02:00"])
def test_malformed_event_time_raises(spark, text):
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|parse"):
        rows(spark, [text], "string", t=fn.parse_event_time("v"))


def test_round2_on_ties(spark):
    got = rows(spark, [1.005, 0.285, 2.5, -1.005, None], "double", r=fn.round2("v"))
    assert [g[0] for g in got] == [1.0, 0.28, 2.5, -1.0, None]


def test_surrogate_key(spark):
    df = spark.createDataFrame([(1, "a", dt.date(2024, 1, 1)), (1, None, None), (1, "", None)], "n int, s string, d date")
    got = [r.k for r in df.select(fn.surrogate_key("n", "s", "d").alias("k")).collect()]
    null = "_dbt_utils_surrogate_key_null_"
    texts = ["1-a-2024-01-01", f"1-{null}-{null}", f"1--{null}"]
    assert got == [hashlib.md5(t.encode()).hexdigest() for t in texts]


def test_stddev_needs_two_delays(spark):
    df = spark.createDataFrame(
        [(0, None, None), (1, 5, 25), (3, 15, 75), (2, 4, 10)], "delay_count bigint, delay_sum bigint, delay_sumsq bigint"
    )
    got = [r[0] for r in df.select(fn.delay_stddev()).collect()]
    assert got == [None, None, 0.0, 1.41]


def test_ratio_by_zero_is_null(spark):
    assert rows(spark, [0], "bigint", r=fn.percentage("v", "v")) == [(None,)]
