import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from punctual import schemas
from punctual.plans import lake_queries
from punctual.sources import lake

TYPES = {"date": "date", "city": "string", "temperature_c": "double", "conditions": "string"}


def test_csv_files_are_aligned_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("date,city,temperature_c\n2024-01-01,Helsinki,-3.5\n2024-01-02,Helsinki,1.0\n")
    (tmp_path / "b.csv").write_text('"temperature_c","city","extra","date"\n4.5,Tampere,z,2024-01-01\n')
    (tmp_path / "c.csv").write_text("date,city,temperature_c\n")
    weather = lake.read_csv_by_name(spark, f"{tmp_path}/*.csv", TYPES)
    assert weather.columns == ["date", "city", "temperature_c"]
    got = sorted(tuple(r) for r in weather.collect())
    assert got == [
        (dt.date(2024, 1, 1), "Helsinki", -3.5),
        (dt.date(2024, 1, 1), "Tampere", 4.5),
        (dt.date(2024, 1, 2), "Helsinki", 1.0),
    ]
    assert [r.city for r in lake_queries.cold_days(weather).collect()] == ["Helsinki"]


def test_a_quoted_comma_in_a_column_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"wind, max",city\n7.5,Oulu\n')
    (tmp_path / "b.csv").write_text('city,"wind, max"\nTurku,3.5\n')
    got = lake.read_csv_by_name(spark, f"{tmp_path}/*.csv", {"city": "string", "wind, max": "double"})
    assert sorted(tuple(r) for r in got.collect()) == [("Oulu", 7.5), ("Turku", 3.5)]


def test_of_a_header_only_its_first_bytes_are_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n" + "1,2\n" * 500_000)
    jvm = spark.sparkContext._jvm
    read = lambda: sum(s.getBytesRead() for s in jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())
    before = read()
    assert lake._headers(spark, f"{tmp_path}/*.csv") == {"x,y": [f"file:{tmp_path}/a.csv"]}
    assert read() - before < 100_000


def test_large_csv_files_have_one_header_each(spark, tmp_path):
    """A file read in several blocks still has one header."""
    for name, header, row in (("a", "x,y", "{0},1"), ("b", "y,x", "2,{0}")):
        body = "\n".join(row.format(i) for i in range(3000))
        (tmp_path / f"{name}.csv").write_text(f"{header}\n{body}\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        got = lake.read_csv_by_name(spark, f"{tmp_path}/*.csv", {"x": "int", "y": "int"}).groupBy("y").agg(F.sum("x"))
        assert {tuple(r) for r in got.collect()} == {(1, 4498500), (2, 4498500)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_with_a_wrong_header_raises(spark, tmp_path):
    (tmp_path / "a.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="CSV header|header"):
        lake.read_csv(spark, str(tmp_path), "a int, b int").collect()


def test_no_csv_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        lake.read_csv_by_name(spark, f"{tmp_path}/*.csv", TYPES)


def test_inferred_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,x\n")
    assert lake.read_csv(spark, str(tmp_path / "a.csv")).dtypes == [("a", "int"), ("b", "string")]


@pytest.mark.parametrize("schema", [None, schemas.INCIDENT])
def test_nested_json(spark, tmp_path, schema):
    incident = {
        "incident_id": "I-1",
        "date": "2024-01-01",
        "train_number": 42,
        "station": "HKI",
        "delay_minutes": 30,
        "subcategory": "storm",
        "weather_related": True,
        "impact": {"affected_trains": 3, "total_delay_minutes": 90},
    }
    path = tmp_path / "incidents.json"
    path.write_text(json.dumps([incident, incident | {"incident_id": "I-2", "weather_related": False}], indent=2))
    incidents = lake.read_json_array(spark, str(path), schema)
    got = lake_queries.weather_incidents(incidents).collect()
    assert [(r.incident_id, r.total_delay_minutes) for r in got] == [("I-1", 90)]


def test_formats_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    lake.write_csv(df, f"{tmp_path}/csv")
    lake.write_parquet(df, f"{tmp_path}/parquet")
    lake.write_json(df, f"{tmp_path}/json")
    rows = {(1, "a"), (2, None)}
    assert {tuple(r) for r in lake.read_csv(spark, f"{tmp_path}/csv", "n int, s string").collect()} == rows
    assert {tuple(r) for r in lake.read_parquet(spark, f"{tmp_path}/parquet").collect()} == rows
    assert {tuple(r) for r in spark.read.schema("n int, s string").json(f"{tmp_path}/json").collect()} == rows
    assert any(f.name.endswith(".snappy.parquet") for f in (tmp_path / "parquet").iterdir())


def test_text_dates_join(spark):
    weather = spark.createDataFrame([("2024-01-01", "Helsinki", 2.0)], "date string, city string, temperature_c double")
    archive = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "HKI", 1.5), (dt.date(2024, 1, 1), "TPE", 9.0)],
        "date date, station_code string, temp_avg_c double",
    )
    got = lake_queries.same_day_rows(weather, archive, "HKI").collect()
    assert [(r.station_code, r.temp_avg_c) for r in got] == [("HKI", 1.5)]
