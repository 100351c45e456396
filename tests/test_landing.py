import datetime as dt
import gzip

import pytest
from builders import timetable_row, train
from pyspark.sql import functions as F

from punctual.plans import bronze, silver
from punctual.sources import day_files, landing

DAY = dt.date(2024, 1, 5)
NOON = dt.datetime(2024, 1, 5, 12)
ROWS = [timetable_row("HKI", "DEPARTURE", NOON), timetable_row("TPE", "ARRIVAL", NOON + dt.timedelta(hours=2), 4)]


def next_day(n):
    return DAY + dt.timedelta(days=n)


def numbers(df):
    return sorted(r.trainNumber for r in df.select("trainNumber").collect())


def test_plain_and_gzip_files_with_unknown_and_missing_keys(spark, staging):
    staging.write(DAY, [train(1, DAY, ROWS, newField={"a": 1}), train(2, DAY, None)])
    short = train(3, next_day(1), [{"stationShortCode": "HKI", "novel": True}])
    del short["operatorUICCode"]
    staging.write(next_day(1), [short], compress=True)
    got = {r.trainNumber: r for r in day_files.read_trains(spark, str(staging.root)).collect()}
    assert got.keys() == {1, 2, 3}
    assert got[2].timeTableRows is None and got[3].operatorUICCode is None
    assert got[3].timeTableRows[0].stationShortCode == "HKI" and got[3].timeTableRows[0].causes is None
    assert got[3]["_path"].endswith("train_departure_date/2024/01/2024-01-06.json.gz")


def test_nested_causes(spark, staging):
    cause = {"categoryCode": "K", "categoryCodeId": 7, "thirdCategoryCode": None}
    staging.write(DAY, [train(1, DAY, [timetable_row("HKI", "ARRIVAL", NOON, 9, causes=[cause])])])
    row = day_files.read_trains(spark, str(staging.root)).select(F.explode("timeTableRows").alias("r")).head().r
    assert (row.causes[0].categoryCode, row.causes[0].categoryCodeId) == ("K", 7)


def test_window_opens_only_the_files_it_needs(spark, staging):
    staging.path(next_day(-30)).write_text('[{"trainNumber": 9', encoding="utf-8")  # cut off, too old
    for n in range(3):
        staging.write(next_day(n), [train(n, next_day(n), ROWS)])
    staging.path(next_day(2), ".json.tmp").write_text("half", encoding="utf-8")
    root = str(staging.root)
    assert numbers(day_files.read_trains(spark, root, since=next_day(1))) == [1, 2]
    assert numbers(day_files.read_trains(spark, root, since=next_day(9))) == []
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED"):
        day_files.read_trains(spark, root).collect()


def test_other_names_are_not_day_files(spark, staging):
    staging.write(DAY, [train(1, DAY, ROWS)])
    staging.path(DAY, "_HKI.json").write_text("[]", encoding="utf-8")
    staging.path(DAY).with_name("2024-13-45.json").write_text("[]", encoding="utf-8")
    listing = landing.list_day_files(spark, str(staging.root))
    assert sorted((r.name, r.day) for r in listing.collect()) == [("2024-01-05.json", DAY), ("2024-13-45.json", None)]
    assert numbers(day_files.read_trains(spark, str(staging.root))) == [1]


def test_no_input(spark, staging):
    with pytest.raises(day_files.NoInputError):
        day_files.read_trains(spark, str(staging.root))
    assert day_files.read_trains(spark, str(staging.root), since=DAY).count() == 0


def test_highest_version_then_last_file_wins(spark, staging):
    staging.write(DAY, [train(1, DAY, [], version=1), train(2, DAY, [], version=5), train(3, DAY, [], version=None)])
    later = next_day(1)
    again = [train(1, DAY, ROWS, version=2), train(2, DAY, ROWS, version=5), train(3, DAY, ROWS, version=0)]
    staging.write(later, [*again, train(1, later, [], version=1)], compress=True)
    got = bronze.train_departures(day_files.read_trains(spark, str(staging.root)), "run-1").collect()
    assert sorted((r.trainNumber, r.departureDate, r.version, len(r.timeTableRows)) for r in got) == [
        (1, DAY, 2, 2),
        (1, later, 1, 0),
        (2, DAY, 5, 2),
        (3, DAY, 0, 2),
    ]
    assert {r["_source_file"] for r in got} == {"train_departure_date/2024/01/2024-01-06.json.gz"}
    assert {r["_run_id"] for r in got} == {"run-1"} and all(r["_loaded_at"] for r in got)


def test_unnest(spark, staging):
    unscheduled = timetable_row("JY", "ARRIVAL", NOON)
    del unscheduled["scheduledTime"]
    trains = [
        train(1, DAY, [*ROWS, unscheduled]),
        train(2, DAY, ROWS, cancelled=True),
        train(3, DAY, ROWS, cancelled=None),
        train(4, DAY, []),
        train(5, DAY, None),
    ]
    staging.write(DAY, trains)
    loaded = bronze.train_departures(day_files.read_trains(spark, str(staging.root)), "r")
    fact = silver.fact_timetable_events(silver.timetable_unnested(loaded))
    got = fact.orderBy("scheduled_time").collect()
    assert [(r.trainNumber, r.stationShortCode, r.event_type, r.delay_minutes) for r in got] == [
        (1, "HKI", "DEPARTURE", 0),
        (1, "TPE", "ARRIVAL", 4),
    ]
    assert got[1].actual_time == NOON + dt.timedelta(hours=2, minutes=4)
    assert (got[1].scheduled_hour, got[1].day_of_week, got[1].is_weekend) == (14, 5, False)
    assert len({r.sk_event for r in got}) == 2


def test_stations(spark, staging):
    raw = day_files.read_stations(spark, str(staging.root))
    names = {r.stationShortCode: r.stationName for r in day_files.passenger_station_names(raw).collect()}
    assert names == {"HKI": "Helsinki", "TPE": "Tampere", "JY": "Jyväskylä"}
    dim = {r.stationShortCode: r for r in silver.dim_stations(bronze.stations(raw, "r")).collect()}
    assert [dim[c].region for c in ("HKI", "TPE", "JY", "XXX")] == [
        "Helsinki Region",
        "Tampere Region",
        "Central Finland",
        "Other Region",
    ]
    assert (dim["XXX"].station_type_label, dim["XXX"].passenger_service_label) == ("Turnout", "No Passenger Service")
    assert dim["HKI"].sk_station and dim["HKI"].dim_updated_at


def test_station_filter(spark, staging):
    staging.write(DAY, [train(1, DAY, ROWS), train(2, DAY, ROWS[:1]), train(3, DAY, None)])
    trains = day_files.read_trains(spark, str(staging.root))
    assert numbers(day_files.at_station(trains, "TPE")) == [1]


def test_missing_days(spark):
    landed = spark.createDataFrame([(DAY,), (DAY,)], "departureDate date")
    got = day_files.missing_days(spark, next_day(-1), next_day(1), landed).collect()
    assert [r.departureDate for r in got] == [next_day(-1), next_day(1)]


def test_landing_replaces_whole_days(spark, staging, tmp_path):
    staging.write(DAY, [train(1, DAY, ROWS), train(2, DAY, ROWS)])
    staging.write(next_day(1), [train(1, next_day(1), ROWS)])
    trains = day_files.read_trains(spark, str(staging.root)).drop("_path")
    path = str(tmp_path / "landed")
    landing.land(trains, path, compress=False)
    landing.land(trains.where(F.col("trainNumber") == 1).where(F.col("departureDate") == F.lit(DAY)), path)
    got = landing.read_landed(spark, path)
    assert sorted((r.departureDate, r.trainNumber) for r in got.collect()) == [(DAY, 1), (next_day(1), 1)]
    names = [f.name for f in (tmp_path / "landed" / f"departureDate={DAY}").iterdir() if f.name.startswith("part")]
    assert names and all(n.endswith(".json.gz") for n in names)  # the plain twin is gone
    assert got.where("departureDate = '2024-01-05'").head().timeTableRows[1].stationShortCode == "TPE"


def test_land_per_train(spark, staging, tmp_path):
    staging.write(DAY, [train(1, DAY, ROWS), train(2, DAY, ROWS)])
    path = tmp_path / "per_train"
    landing.land_per_train(day_files.read_trains(spark, str(staging.root)).drop("_path"), str(path))
    assert sorted(f.name for f in (path / f"departureDate={DAY}").iterdir()) == ["trainNumber=1", "trainNumber=2"]


def test_records(spark, staging):
    staging.write(DAY, [train(1, DAY, ROWS)])
    trains = day_files.read_trains(spark, str(staging.root))
    row = landing.load_summary(trains, DAY, next_day(2), station="HKI").head()
    assert (row.days_requested, row.days_loaded, row.total_trains, row.station_filter) == (3, 1, 1, "HKI")
    row = landing.coverage_record(trains).head()
    assert (row.data_from, row.data_through, row.days) == (DAY, DAY, 1)


@pytest.fixture
def untidy(staging):
    """An old day, a day in both formats, a cut-off day, a good day, an old quarantined file."""
    staging.write(next_day(-40), [train(1, next_day(-40), ROWS)], compress=True)
    staging.write(DAY, [train(1, DAY, ROWS)])
    staging.write(DAY, [train(1, DAY, ROWS)], compress=True)
    staging.path(next_day(1)).write_text('[{"trainNumber": 1, "depart', encoding="utf-8")
    staging.write(next_day(2), [train(1, next_day(2), ROWS)])
    held = staging.root / "quarantine"
    held.mkdir()
    (held / "2023-01-01.json").write_text("x", encoding="utf-8")
    return staging


def planned(df):
    return sorted((r.action, r.path.rsplit("/", 1)[1]) for r in df.collect())


ACTIONS = [
    ("delete", "2023-01-01.json"),
    ("delete", "2023-11-26.json.gz"),
    ("drop_twin", "2024-01-05.json"),
    ("quarantine", "2024-01-06.json"),
]


def test_tidy_dry_run_changes_nothing(spark, untidy):
    before = sorted(p for p in untidy.root.rglob("*") if p.is_file() and not p.name.endswith(".crc"))
    assert planned(landing.tidy(spark, str(untidy.root), next_day(-30), dry_run=True)) == ACTIONS
    assert sorted(p for p in untidy.root.rglob("*") if p.is_file() and not p.name.endswith(".crc")) == before


def test_tidy(spark, untidy):
    root = str(untidy.root)
    assert planned(landing.tidy(spark, root, next_day(-30))) == ACTIONS
    assert (untidy.root / "quarantine" / "2024-01-06.json").exists()
    assert not (untidy.root / "quarantine" / "2023-01-01.json").exists()
    assert len(day_files.read_trains(spark, root).collect()) == 2
    report = landing.staging_report(landing.list_day_files(spark, root)).head()
    assert (report.days_kept, report.files) == (2, 2) and report.size_mb > 0
    assert planned(landing.tidy(spark, root, next_day(-30))) == []


def test_compress_plain_days(spark, untidy):
    root = str(untidy.root)
    counted = landing.compress_plain_days(spark, root, dry_run=True).head()
    assert (counted.files, counted.bytes_after) == (1, 0) and counted.bytes_before > 0
    plain = untidy.path(next_day(2))
    text = plain.read_text(encoding="utf-8")
    done = landing.compress_plain_days(spark, root).head()
    assert (done.files, done.bytes_before) == (1, len(text.encode())) and 0 < done.bytes_after < done.bytes_before
    assert not plain.exists()
    with gzip.open(untidy.path(next_day(2), ".json.gz"), "rt", encoding="utf-8") as packed:
        assert packed.read().rstrip("\n") == text
    # the twin and the broken file are left to tidy
    assert untidy.path(DAY).exists() and untidy.path(next_day(1)).exists()
    assert not [p for p in untidy.root.iterdir() if p.name.startswith("_compressing")]
    assert landing.compress_plain_days(spark, root).head().files == 0
    landing.tidy(spark, root, next_day(-30))
    assert len(day_files.read_trains(spark, root).collect()) == 2


def test_a_full_load_of_unfinished_files_raises(spark, staging):
    staging.path(DAY, ".json.tmp").write_text("[]", encoding="utf-8")
    with pytest.raises(day_files.NoInputError):
        day_files.read_trains(spark, str(staging.root))


def test_plain_files_of_two_folders_are_no_twins(spark):
    rows = [(f"/s/{m}/2024-01-05.json", DAY, False) for m in ("01", "02")]
    listed = spark.createDataFrame(rows, "path string, day date, is_gzip boolean")
    assert landing.redundant_files(listed).count() == 0
    zipped = listed.unionByName(spark.createDataFrame([("/s/02/2024-01-05.json.gz", DAY, True)], listed.schema))
    assert [r.path for r in landing.redundant_files(zipped).collect()] == ["/s/02/2024-01-05.json"]
