import datetime as dt

import pytest
from builders import timetable_row, train
from pyspark.sql import functions as F

from punctual.operators.quality import DataTestError, TableTests, UniqueTest, not_null, run_tests
from punctual.plans import build, daily_tests
from punctual.plans.build import BuildOptions, run_daily, stored_marts
from punctual.plans.reports import overview, star, stations, train_types
from punctual.sources.tables import Warehouse
from punctual.streaming.reload import Ledger, load_new_days

TODAY = dt.date(2024, 1, 10)


def day(n):
    return TODAY - dt.timedelta(days=n)


def rows_on(date, delay=0):
    noon = dt.datetime.combine(date, dt.time(12))
    return [
        timetable_row("HKI", "DEPARTURE", noon, delay),
        timetable_row("TPE", "ARRIVAL", noon + dt.timedelta(hours=1), delay),
    ]


def options(**values):
    return BuildOptions(**{"reload_days": 2, "retention_days": 30, "as_of": TODAY} | values)


@pytest.fixture
def site(staging, tmp_path):
    for n in range(5):
        trains = [train(i, day(n), rows_on(day(n)), trainType=t) for i, t in ((1, "IC"), (2, "HDM"))]
        staging.write(day(n), trains, compress=n % 2 == 0)
    return staging, str(tmp_path / "warehouse")


def per_day(spark, root, layer=build.SILVER, name=build.FACT):
    table = Warehouse(spark, root).read_days(layer, name)
    return {r.departureDate: r["count"] for r in table.groupBy("departureDate").count().collect()}


def test_full_build_then_reports(spark, site):
    staging, root = site
    report = run_daily(spark, str(staging.root), root, options())
    assert report.where("NOT passed").collect() == []
    marts = stored_marts(Warehouse(spark, root))
    head = overview.overall_metrics(marts).head()
    assert (head.total_trains, head.total_events, head.stations_served, head.otp_percentage) == (10, 20, 2, 100.0)
    assert overview.freshness(marts).head()[0] == "2024-01-10 13:00"
    assert [r.trains for r in train_types.top_performers(marts, min_trains=1).collect()] == [5, 5]
    assert {r.region for r in star.region_delay(marts).collect()} == {"Helsinki Region", "Tampere Region"}
    assert stations.busiest(marts).collect() == []  # under the volume gate


def test_reload_replaces_the_window_and_nothing_else(spark, site):
    staging, root = site
    run_daily(spark, str(staging.root), root, options())
    before = per_day(spark, root)
    run_daily(spark, str(staging.root), root, options())
    assert per_day(spark, root) == before  # loading twice changes nothing

    late = [train(i, day(1), rows_on(day(1), 30)) for i in (1, 2, 3)]
    staging.write(day(1), late)
    loads = Warehouse(spark, root).read(build.BRONZE, build.LOADS).orderBy("load_time").collect()
    assert [(r.days_requested, r.days_loaded, r.total_trains) for r in loads] == [(None, 5, 10), (3, 3, 6)]
    covered = Warehouse(spark, root).read(build.GOLD, build.COVERAGE).head()
    assert (covered.data_from, covered.data_through, covered.days) == (day(4), day(0), 5)
    staging.write(day(4), [])  # outside the window: needs a full refresh
    staging.path(day(20)).write_text("[{", encoding="utf-8")  # broken, outside the window
    run_daily(spark, str(staging.root), root, options())
    assert per_day(spark, root) == before | {day(1): 6}
    loaded = Warehouse(spark, root).read_days(build.BRONZE, build.TRAINS)
    assert loaded.where("departureDate = '2024-01-09'").count() == 3


def test_a_reloaded_day_without_events_leaves_the_fact(spark, site):
    staging, root = site
    run_daily(spark, str(staging.root), root, options())
    staging.write(day(1), [train(i, day(1), rows_on(day(1)), cancelled=True, version=9) for i in (1, 2)])
    before = per_day(spark, root)
    run_daily(spark, str(staging.root), root, options())
    assert per_day(spark, root) == {d: n for d, n in before.items() if d != day(1)}
    bronze_days = per_day(spark, root, build.BRONZE, build.TRAINS)
    assert bronze_days[day(1)] == 2


@pytest.mark.parametrize("by_day", [False, True])
def test_a_failed_write_keeps_the_old_table(spark, tmp_path, by_day):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    write = warehouse.overwrite_days if by_day else warehouse.overwrite
    rows = spark.range(5).selectExpr("id", "date'2024-01-01' AS departureDate")
    write(rows, "silver", "t")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        write(rows.selectExpr("1 div (id - 3) AS id", "departureDate"), "silver", "t")
    assert warehouse.read("silver", "t").count() == 5
    assert len(list((tmp_path / "w" / "silver" / "t").glob("_version=*"))) == 1
    write(warehouse.read("silver", "t").where("id < 2"), "silver", "t")  # a table may feed its own next state
    assert warehouse.read("silver", "t").count() == 2
    assert [p.name for p in (tmp_path / "w" / "silver").iterdir()] == ["t"]


def test_full_refresh_reads_everything(spark, site):
    staging, root = site
    run_daily(spark, str(staging.root), root, options())
    staging.path(day(4), ".json.gz").unlink()
    staging.write(day(3), [train(1, day(3), rows_on(day(3)))])
    run_daily(spark, str(staging.root), root, options(full_refresh=True))
    assert per_day(spark, root) == {day(0): 4, day(1): 4, day(2): 4, day(3): 2}


def test_empty_window_loads_nothing(spark, site):
    staging, root = site
    run_daily(spark, str(staging.root), root, options())
    before = per_day(spark, root)
    run_daily(spark, str(staging.root), root, options(as_of=TODAY + dt.timedelta(days=9)))
    assert per_day(spark, root) == before


def test_retention(spark, site):
    staging, root = site
    run_daily(spark, str(staging.root), root, options(retention_days=2))
    expected = {day(0): 4, day(1): 4, day(2): 4}
    assert per_day(spark, root) == expected
    assert per_day(spark, root, build.BRONZE, build.TRAINS).keys() == expected.keys()


def test_window_and_cutoff():
    opts = BuildOptions(reload_days=7, retention_days=365, as_of=dt.date(2024, 3, 1))
    assert opts.reload_from == dt.date(2024, 2, 23)
    assert opts.retention_cutoff == dt.date(2023, 3, 2)


def test_an_error_stops_the_build_and_a_warning_does_not(spark, site):
    staging, root = site
    odd = train(7, day(0), rows_on(day(0)), trainCategory="Ferry")
    staging.write(day(0), [odd], compress=True)
    report = run_daily(spark, str(staging.root), root, options())
    failed = [(r.test, r.severity) for r in report.where("NOT passed").collect()]
    assert failed == [("accepted_values(trainCategory)", "warn")]
    twice = train(7, day(0), rows_on(day(0)) + rows_on(day(0)))
    staging.write(day(0), [twice], compress=True)
    with pytest.raises(DataTestError, match="sk_event"):
        run_daily(spark, str(staging.root), root, options())


def test_first_run_without_files_fails(spark, staging, tmp_path):
    from punctual.sources.day_files import NoInputError

    with pytest.raises(NoInputError):
        run_daily(spark, str(staging.root), str(tmp_path / "w"), options())


def test_new_column_is_appended(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    old = spark.createDataFrame([(1, day(1)), (2, day(0))], "n int, departureDate date")
    warehouse.overwrite_days(old, "bronze", "t")
    new = spark.createDataFrame([(3, "x", day(0))], "n int, extra string, departureDate date")
    warehouse.replace_days(new, "bronze", "t")
    got = {(r.n, r.extra) for r in warehouse.read_days("bronze", "t").collect()}
    assert got == {(1, None), (3, "x")}
    assert warehouse.days("bronze", "t") == [day(1), day(0)]


def test_a_batch_that_comes_again_changes_nothing(spark, site, tmp_path):
    staging, root = site
    warehouse = Warehouse(spark, root)
    load_new_days(spark, str(staging.root), warehouse, str(tmp_path / "check"), "r", max_files=2)
    ledger = Ledger(warehouse, str(tmp_path / "check"))
    entered = sorted((r.batch_id, len(r.days)) for r in ledger.loaded().collect())
    assert sum(n for _, n in entered) == 5 and max(n for _, n in entered) == 2
    state, calls = warehouse.pointer(build.BRONZE, build.TRAINS), []
    ledger.once(lambda batch: calls.append(batch) or [])(spark.range(1), entered[0][0])
    assert calls == [] and warehouse.pointer(build.BRONZE, build.TRAINS) == state
    other = Ledger(warehouse, "another stream")
    other.once(lambda batch: calls.append(batch) or [])(spark.range(1), 0)
    assert len(calls) == 1


def test_stream_loads_new_files_once(spark, site, tmp_path):
    staging, root = site
    warehouse = Warehouse(spark, root)
    load = lambda: load_new_days(spark, str(staging.root), warehouse, str(tmp_path / "check"), "r", since=day(3))
    load()
    counts = per_day(spark, root, build.BRONZE, build.TRAINS)
    assert counts == {day(n): 2 for n in range(4)}
    load()  # nothing new
    assert per_day(spark, root, build.BRONZE, build.TRAINS) == counts
    staging.write(day(-1), [train(5, day(-1), rows_on(day(-1)))])
    staging.write(day(4), [train(5, day(4), rows_on(day(4)))])  # too late
    load()
    assert per_day(spark, root, build.BRONZE, build.TRAINS) == counts | {day(-1): 1}


def outcomes(report):
    return {(r.table_name, r.test): (r.severity, r.failures, r.passed) for r in report.collect()}


def test_results_by_day_are_those_of_whole_tables(spark, site):
    staging, root = site
    warehouse = Warehouse(spark, root)
    odd = [train(i, day(1), rows_on(day(1)), trainCategory="Ferry") for i in (1, 2)]
    staging.write(day(1), odd)
    for files in (
        [train(3, day(0), [timetable_row("NEW", "ARRIVAL", dt.datetime.combine(day(0), dt.time(9)))])],
        [train(3, day(0), rows_on(day(0)), operatorShortCode="x")],
    ):
        staging.write(day(0), files, compress=True)
        report = outcomes(run_daily(spark, str(staging.root), root, options()))
        assert report == outcomes(run_tests(build.stored_tables(warehouse), build.SUITE))
        assert report["train_departures", "accepted_values(trainCategory)"] == ("warn", 2, False)


def test_only_changed_days_are_tested(spark, site):
    staging, root = site
    run_daily(spark, str(staging.root), root, options())
    warehouse = Warehouse(spark, root)
    tables = build.stored_tables(warehouse)
    by_day = {n: build.SUITE[n] for n in build.DAY_SOURCES}
    mine = {n: tables[n] for n in by_day}
    assert daily_tests.refresh(warehouse, mine, build.DAY_SOURCES, by_day) == set()

    kept = warehouse.pointer("tests", daily_tests.RESULTS).folders
    trains = warehouse.read(build.BRONZE, build.TRAINS).where(F.col("departureDate") == F.lit(day(3)))
    warehouse.replace_days(trains.withColumn("trainCategory", F.lit("Ferry")), build.BRONZE, build.TRAINS)
    warehouse.drop_days_before(day(3), build.BRONZE, build.TRAINS)
    mine = {n: t for n, t in build.stored_tables(warehouse).items() if n in by_day}
    assert daily_tests.refresh(warehouse, mine, build.DAY_SOURCES, by_day) == {str(day(3)), str(day(4))}
    now = warehouse.pointer("tests", daily_tests.RESULTS).folders
    changed = (str(day(3)), str(day(4)))
    assert {f for f in kept if not f.endswith(changed)} == {f for f in now if not f.endswith(changed)}
    found = outcomes(daily_tests.report(warehouse, build.stored_tables(warehouse), by_day))
    assert found["train_departures", "accepted_values(trainCategory)"] == ("warn", 2, False)

    stricter = by_day | {build.TRAINS: TableTests(rows=[not_null("trainNumber")])}
    assert daily_tests.refresh(warehouse, mine, build.DAY_SOURCES, stricter) is None  # another suite


def test_rows_without_a_day_and_repeats_show(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    rows = spark.createDataFrame([(1, day(1)), (1, day(1)), (2, None), (2, None), (3, day(0))], "n int, departureDate date")
    suite = {"t": TableTests(rows=[not_null("departureDate")], unique=[UniqueTest(("departureDate", "n"))])}
    for _ in range(2):
        warehouse.replace_days(rows, "bronze", "t")
        table = {"t": warehouse.read("bronze", "t")}
        daily_tests.refresh(warehouse, table, {"t": ("bronze", "t")}, suite)
        assert outcomes(daily_tests.report(warehouse, table, suite)) == outcomes(run_tests(table, suite))
    across = {"t": TableTests(unique=[UniqueTest(("n",))])}
    with pytest.raises(ValueError, match="across days"):
        daily_tests.refresh(warehouse, table, {"t": ("bronze", "t")}, across)
