"""What the physical plans must look like at scale, and that hot keys do not change results."""

import datetime as dt
import io
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from punctual.llm.common import setting
from punctual.operators.latest import latest_per_key
from punctual.plans import build, gold, states
from punctual.plans.marts import Marts
from punctual.plans.reports import pair, star, train_types
from punctual.sources import files, landing
from punctual.sources import sample_tables as sample
from punctual.sources.tables import Warehouse
from punctual.verification.queries import registered, stored_warehouse

FOLDER = "/root/testdata/sf0.001"
WRITES_TABLES = {"reload", "retention", "schema", "quarantine", "file", "pruned", "snapshot", "lake", "built", "stored", "gold", "rewritten", "time", "day", "station"}


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def initial(df):
    return df._jdf.queryExecution().executedPlan().toString()


def eager(name):
    return name.split("_")[0] in WRITES_TABLES or name in {
        "raw_train_statistics",
        "streamed_from_landing",
    }


@pytest.mark.parametrize("name", sorted(n for n in registered() if not eager(n)))
def test_no_cross_join_no_python(spark, name):
    text = initial(registered()[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "InPandas"):
        assert operator not in text


def test_scan_reads_only_what_a_rollup_needs(spark):
    text = plan(gold.delay_histogram(sample.event_fact(spark, FOLDER)))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in text


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "fact")
    sample.event_fact(spark, FOLDER).write.parquet(path)
    text = plan(gold.daily_performance(spark.read.parquet(path)))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    for condition in ("IsNotNull(actual_time)", "EqualTo(commercial_stop,true)"):
        assert condition in pushed


def test_period_prunes_day_folders(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.overwrite_days(gold.pair_station_daily(sample.event_fact(spark, FOLDER)), "gold", "pair_station_daily")
    table = warehouse.read_days("gold", "pair_station_daily")
    marts = Marts(lambda name: table, ["pair_station_daily", "timetable_coverage"])
    text = plan(pair._recent(marts, "pair_station_daily", 3))
    assert re.search(r"PartitionFilters: \[.*departureDate.*> date_sub\(.*[Ss]ubquery", text)


def test_stored_reports_and_merges_read_no_event(spark):
    warehouse = stored_warehouse(spark, FOLDER)
    fact = warehouse.path("silver", "fact_timetable_events")
    for name in (n for n in registered() if n.startswith("stored_")):
        assert fact not in plan(registered()[name](spark, FOLDER))
    for merge in states.MERGED.values():
        assert fact not in plan(merge(lambda name: warehouse.read("states", name)))


def test_a_reload_rewrites_one_day_of_each_roll_up(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    fact = sample.event_fact(spark, FOLDER)
    warehouse.overwrite_days(fact, "silver", "fact_timetable_events")
    build.refresh_states(warehouse)
    day = warehouse.days("silver", "fact_timetable_events")[-1]
    tables = [("states", n) for n in states.STATES] + [("gold", n) for n in states.BY_DAY]
    before = {t: set(warehouse.pointer(*t).folders) for t in tables}
    build.refresh_states(warehouse, day)
    for table in tables:
        after = set(warehouse.pointer(*table).folders)
        assert len(after) == len(before[table]) > 1
        assert {f.rsplit("=", 1)[1] for f in after - before[table]} == {day.isoformat()}
    window = warehouse.read("silver", "fact_timetable_events").where(F.col("departureDate") >= F.lit(day))
    assert "PartitionFilters: [isnotnull(departureDate" in plan(states.delay_counts(window))


def test_quarantine_parses_json_once(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.json").write_text('{"n": 1}\n{"n": \n')
    (tmp_path / "raw" / "b.json").write_text('{"n": 2}\n')
    rows = landing.read_permissive(spark, str(tmp_path / "raw"), "n int", multi_line=False)
    good, bad = landing.split_readable(rows, str(tmp_path / "parsed"))
    for part in (good, bad):
        assert "Scan json" not in plan(part)
    assert [r.n for r in good.collect()] == [2]
    assert [r.n_bad for r in bad.collect()] == [1]


def test_newest_version_is_kept_before_the_shuffle(spark):
    lines = sample.table(spark, FOLDER, "lineitem")
    text = initial(latest_per_key(lines, ["l_orderkey"], [F.desc("l_partkey")]))
    before_shuffle = text.split("Exchange")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_rollups_aggregate_before_they_shuffle(spark):
    fact = sample.event_fact(spark, FOLDER)
    for rollup in (gold.daily_performance, gold.train_spans, gold.on_time_performance, gold.pair_comparison):
        for below in initial(rollup(fact)).split("Exchange hashpartitioning")[1:]:
            assert "partial_" in below.splitlines()[1] or "HashAggregate" in below.splitlines()[1]


def test_a_dimension_is_joined_after_aggregation(spark):
    fact = sample.lineitem_fact(spark, FOLDER, train_type=True)
    marts = Marts.from_fact(fact, sample.supplier_stations(spark, FOLDER))
    for report in (star.station_star, star.region_delay):
        text = initial(report(marts))
        join = next(i for i, row in enumerate(text.splitlines()) if "Join [stationShortCode" in row)
        assert "HashAggregate" in "\n".join(text.splitlines()[join : join + 5])


@pytest.mark.parametrize("name", ["region_delay", "consistency_median_star"])
def test_parts_of_the_order_join_follow_the_tables(spark, monkeypatch, name):
    """Twice the stored bytes are twice the parts, whatever the shuffle partitions are; what
    the join has put together by train is grouped there. The rows stay the same."""
    few = sorted(map(str, registered()[name](spark, FOLDER).collect()))
    stored = sum(files.size(spark, f"{FOLDER}/{t}.parquet") for t in ("lineitem", "orders"))
    for parts in (20, 40):
        monkeypatch.setattr(sample, "PART_BYTES", -(-stored // parts))
        # joined by sorting, as large tables are
        with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
            frame = registered()[name](spark, FOLDER)
            text = initial(frame)
            assert re.search(rf"hashpartitioning\(l_orderkey#\d+L, {parts}\)", text)
            assert re.search(rf"hashpartitioning\(o_orderkey#\d+L, {parts}\)", text)
            assert "hashpartitioning(stationShortCode, trainNumber" not in re.sub(r"#\d+L?", "", text)
            assert "hashpartitioning(trainNumber" not in re.sub(r"#\d+L?", "", text)
            assert sorted(map(str, frame.collect())) == few


def test_small_tables_are_left_to_adaptive_execution(spark):
    assert "REPARTITION_BY_NUM" not in initial(registered()["region_delay"](spark, FOLDER))


@pytest.fixture(scope="module")
def hot(spark):
    """A third of all rows: one train, one station, one midnight."""
    n = 60_000
    rows = spark.range(n).selectExpr(
        "cast(if(id % 3 = 0, 7, id % 5000) AS int) AS trainNumber",
        "if(id % 3 = 0, date'2024-01-02', date_add(date'2024-01-01', cast(id % 20 AS int))) AS departureDate",
        "if(id % 3 = 0, 'IC', concat('T', id % 7)) AS trainType",
        "if(id % 3 = 0, 'Long-distance', 'Commuter') AS trainCategory",
        "if(id % 3 = 0, 'HKI', concat('S', id % 50)) AS stationShortCode",
        "'ARRIVAL' AS event_type",
        "true AS commercial_stop",
        "id % 11 AS delay_minutes",
        "id",
    )
    timed = rows.withColumn("scheduled_time", F.expr("cast(departureDate AS timestamp_ntz) + make_dt_interval(0, 9)"))
    timed = timed.withColumn(
        "actual_time", F.expr("if(id % 3 = 0, cast(departureDate AS timestamp_ntz), scheduled_time)")
    )
    from punctual.plans.silver import with_event_attributes

    return with_event_attributes(timed)


def test_hot_keys(spark, hot):
    n_hot = 20_000
    head = {r.metric_scope: r for r in gold.on_time_performance(hot).collect()}
    assert (head["IC"].total_events, head["IC"].total_trains, head["IC"].total_stations) == (n_hot, 1, 1)
    assert head["Overall"].total_events == 60_000
    spans = gold.train_spans(hot).where("trainType = 'IC'").collect()
    assert [(r.n_trains, r.midnight_days) for r in spans] == [(1, "2024-01-02")]
    runs = gold.station_presence(hot).where("stationShortCode = 'HKI'").collect()
    assert [(r.first_actual_bucket, r.midnight_days) for r in runs] == [(dt.datetime(2024, 1, 2), "2024-01-02")]
    marts = Marts.from_fact(hot)
    top = {r.train_type: r for r in train_types.consistency(marts, min_trains=1).collect()}
    assert (top["IC"].trains, top["IC"].median_delay) == (1, 5.0)
    kept = latest_per_key(hot, ["trainNumber", "departureDate"], [F.desc("id")])
    assert kept.count() == hot.select("trainNumber", "departureDate").distinct().count()
    assert kept.where("trainNumber = 7 AND departureDate = '2024-01-02'").head().id == 59_997


def test_hot_day_is_split_on_write(spark, hot, tmp_path):
    """A day larger than the target size becomes several files."""
    changed = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    }
    before = {key: spark.conf.get(key) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    try:
        warehouse = Warehouse(spark, str(tmp_path))
        warehouse.overwrite_days(hot.repartition(8), "silver", "hot")
        files = (tmp_path / "silver" / "hot").glob("_version=*/departureDate=2024-01-02/part-*")
        assert len(list(files)) > 1
        assert warehouse.read_days("silver", "hot").count() == 60_000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
