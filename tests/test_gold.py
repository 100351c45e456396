import datetime as dt

import pytest
from builders import event
from pyspark.sql import functions as F

from punctual.plans import gold
from punctual.plans.marts import Marts
from punctual.plans.reports import calendar, overview, pair, train_types

D = dt.datetime


def as_dicts(df):
    return [r.asDict() for r in df.collect()]


def test_only_completed_commercial_stops_count(fact_of):
    rows = [event(), event(commercial_stop=False), event(commercial_stop=None), event(actual_time=None)]
    assert gold.daily_performance(fact_of(rows)).agg(F.sum("events")).head()[0] == 1
    assert gold.timetable_coverage(fact_of(rows)).head().events == 4


def test_histogram_keeps_the_null_delay(fact_of):
    fact = fact_of([event(delay=None), event(delay=None), event(delay=3)])
    got = {r.delay_minutes: (r.events, r.on_time_events, r.delay_count, r.delay_sum) for r in gold.delay_histogram(fact).collect()}
    assert got == {None: (2, 0, 0, None), 3: (1, 1, 1, 3)}


def test_null_type_is_not_the_total(fact_of):
    rows = [event(trainType=None, trainCategory=None), event(trainNumber=2, delay=20)]
    got = [(r.metric_scope, r.total_events, r.total_trains) for r in gold.on_time_performance(fact_of(rows)).collect()]
    assert got == [
        ("Overall", 2, 2),
        ("Long-distance", 1, 1),
        ("IC", 1, 1),
        (None, 1, 1),
        (None, 1, 1),
    ]


def test_train_of_two_types_counts_once_overall(fact_of):
    rows = [event(), event(trainType="HDM"), event(trainNumber=None)]
    got = {r.metric_scope: r.total_trains for r in gold.on_time_performance(fact_of(rows)).collect()}
    assert got == {"Overall": 1, "Long-distance": 1, "IC": 1, "HDM": 1}


def test_scope_without_countable_train(fact_of):
    rows = [event(trainNumber=None)]
    assert {r.total_trains for r in gold.on_time_performance(fact_of(rows)).collect()} == {0}


def test_unknown_delays_stay_in_the_denominator(fact_of):
    rows = [event(), event(delay=None)]
    overall = gold.on_time_performance(fact_of(rows)).head()
    assert (overall.on_time_percentage, overall.avg_delay_minutes) == (50.0, 0.0)


def test_presence_runs(fact_of):
    rows = [event(at=D(2024, 1, d, 10)) for d in (1, 2, 4)]
    got = [(r.first_actual_bucket.day, r.last_actual_bucket.day) for r in gold.station_presence(fact_of(rows)).collect()]
    assert sorted(got) == [(1, 2), (4, 4)]


def test_presence_gap_of_exactly_a_day_continues_the_run(fact_of):
    # noon of day 1, midnight stamp of day 3: 36 hours; midnight to midnight: 24 hours
    rows = [event(at=D(2024, 1, 1, 10)), event(at=D(2024, 1, 3)), event(at=D(2024, 1, 4))]
    got = {r.first_actual_bucket: (r.last_actual_bucket, r.midnight_days) for r in gold.station_presence(fact_of(rows)).collect()}
    assert got == {
        D(2024, 1, 1, 12): (D(2024, 1, 1, 12), ""),
        D(2024, 1, 3): (D(2024, 1, 4), "2024-01-03,2024-01-04"),
    }


def test_spans_over_midnight(fact_of):
    day = dt.date(2024, 1, 5)  # a Friday
    rows = [
        event(at=D(2024, 1, 5, 17), departureDate=day),
        event(at=D(2024, 1, 6, 0), departureDate=day),
        event(at=D(2024, 1, 6, 7), departureDate=day),
        event(at=D(2024, 1, 5, 17), departureDate=day, trainNumber=2),
        event(at=D(2024, 1, 5, 17), departureDate=day, trainNumber=None),
        event(at=D(2024, 1, 5, 17), departureDate=None, trainNumber=3),
    ]
    got = {r.n_trains: r for r in [*gold.train_spans(fact_of(rows)).collect()]}
    both = sorted(gold.train_spans(fact_of(rows)).collect(), key=lambda r: r.last_actual_bucket)
    assert got.keys() == {1} and len(both) == 2
    short, long = both
    assert (short.midnight_days, short.has_weekend, short.has_weekday) == ("", False, True)
    assert (long.first_actual_bucket, long.last_actual_bucket) == (D(2024, 1, 5, 12), D(2024, 1, 6, 12))
    assert long.midnight_days == "2024-01-06"
    assert long.has_weekday and long.has_weekend and long.has_morning_rush and long.has_evening_rush


@pytest.mark.parametrize(
    ("rows", "expected"),
    [
        ([("IC", 0), ("HDM", 20)], {"IC": "Winner: Better OTP", "HDM": "Behind IC"}),
        ([("IC", 0), ("HDM", 0)], {"IC": "Behind HDM", "HDM": "Behind IC"}),
        ([("IC", 0)], {"IC": "Behind HDM"}),
        ([("HDM", 0)], {"HDM": "Behind IC"}),
        ([("S", 0)], {}),
    ],
)
def test_verdict(fact_of, rows, expected):
    fact = fact_of([event(trainType=t, delay=d) for t, d in rows])
    assert {r.train_type: r.performance_verdict for r in gold.pair_comparison(fact).collect()} == expected


def test_other_pair(fact_of):
    fact = fact_of([event(trainType="S"), event(trainType="P", delay=50)])
    got = {r.train_type: r.performance_verdict for r in gold.pair_comparison(fact, ("S", "P")).collect()}
    assert got == {"S": "Winner: Better OTP", "P": "Behind S"}


def test_period_is_exactly_n_days(fact_of):
    fact = fact_of([event(at=D(2024, 1, d, 10)) for d in range(1, 11)])
    for days, stops in ((1, 1), (3, 3), (7, 7), (pair.ALL_TIME, 10)):
        assert pair.period_metrics(Marts.from_fact(fact), days).head().total_stops == stops


def test_period_follows_the_newest_day_of_any_train(fact_of):
    # the newest day has only an uncommercial event of another type
    rows = [event(at=D(2024, 1, 1, 10)), event(at=D(2024, 1, 4, 10), trainType="S", commercial_stop=False)]
    marts = Marts.from_fact(fact_of(rows))
    assert pair.period_metrics(marts, 3).collect() == []
    assert pair.period_metrics(marts, 4).head().total_stops == 1


def test_empty_fact(fact_of):
    fact = fact_of([])
    assert gold.daily_performance(fact).count() == 0
    assert gold.train_spans(fact).count() == 0
    overall = gold.on_time_performance(fact).collect()
    assert [(r.metric_scope, r.total_events) for r in overall] == [("Overall", 0)]
    marts = Marts.from_fact(fact)
    assert overview.freshness(marts).head()[0] is None
    assert pair.performance_gap(marts).head().otp_gap is None
    assert calendar.delay_trend(marts).head()[0] == "stable"


def test_median_of_even_count_is_the_mean_of_the_middle(fact_of):
    rows = [event(delay=d, trainNumber=i) for i, d in enumerate([1, 2, 10, 20])]
    got = train_types.consistency(Marts.from_fact(fact_of(rows)), min_trains=1).head()
    assert (got.median_delay, got.min_delay, got.max_delay) == (6.0, 1, 20)


def test_category_pattern_drops_null_categories(fact_of):
    rows = [event(trainCategory=None), event(trainNumber=2)]
    marts = Marts.from_fact(fact_of(rows))
    got = train_types.train_rankings(marts, "2024-01-01", "2024-02-01", min_trains=1).collect()
    assert [r.category for r in got] == ["Long-distance"]


def test_unknown_table(fact_of):
    with pytest.raises(KeyError, match="no table"):
        Marts.from_fact(fact_of([]))["station_performance"]
