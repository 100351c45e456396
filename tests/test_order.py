"""The order of rows, which the comparison with SQL leaves out."""

import functools

import pytest

from punctual.verification.queries import registered

FOLDER = "/root/testdata/sf0.001"
DOWN, UP = True, False
# (column, whether it falls); nulls come last either way
ORDERS = {
    "station_performance": [("total_events", DOWN), ("station_code", UP)],
    "pair_comparison": [("on_time_percentage", DOWN), ("train_type", UP)],
    "rankings_range": [("otp_percentage", DOWN), ("train_type", UP), ("category", UP)],
    "category_summary": [("otp_percentage", DOWN), ("category", UP)],
    "consistency_median": [("delay_stddev", UP), ("train_type", UP)],
    "station_top10_delay": [("avg_delay_minutes", DOWN), ("station_code", UP)],
    "station_top10_volume": [("total_events", DOWN), ("station_code", UP)],
    "missing_days": [("departureDate", UP)],
    "snapshot_log": [("number", UP)],
    "stored_rankings_range": [("otp_percentage", DOWN), ("train_type", UP), ("category", UP)],
}


def before(spec, a, b):
    for column, falls in spec:
        x, y = a[column], b[column]
        if x == y:
            continue
        if x is None or y is None:
            return 1 if x is None else -1
        return -1 if (x > y) == falls else 1
    return 0


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_rows_are_in_order(spark, name):
    rows = [r.asDict() for r in registered()[name](spark, FOLDER).collect()]
    spec = ORDERS[name]
    assert len(rows) > 1
    assert rows == sorted(rows, key=functools.cmp_to_key(lambda a, b: before(spec, a, b)))
    keys = [tuple(r[c] for c, _ in spec) for r in rows]
    assert len(set(keys)) == len(keys)  # the tiebreaker decides


@pytest.mark.parametrize("name", ["otp_by_scope", "stored_otp_by_scope"])
def test_scopes_come_as_overall_main_categories_others(spark, name):
    scopes = [r.metric_scope for r in registered()[name](spark, FOLDER).collect()]
    main = [s for s in scopes if s in ("Commuter", "Long-distance")]
    others = [s for s in scopes if s not in ("Overall", *main)]
    known = [s for s in others if s is not None]
    assert scopes == ["Overall", *sorted(main), *sorted(known), *[None] * (len(others) - len(known))]
