"""Roll-up answers for date ranges against a count over the events themselves."""

import datetime as dt
import random

import pytest
from builders import event

from punctual.plans.marts import Marts
from punctual.plans.reports import train_types

FIRST = dt.date(2024, 1, 30)  # the range crosses a month


def make_events(seed, n=400):
    """Trains within two days, many stamps at exactly midnight."""
    rng = random.Random(seed)
    rows = []
    for number in range(n // 4):
        start = dt.datetime.combine(FIRST, dt.time()) + dt.timedelta(days=rng.randrange(9), hours=rng.randrange(24))
        kind = rng.choice([("IC", "Long-distance"), ("S", "Long-distance"), ("HL", "Commuter"), (None, "Cargo")])
        for _ in range(4):
            at = start + dt.timedelta(hours=rng.randrange(0, 20))
            if at.date() > start.date() + dt.timedelta(days=1):
                at = start
            actual = dt.datetime.combine(at.date(), dt.time()) if rng.random() < 0.3 else at
            rows.append(
                event(
                    at=at,
                    actual_time=actual,
                    delay=rng.choice([None, *range(-2, 40)]),
                    trainNumber=number,
                    departureDate=start.date(),
                    trainType=kind[0],
                    trainCategory=kind[1],
                    stationShortCode=rng.choice("ABCDE"),
                )
            )
    return rows


def expected(rows, start, end):
    lo, hi = (dt.datetime.combine(d, dt.time()) for d in (start, end))
    groups = {}
    for r in rows:
        if lo <= r["actual_time"] <= hi:
            groups.setdefault((r["trainType"], r["trainCategory"]), []).append(r)
    return {
        key: (
            len({(r["trainNumber"], r["departureDate"]) for r in rs}),
            len(rs),
            len({r["stationShortCode"] for r in rs}),
            round(100 * sum(r["delay_minutes"] is not None and r["delay_minutes"] <= 5 for r in rs) / len(rs), 2),
        )
        for key, rs in groups.items()
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_rankings_equal_event_level_counts(fact_of, seed):
    rows = make_events(seed)
    marts_of = Marts.from_fact(fact_of(rows).cache())
    rng = random.Random(seed)
    pairs = [(rng.randrange(-1, 12), rng.randrange(-1, 12)) for _ in range(4)] + [(3, 3), (5, 5), (6, 2)]
    for a, b in pairs:
        start, end = FIRST + dt.timedelta(days=a), FIRST + dt.timedelta(days=b)
        got = train_types.train_rankings(marts_of, start, end, min_trains=1).collect()
        counted = {(r.train_type, r.category): (r.trains, r.total_stops, r.stations_served) for r in got}
        want = expected(rows, start, end)
        assert counted == {key: figures[:3] for key, figures in want.items()}, (start, end)
        for r in got:
            assert r.otp_percentage == pytest.approx(want[(r.train_type, r.category)][3], abs=0.011)
