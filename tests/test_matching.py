"""Time matching against brute force."""

import random
from datetime import datetime, timedelta

import pytest
from support import at, plan

from gaugeworks.operators import matching as m

BASE = datetime(2009, 10, 27, 23, 0, 0)


def frames(spark, probes, targets):
    p = spark.createDataFrame(probes, "pid int, st int, ts timestamp_ntz")
    t = spark.createDataFrame(targets, "tid int, st int, tts timestamp_ntz")
    return p, t


def scatter(seed, n, spread, step):
    """Unique (station, time) rows; stations 0 (busy) to 3."""
    rnd, seen = random.Random(seed), {}
    while len(seen) < n:
        key = (rnd.choice([0, 0, 0, 1, 2, 3]), BASE + timedelta(microseconds=rnd.randrange(0, spread, step)))
        seen.setdefault(key, len(seen))
    return [(i, st, ts) for (st, ts), i in seen.items()]


def brute(probes, targets, tolerance, direction):
    tol = timedelta(seconds=tolerance)
    out = {}
    for pid, st, ts in probes:
        near = [(abs(tts - ts), tts, tid) for tid, s, tts in targets if s == st and abs(tts - ts) <= tol]
        if direction == "backward":
            near = [x for x in near if x[1] <= ts]
        if direction == "forward":
            near = [x for x in near if x[1] >= ts]
        out[pid] = min(near)[2] if near else None
    return out


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("tolerance,spread,step", [(1, 40_000_000, 250_000), (3600, 40 * 3600 * 10**6, 60_000_000), (0, 10**7, 500_000), (1, 300_000, 1_000)])
def test_asof_equals_brute_force(spark, direction, tolerance, spread, step):
    probes, targets = scatter(1, 60, spread, step), scatter(2, 60, spread, step)
    p, t = frames(spark, probes, targets)
    got = m.asof(p, t, "st", "ts", "tts", ["tid"], tolerance, direction)
    assert {r["pid"]: r["tid"] for r in got.collect()} == brute(probes, targets, tolerance, direction)


def test_first_in_window_is_the_earliest(spark):
    probes, targets = scatter(3, 60, 40 * 3600 * 10**6, 60_000_000), scatter(4, 60, 40 * 3600 * 10**6, 60_000_000)
    p, t = frames(spark, probes, targets)
    got = {r["pid"]: r["tid"] for r in m.first_in_window(p, t, "st", "ts", "tts", ["tid"], 3600).collect()}
    for pid, st, ts in probes:
        near = [(tts, tid) for tid, s, tts in targets if s == st and abs(tts - ts) <= timedelta(hours=1)]
        assert got[pid] == (min(near)[1] if near else None)


def test_tolerance_is_inclusive_and_times_before_1970_work(spark):
    p, t = frames(spark, [(1, 0, at("1969-12-31 23:59:59.500000")), (2, 0, at("2009-01-01 00:00:00"))],
                  [(1, 0, at("1969-12-31 23:59:58.500000")), (2, 0, at("2009-01-01 00:00:01.000001"))])
    got = {r["pid"]: r["tid"] for r in m.within_seconds(p, t, "st", "ts", "tts", ["tid"]).collect()}
    assert got == {1: 1, 2: None}


def test_ties_go_to_the_earlier_target(spark):
    p, t = frames(spark, [(1, 0, at("2009-01-01 00:10:00"))], [(1, 0, at("2009-01-01 00:09:00")), (2, 0, at("2009-01-01 00:11:00"))])
    assert m.asof(p, t, "st", "ts", "tts", ["tid"], 3600).first()["tid"] == 1


def by_minute(probes, targets):
    """Own minute by exact time, else first row of the nearest minute within an hour."""
    out = {}
    for pid, st, ts in probes:
        minute = ts.replace(second=0, microsecond=0)
        mine = [(abs(tts - ts), tts, tid) for tid, s, tts in targets if s == st and tts.replace(second=0, microsecond=0) == minute]
        if mine:
            out[pid] = (min(mine)[2], 1)
            continue
        other = []
        for tid, s, tts in targets:
            gap = abs(tts.replace(second=0, microsecond=0) - minute)
            if s == st and gap <= timedelta(hours=1):
                other.append((gap, tts.replace(second=0, microsecond=0), tts, tid))
        out[pid] = (min(other)[3], 2) if other else (None, None)
    return out


@pytest.mark.parametrize("spread,step", [(600 * 10**6, 5_000_000), (30 * 3600 * 10**6, 17_000_000)])
def test_nearest_by_minute_equals_brute_force(spark, spread, step):
    probes, targets = scatter(5, 70, spread, step), scatter(6, 70, spread, step)
    p, t = frames(spark, probes, targets)
    got = m.nearest_by_minute(p, t, "st", "ts", "tts", ["tid"])
    assert {r["pid"]: (r["tid"], r["match_tier"]) for r in got.collect()} == by_minute(probes, targets)


def test_no_pairs_are_formed(spark):
    """The only join is, by minute, with one row per minute."""
    p, t = frames(spark, scatter(1, 5, 10**9, 1000), scatter(2, 5, 10**9, 1000))
    one = plan(m.within_seconds(p, t, "st", "ts", "tts", ["tid"]))
    assert "Join" not in one and "Broadcast" not in one
    for text in [one, plan(m.nearest_by_minute(p, t, "st", "ts", "tts", ["tid"]))]:
        assert "Cartesian" not in text and "NestedLoop" not in text


def test_empty_sides(spark):
    p, t = frames(spark, [(1, 0, BASE)], [])
    assert m.within_seconds(p, t, "st", "ts", "tts", ["tid"]).first()["tid"] is None
    assert m.nearest_by_minute(p.limit(0), t, "st", "ts", "tts", ["tid"]).count() == 0


def test_probes_without_key_or_time_match_nothing(spark):
    p, t = frames(spark, [(1, 0, BASE), (2, None, BASE), (3, 0, None)], [(1, 0, BASE), (2, None, BASE)])
    for got in (m.within_seconds(p, t, "st", "ts", "tts", ["tid"]), m.nearest_by_minute(p, t, "st", "ts", "tts", ["tid"])):
        assert {r["pid"]: r["tid"] for r in got.collect()} == {1: 1, 2: None, 3: None}
