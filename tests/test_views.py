"""Retention, opening bars and the live view against a plain loop."""

import random
from collections import deque
from datetime import datetime, timedelta, timezone
from functools import reduce
from zoneinfo import ZoneInfo

import numpy as np
import pytest
from feed import collect, minute, points

from barloom.operators import retention
from barloom.operators import snapshot as snap
from barloom.sources import symbols as sym
from barloom.streaming import closing_step, live_view

ET = ZoneInfo("America/New_York")
ROWS = [
    {"id": "$TICK", "category": "breadth", "role": "context"},
    {"id": "SPY", "category": "etf", "role": "trade"},
    {"id": "VXX", "category": "volatility", "role": "context", "pre_market_window_minutes": 0},
    {"id": "AAPL", "category": "mega_cap", "role": "context", "session_reset": True},
]
POLICY = {"$TICK": (True, None), "SPY": (False, 60), "VXX": (False, 0), "AAPL": (True, 60)}


def et(day, hour, minutes=0):
    return datetime(2026, 4, day, hour, minutes, tzinfo=ET).astimezone(timezone.utc)


def policies(spark):
    return sym.policies(sym.symbols_table(spark, ROWS))


def test_policy_defaults(spark):
    got = {r[0]: (r[1], r[2]) for r in policies(spark).collect()}
    assert got == POLICY
    table = sym.symbols_table(spark, ROWS)
    assert collect(sym.with_role(table, "trade"), "id") == [("SPY",)]


def loop(rows, depth=100):
    """The state of each symbol after all rows, in arrival order."""
    states = {}
    for i, r in enumerate(rows):
        local = r["bar_time"].astimezone(ET)
        session = (local - timedelta(days=1 if local.hour < 4 else 0)).date()
        opening = datetime(session.year, session.month, session.day, 9, 30, tzinfo=ET)
        st = states.setdefault(r["symbol"], {"held": deque(maxlen=depth), "session": None, "open": None})
        reset, window = POLICY.get(r["symbol"], (False, 60))
        regular = r["bar_time"] > opening
        if st["session"] != session:
            st["open"] = None
            if reset:
                st["held"].clear()
        if reset and regular and st["open"] is None:
            st["held"].clear()
        if not reset and window is not None:
            while st["held"] and st["held"][0][1] < opening - timedelta(minutes=window):
                st["held"].popleft()
        st["session"] = session
        if regular and (st["open"] is None or r["bar_time"] < st["open"]):
            st["open"] = r["bar_time"]
        st["held"].append((i, r["bar_time"]))
    return states


def recording(seed, disorder):
    rng, rows, now = random.Random(seed), [], et(20, 2)
    for _ in range(500):
        now += timedelta(minutes=rng.choice([0, 5, 15, 45]))
        late = rng.choice([0, 0, 0, 20]) if disorder else 0
        rows.append(
            {
                "symbol": rng.choice(["SPY", "SPY", "$TICK", "VXX", "AAPL", "XYZ"]),
                "bar_time": now - timedelta(minutes=late),
                "close": float(len(rows)),
            }
        )
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_retained_points_equal_loop(spark, seed):
    rows = recording(seed, disorder=False)
    for cut in (180, 333, 500):
        part = rows[:cut]
        kept = snap.retained_points(points(spark, part), policies(spark), 20, default=(False, 60))
        got = {}
        for symbol, arrival in collect(kept, "symbol", "arrival"):
            got.setdefault(symbol, set()).add(arrival)
        want = {s: {i for i, _ in st["held"]} for s, st in loop(part, 20).items()}
        assert got == want


def test_snapshot_as_of(spark):
    rows = recording(3, disorder=False)
    view = snap.snapshot(points(spark, rows), policies(spark), default=(False, 60), as_of=249)
    states = loop(rows[:250])
    for r in view.collect():
        st = states[r["symbol"]]
        assert (r["last_arrival"], r["session_date"]) == (st["held"][-1][0], st["session"])
        assert r["recent_points"] == len(st["held"])
        assert (r["open_bar_time"] is None) == (st["open"] is None)


def test_opening_bar_is_the_first_after_the_open(spark):
    rows = [{"bar_time": et(20, h, m), "open": float(h * 100 + m)} for h, m in ((8, 45), (9, 30), (9, 35), (9, 31))]
    got = snap.session_open_bars(points(spark, rows))
    assert collect(got, "open") == [(931.0,)]


def test_recent_points_per_symbol(spark):
    rows = [{"symbol": s, "bar_time": minute(i)} for i in range(9) for s in ("A", "B")]
    got = snap.recent_points(points(spark, rows), 3)
    assert sorted(collect(got, "symbol", "arrival")) == [
        ("A", 12), ("A", 14), ("A", 16), ("B", 13), ("B", 15), ("B", 17),
    ]


@pytest.mark.parametrize("width", [1, 7, 1 << 14])
def test_live_views_follow_every_arrival(spark, folder, width):
    """Disordered times, rows shuffled inside a trigger, segments cut anywhere."""
    rows = recording(4, disorder=True)
    numbered = [{"arrival": i, **r} for i, r in enumerate(rows)]
    edges = (0, 200, 203, 420, 500)
    job = live_view.LiveViews(spark, folder, policies(spark), default=(False, 60), depth=20, width=width)
    for lo, hi in zip(edges, edges[1:]):
        part = numbered[lo:hi]
        random.Random(lo).shuffle(part)
        points(spark, part).repartition(1).write.mode("append").parquet(f"{folder}/bars")
    stream = spark.readStream.schema(closing_step.POINT).option("maxFilesPerTrigger", 1).parquet(f"{folder}/bars")
    job.start(stream, availableNow=True).awaitTermination()
    for batch, hi in enumerate(edges[1:]) if width == 7 else [(None, 500)]:
        states = loop(rows[:hi], 20)
        held = {}
        for symbol, arrival in collect(job.recent(batch).orderBy("arrival"), "symbol", "arrival"):
            held.setdefault(symbol, []).append(arrival)
        assert held == {s: [i for i, _ in st["held"]] for s, st in states.items()}
        got = job.views(batch).collect()
        assert {r["symbol"] for r in got} == set(states)
        for r in got:
            st = states[r["symbol"]]
            assert (r["last_arrival"], r["session_date"]) == (st["held"][-1][0], st["session"])
            assert r["recent_points"] == len(st["held"])
            opened = r["open_bar_time"]
            assert (opened and opened.replace(tzinfo=timezone.utc)) == st["open"]
            assert r["oldest_bar_time"].replace(tzinfo=timezone.utc) == min(t for _, t in st["held"])
    assert job.views(symbols=["SPY"]).count() == 1


def walked(reset, depth, session, regular, cut, bars, prices):
    """What is held after all arrivals, walked one by one."""
    held, last, opening = [], None, None
    for i in range(len(session)):
        if last != session[i]:
            opening = None
            if reset:
                held = []
        if reset and regular[i] and opening is None:
            held = []
        while not reset and held and bars[held[0]] < cut[i]:
            held.pop(0)
        last = session[i]
        if regular[i] and (opening is None or bars[i] < opening[0]):
            opening = (bars[i], prices[i])
        held = [*held, i][-depth:]
    return held, last, opening


@pytest.mark.parametrize("seed", range(60))
def test_summaries_join_in_any_grouping(seed):
    rng = np.random.default_rng(seed)
    n, depth, reset = int(rng.integers(1, 90)), int(rng.integers(1, 12)), seed % 3 == 0
    steps = np.cumsum(rng.integers(0, 3, n)) if seed % 2 else rng.integers(0, 40, n)
    bars = steps + rng.integers(-4, 5, n) * (rng.random(n) < 0.3)
    session = bars // 10
    regular, cut = bars > session * 10 + 4, session * 10 + 4 - rng.integers(0, 6)
    if seed % 4 == 3:
        cut = rng.integers(-5, 40, n)
    values = {"arrival": np.arange(n), "bar_us": bars, "open": rng.random(n)}
    want = walked(reset, depth, session, regular, cut, bars, values["open"])
    edges = [0, *sorted(rng.integers(0, n + 1, 4).tolist()), n]
    runs = [
        retention.summed(reset, depth, session[a:b], regular[a:b], cut[a:b], {c: v[a:b] for c, v in values.items()})
        for a, b in zip(edges, edges[1:])
    ]
    empty = retention.Summary(reset, depth)
    right = empty
    for run in reversed(runs):
        right = retention.then(run, right)
    middle = retention.then(retention.then(runs[0], runs[1]), retention.then(retention.then(runs[2], runs[3]), runs[4]))
    for made in (reduce(retention.then, runs, empty), right, middle, reduce(retention.follow, runs, empty)):
        opening = None if made.open_us is None else (made.open_us, made.open_price)
        assert (made.held["arrival"].tolist(), made.session, opening) == want


def test_long_top_lists_are_cut_in_salted_parts(spark):
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    rows = [{"symbol": "A", "bar_time": minute(i)} for i in range(200)]
    spark.conf.set(key, "2")
    try:
        got = collect(snap.recent_points(points(spark, rows), 50), "arrival")
    finally:
        spark.conf.unset(key)
    assert sorted(r[0] for r in got) == list(range(150, 200))
