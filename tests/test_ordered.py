"""Ordered operators against plain loops, with segments far smaller than a key."""

import random

import pytest
from feed import collect, minute, points

from barloom.operators import closing, merge, sequence
from barloom.schemas import CHART


def random_numbers(seed, n=400):
    rng = random.Random(seed)
    numbers, rows = {}, []
    for i in range(n):
        topic = rng.choice(["A"] * 6 + ["B", "C"])
        sid = 1 if i < n // 2 else 2
        last = numbers.get((sid, topic), rng.randint(1, 30))
        seq = max(1, last + rng.choice([1, 1, 1, 2, 5, 0, -3]))
        numbers[sid, topic] = max(seq, last)
        rows.append((i, sid, topic, seq))
    return rows


def counted_by_loop(rows):
    current, expected, out = None, {}, []
    for arrival, sid, topic, seq in rows:
        if sid != current:
            current, expected = sid, {}
        want = expected.get(topic)
        lost = max(seq - want, 0) if want is not None else 0
        out.append((arrival, want, lost, want is not None and seq < want))
        expected[topic] = seq + 1 if want is None else max(want, seq + 1)
    return out


@pytest.mark.parametrize("width", [1, 7, 64, 10_000])
def test_gap_report_equals_loop(spark, width):
    rows = random_numbers(width)
    df = spark.createDataFrame(rows, "arrival bigint, sid bigint, topic string, seq bigint")
    got = collect(sequence.steps(df, width=width).orderBy("arrival"), "arrival", "expected", "lost", "regressed")
    assert got == counted_by_loop(rows)


def test_gap_report_goes_on_from_history(spark):
    rows = random_numbers(5)
    schema = "arrival bigint, sid bigint, topic string, seq bigint"
    first = sequence.steps(spark.createDataFrame(rows[:150], schema), width=16)
    history = sequence.counters(first).select("sid", "topic", "seq")
    second = sequence.steps(spark.createDataFrame(rows[150:], schema), history, width=16)
    got = collect(first.unionByName(second).orderBy("arrival"), "arrival", "expected", "lost", "regressed")
    assert got == counted_by_loop(rows)


def test_loss_is_null_without_numbered_frames(spark):
    empty = spark.createDataFrame([], "arrival bigint, sid bigint, topic string, seq bigint")
    assert tuple(sequence.loss_total(sequence.steps(empty)).first()) == (0, None, False)


def random_points(seed, n=300):
    rng = random.Random(seed)
    rows, now = [], 0
    for _ in range(n):
        now += rng.choice([0, 0, 0, 1, 2])
        rows.append(
            {
                "symbol": rng.choice(["SPY"] * 5 + ["QQQ"]),
                "bar_type": rng.choice([0, 1, 1, 1, 1]),
                "bar_interval": rng.choice([1, 5]),
                "bar_time": minute(max(0, now - rng.choice([0, 0, 0, 0, 1, 3]))),
                "high": float(rng.randint(5, 9)),
                "low": float(rng.randint(1, 4)),
            }
        )
    return rows


def closed_by_loop(rows):
    open_bars, out, counts = {}, [], {"refreshed": 0, "stale": 0, "suspected": 0}
    for i, r in enumerate(rows):
        if r["bar_type"] == 0:
            out.append(i)
            continue
        key = (r["symbol"], r["bar_interval"])
        held = open_bars.get(key)
        if held is None or r["bar_time"] > held[1]["bar_time"]:
            if held:
                out.append(held[0])
            open_bars[key] = (i, r)
        elif r["bar_time"] == held[1]["bar_time"]:
            counts["suspected"] += r["high"] < held[1]["high"] or r["low"] > held[1]["low"]
            counts["refreshed"] += 1
            open_bars[key] = (i, r)
        else:
            counts["stale"] += 1
    return sorted([*out, *[i for i, _ in open_bars.values()]]), counts


@pytest.mark.parametrize("width", [3, 50, 10_000])
def test_closed_bars_equal_loop(spark, width):
    rows = random_points(width)
    df = points(spark, rows)
    survivors, counts = closed_by_loop(rows)
    assert sorted(r[0] for r in collect(closing.close_bars(df, width), "arrival")) == survivors
    got = dict(collect(closing.ingest_counters(df, width), "counter", "n"))
    assert got["refreshed"] == counts["refreshed"]
    assert got["stale_dropped"] == counts["stale"]
    assert got["subminute_suspected"] == counts["suspected"]
    assert got["ticks_out"] + got["direct_bars_out"] == len(survivors)


def test_a_single_hot_bar_is_split_over_segments(spark):
    rows = [{"bar_time": minute(0), "high": float(9 - i % 3), "low": 1.0} for i in range(100)]
    kept = closing.mark_stale(points(spark, rows), width=8).where("NOT stale").drop("stale")
    steps = closing.refresh_steps(kept, width=8)
    assert steps.count() == 99
    assert collect(closing.subminute_charts(steps), "suspected", "first_arrival") == [(66, 1)]
    assert collect(closing.collapse(kept), "arrival", "refreshes") == [(99, 99)]


def test_repeated_times_and_bundled_ticks(spark):
    rows = [{"bar_time": minute(n)} for n in (0, 1, 1, 2, 1)] + [
        {"bar_time": minute(0), "bar_type": 0, "bar_interval": 100},
        {"bar_time": minute(0), "bar_type": 0, "bar_interval": 1},
    ]
    df = points(spark, rows)
    assert collect(closing.repeated_bar_times(df, width=2), "repeats") == [(1,)]
    assert collect(closing.aggregated_tick_charts(df), *CHART) == [("SPY", 0, 100)]


def test_late_rows_per_chart(spark):
    day = 24 * 60
    rows = [{"bar_time": minute(m)} for m in (0, day, 1, day + 1)] + [
        {"bar_time": minute(0), "symbol": "QQQ"},
        {"bar_time": minute(0), "bar_type": 2},
    ]
    out = merge.split_late(points(spark, rows), width=2).orderBy("arrival")
    assert [r[0] for r in collect(out, "late")] == [False, False, True, False, False, False]
    days = out.where("day IS NOT NULL").groupBy(*CHART).agg({"day": "max"})
    history = days.withColumnRenamed("max(day)", "day")
    later = merge.split_late(points(spark, [{"arrival": 9, "bar_time": minute(2)}]), history)
    assert collect(later, "late") == [(True,)]
