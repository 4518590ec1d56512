"""Sealed days against a plain loop, and sinks that miss batches."""

import random
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from feed import collect, frames, payload, points
from pyspark.sql import functions as F

from barloom.operators import sealing
from barloom.operators.sides import staged
from barloom.streaming.ingest import Ingest
from barloom.streaming.ledger import Ledger
from barloom.streaming.sinks import table_sink

ET = ZoneInfo("America/New_York")
QUIET = timedelta(seconds=30)


def at(day, hour=12, minute=0, second=0):
    return datetime(2026, 4, day, hour, minute, second, tzinfo=ET).astimezone(timezone.utc)


def walked(batches):
    """Late arrivals and sealed days, row by row: (chart, day, reason)."""
    charts, late, sealed = {}, [], []
    for now, rows in batches:
        today = now.astimezone(ET).date()
        for name, chart in charts.items():
            if not chart["sealed"] and chart["day"] < today and now - chart["written"] >= QUIET:
                chart["sealed"] = True
                sealed.append((name, chart["day"], "quiet"))
        for arrival, name, time in rows:
            day = time.astimezone(ET).date()
            chart = charts.get(name)
            if chart and (day < chart["day"] or (chart["sealed"] and day == chart["day"])):
                late.append(arrival)
                continue
            if chart and day > chart["day"] and not chart["sealed"]:
                sealed.append((name, chart["day"], "later_day"))
            charts[name] = {"day": day, "written": now, "sealed": False}
    return late, sealed


def stepped(spark, batches, width=4):
    state, late, sealed = spark.createDataFrame([], sealing.STATE), [], []
    for now, rows in batches:
        bars = points(spark, [{"arrival": a, "symbol": s, "bar_time": t} for a, s, t in rows])
        clock = F.lit(now.astimezone(timezone.utc).replace(tzinfo=None)).cast("timestamp_ntz").cast("timestamp")
        aged = staged(sealing.quiet_days(state, clock, QUIET), "aged")
        marked = staged(sealing.split(bars, aged, width), "marked")
        late += [a for (a,) in collect(marked.where("late").orderBy("arrival"), "arrival")]
        sealed += collect(sealing.newly_sealed(state, aged, marked), "symbol", "day", "reason")
        state = staged(sealing.next_state(aged, marked, clock), "state")
    return late, sealed


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sealing_equals_a_loop(spark, seed):
    rng, batches, arrival, now = random.Random(seed), [], 0, at(20)
    for _ in range(6):
        now += rng.choice([timedelta(seconds=5), timedelta(seconds=40), timedelta(hours=20)])
        rows = []
        for _ in range(rng.choice([0, 6, 14])):
            rows.append((arrival, rng.choice("AAB"), now - rng.choice([timedelta(0), timedelta(0), timedelta(hours=9), timedelta(days=1)])))
            arrival += 1
        batches.append((now, rows))
    late, sealed = stepped(spark, batches)
    want_late, want_sealed = walked(batches)
    assert (late, sorted(sealed)) == (want_late, sorted(want_sealed))
    assert seed != 1 or late


def test_a_replay_of_five_days_seals_nothing_early(spark):
    """Long past days, a second apart: each is sealed by the next, the last by quiet."""
    now = at(28)
    replay = [(now + timedelta(seconds=i), [(2 * i, "A", at(20 + i, 10)), (2 * i + 1, "A", at(20 + i, 11))]) for i in range(5)]
    late, sealed = stepped(spark, replay)
    assert late == [] and [(d.day, r) for _, d, r in sealed] == [(20 + i, "later_day") for i in range(4)]
    more = [(now + timedelta(seconds=34), [(10, "A", at(24, 12))]), (now + timedelta(seconds=35), []), (now + timedelta(seconds=70), [(11, "A", at(24, 13)), (12, "A", at(25, 9))])]
    late, sealed = stepped(spark, replay + more[:2])
    assert late == [10] and sealed[-1][1:] == (at(24).date(), "quiet")
    late, sealed = stepped(spark, replay + more)
    assert late == [10, 11] and len(sealed) == 5


def test_a_day_that_is_not_over_stays_open(spark):
    batches = [(at(20, 15), [(0, "A", at(20, 14))]), (at(20, 23), []), (at(20, 23, 30), [(1, "A", at(20, 15))]), (at(21, 0, 1), [])]
    late, sealed = stepped(spark, batches)
    assert late == [] and [r for *_, r in sealed] == ["quiet"]


def test_the_job_lists_sealed_days_and_late_rows(spark, folder):
    clock = [at(28)]
    job = Ingest(spark, f"{folder}/job", None, [("log", table_sink(f"{folder}/log"))], clock=lambda: clock[0], width=8, quiet=QUIET)
    messages = [("SPY", payload(bar_type=1, ts_str=f"2026-04/{d}-10:{m}:00")) for d, m in ((20, 31), (21, 31), (21, 32))]
    every = frames(spark, [*messages, ("SPY", payload(bar_type=1, ts_str="2026-04/21-10:40:00"))])
    job.process(every.where("arrival < 3"), 0)
    clock[0] += timedelta(seconds=31)
    job.process(every.where("arrival = 9"), 1)
    job.process(every.where("arrival = 3"), 2)
    assert sorted((r.day.day, r.reason) for r in job.table("sealed").collect()) == [(20, "later_day"), (21, "quiet")]
    assert collect(job.table("late"), "arrival") == [(3,)]
    assert sorted(collect(spark.read.parquet(f"{folder}/log"), "arrival")) == [(0,), (1,), (2,)]
    # Run again, the last batch refuses the same row.
    job.process(every.where("arrival = 3"), 2)
    assert collect(job.table("late"), "arrival") == [(3,)]


def bars(spark, n):
    return points(spark, [{"arrival": n, "bar_time": at(20, 10, n)}])


def test_a_sink_gets_what_it_missed_in_order(spark, folder):
    seen, down = {"a": [], "b": []}, [True]

    def broken(df, batch_id):
        if down[0]:
            raise OSError("down")
        seen["a"].append((batch_id, df.first()["arrival"]))

    def steady(df, batch_id):
        seen["b"].append((batch_id, df.first()["arrival"]))

    ledger = Ledger(spark, f"{folder}/ledger", [("a", broken), ("b", steady)])
    assert [f[:2] for n in range(3) for f in ledger.hand_out(bars(spark, n), n)] == [(0, "a")] * 3
    assert ledger.missing("a") == [0, 1, 2] and ledger.missing("b") == []
    # Another process goes on with the same folder.
    again = Ledger(spark, f"{folder}/ledger", [("a", broken), ("b", steady)])
    down[0] = False
    assert again.hand_out(bars(spark, 3), 3) == []
    assert seen["a"] == seen["b"] == [(n, n) for n in range(4)]
    # What all have is dropped, but for the last batch, which is offered again if run again.
    assert again.hand_out(bars(spark, 9), -4) == [] and again._batches("given") == [-4]
    assert again.hand_out(bars(spark, 5), -4) == [] and seen["b"][-2:] == [(-4, 9), (-4, 5)]


def test_a_failed_sink_does_not_pass_over_a_batch(spark, folder):
    calls = []

    def second_fails_once(df, batch_id):
        calls.append(batch_id)
        if calls.count(1) == 1 and batch_id == 1:
            raise OSError("once")

    ledger = Ledger(spark, f"{folder}/ledger", [("s", second_fails_once)])
    for n in range(3):
        ledger.hand_out(bars(spark, n), n)
    assert calls == [0, 1, 1, 2] and ledger.missing("s") == []


def test_names_of_sinks_differ(spark, folder):
    with pytest.raises(ValueError, match="names of their own"):
        Ledger(spark, f"{folder}/ledger", [("a", print), ("a", print)])
