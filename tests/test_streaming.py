"""The live job: stepwise closing, restarts, sinks and batch equality."""

from datetime import timedelta

import pytest
from feed import collect, frames, hello, minute, payload, points
from pyspark.sql import functions as F
from test_ordered import closed_by_loop, random_points

from barloom.operators import closing, sequence
from barloom.operators import decode as dec
from barloom.sources import store
from barloom.sources.symbols import symbols_table
from barloom.streaming import closing_step
from barloom.streaming.heartbeat import Heartbeat
from barloom.streaming.ingest import Ingest
from barloom.streaming.sinks import Handlers, fan_out, store_sink, table_sink

NO_STATE = closing_step.CHART_STATE


def steps(spark, parts, folder, clocks=None):
    """Closed arrivals after each part, and what waits at the end."""
    state, out = spark.createDataFrame([], NO_STATE), []
    for i, part in enumerate(parts):
        now = None if clocks is None else F.lit(clocks[i].replace(tzinfo=None)).cast("timestamp")
        _, closed, waiting = closing_step.step(points(spark, part), state, now, width=8)
        out.append(sorted(r[0] for r in collect(closed, "arrival")))
        after = closing_step.next_state(state, closed, waiting)
        after.select(*NO_STATE.fieldNames()).write.parquet(f"{folder}/state-{i}")
        state = spark.read.schema(NO_STATE).parquet(f"{folder}/state-{i}")
    return out, sorted(r[0] for r in collect(state.where("bar_time IS NOT NULL"), "arrival"))


def test_stepwise_closing_equals_one_recording(spark, folder):
    rows = [{"arrival": i, **r} for i, r in enumerate(random_points(11))]
    closed, waiting = steps(spark, [rows[:90], rows[90:95], rows[95:]], folder)
    assert sorted([a for part in closed for a in part] + waiting) == closed_by_loop(rows)[0]


def test_the_clock_closes_a_quiet_chart(spark, folder):
    refresh = {"bar_time": minute(5)}
    parts = [
        [{"arrival": 0, **refresh}],
        [{"arrival": 1, **refresh}],
        [{"arrival": 2, **refresh}, {"arrival": 3, "bar_time": minute(6)}],
    ]
    clocks = [minute(5) + timedelta(seconds=s) for s in (1, 2, 3)]
    closed, waiting = steps(spark, parts, folder, clocks)
    assert (closed, waiting) == ([[], [1], []], [3])


def job_frames(n=60):
    """Points of a minute chart with refreshes, gaps, bad frames and hellos."""
    out = []
    for i in range(n):
        clock = f"2026-04/20-09:{31 + i // 4:02d}:00"
        chart = {"bar_type": 1, "ts_str": clock, "c": 450.0 + i, "ts": 1e9 + i}
        out.append(("SPY", payload(seq=1 + i + i // 10, **chart)))
    out[7] = ("SPY", "junk")
    out[20] = ("__ts2py__", hello())
    out[31] = ("SPYG", payload())
    out[44] = ("SPY", payload(seq=200, bar_type=0, ts_str="2026-04/20-09:45:10"))
    return out


@pytest.fixture
def ran(spark, folder):
    symbols = symbols_table(spark, [{"id": "SPY", "category": "etf", "role": "trade"}])
    everything = frames(spark, job_frames())
    calls, handlers = [], Handlers()
    handlers.on("SPY", lambda df, b: calls.append((b, df.count())))
    handlers.on("QQQ", lambda df, b: calls.append((b, -df.count())))
    handlers.on_any(lambda df, b: 1 / 0)
    sinks = [
        ("broken", lambda df, b: 1 / 0),
        ("store", store_sink(f"{folder}/store", f"{folder}/staging")),
        ("handlers", handlers),
        ("log", table_sink(f"{folder}/log")),
    ]
    job = Ingest(spark, f"{folder}/job", symbols, sinks, width=8)
    beat = Heartbeat()
    spark.streams.addListener(beat)
    for lo, hi in ((0, 13), (13, 30), (30, 60)):
        part = everything.where(F.col("arrival").between(lo, hi - 1)).coalesce(1)
        part.write.mode("append").json(f"{folder}/landing")
        from barloom.sources.frames import stream_frames

        job.start(stream_frames(spark, f"{folder}/landing"), availableNow=True).awaitTermination()
    spark.streams.removeListener(beat)
    return job, everything, symbols, calls, beat, folder


def test_live_job_equals_batch(spark, ran):
    job, everything, symbols, calls, beat, folder = ran
    decoded = dec.decode(everything, symbols)
    want = sorted(r[0] for r in collect(closing.close_bars(dec.points(decoded)), "arrival"))
    closed = job.table("closed").drop("batch").unionByName(job.drained())
    assert sorted(r[0] for r in collect(closed, "arrival")) == want
    assert collect(job.table("refused"), "arrival", "refusal_reason") == [(7, "bad_json")]
    assert job.table("announcements").count() == 1

    # One broken sink stopped no other sink, and one broken handler no handler.
    assert {r["sink"] for r in job.table("failures").collect()} == {"broken"}
    given_out = job.table("closed").count()
    assert spark.read.parquet(f"{folder}/log").count() == given_out
    assert sum(n for _, n in calls) == given_out
    in_store = store.scan(spark, f"{folder}/store", 1, 1).count()
    assert in_store + store.scan(spark, f"{folder}/store", 0, 1).count() == given_out


def test_a_batch_can_be_run_again(spark, ran):
    job, everything, *_ = ran
    before = sorted(collect(job.table("closed"), "arrival", "batch"))
    job.process(everything.where("arrival >= 30"), 2)
    assert sorted(collect(job.table("closed"), "arrival", "batch")) == before
    with pytest.raises(RuntimeError, match="stay together"):
        job.process(everything, 9)


def test_counters_are_read_together(spark, folder):
    """Refreshes over batches, a stale point, a refused frame and a narrowed bar."""
    def minute_point(m, **changes):
        return "SPY", payload(bar_type=1, ts_str=f"2026-04/20-09:{m}:00", **changes)

    messages = [
        minute_point(31), minute_point(31), minute_point(32), minute_point(31), ("SPY", "junk"),
        minute_point(32, h=73.5), ("QQQ", payload(bar_type=0)), minute_point(33), minute_point(33),
    ]
    every = frames(spark, messages)
    job = Ingest(spark, f"{folder}/job", None, width=2)
    beat = Heartbeat(counters=job.counters, lost=lambda: 5)
    assert beat._read(0, 1000)["messages_lost"] == 5
    for batch, (lo, hi) in enumerate(((0, 4), (0, 4), (5, 6), (7, 8))):
        # The first batch is run twice, as after a crash.
        job.process(every.where(F.col("arrival").between(lo, hi)), max(0, batch - 1))
    assert job.counters(0) | {"symbols": 1} == job.counters(0)
    want = {
        "frames_in": 9, "refused": 1, "direct_in": 7, "stale": 1, "ticks_out": 1, "bars_out": 3,
        "waiting": 1, "refreshed": 3, "subminute_suspected": 1, "late": 0, "symbols": 2,
    }
    assert job.counters(2) == want


def test_handlers_can_be_removed(spark):
    seen, handlers = [], Handlers()
    note = lambda df, b: seen.append(b)
    handlers.on_any(note)
    handlers(points(spark, [{"bar_time": minute(0)}]), 1)
    assert handlers.remove(note) and not handlers.remove(note)
    handlers(points(spark, [{"bar_time": minute(0)}]), 2)
    assert seen == [1]
    assert fan_out(points(spark, [{"bar_time": minute(0)}]), 3, [("x", lambda d, b: 1 / 0)])[0][:2] == (3, "x")


def landed(spark, folder, parts):
    """One file per part, in turn."""
    for part in parts:
        part.coalesce(1).write.mode("append").json(f"{folder}/landing")


def test_answers_come_from_the_last_batch_whatever_its_number(spark, folder):
    from barloom.sources.frames import stream_frames

    everything = frames(spark, job_frames())
    landed(spark, folder, [everything.where(F.col("arrival").between(i, i + 11)) for i in range(0, 60, 12)])
    job = Ingest(spark, f"{folder}/job", None, width=8)
    assert job.latest() is None and job.drained().count() == 0
    job.start(stream_frames(spark, f"{folder}/landing", max_files=1), availableNow=True).awaitTermination()
    assert job.latest() == 4
    decoded = dec.decode(everything)
    closed = job.table("closed").drop("batch").unionByName(job.drained())
    want = sorted(r[0] for r in collect(closing.close_bars(dec.points(decoded)), "arrival"))
    assert sorted(r[0] for r in collect(closed, "arrival")) == want


def test_a_quiet_chart_is_closed_by_the_clock_of_the_running_job(spark, folder):
    import time

    from barloom.sources.frames import stream_frames

    now = [minute(0)]
    job = Ingest(spark, f"{folder}/job", None, [("log", table_sink(f"{folder}/log"))], clock=lambda: now[0], width=8)
    landed(spark, folder, [frames(spark, [("SPY", payload(bar_type=1, ts_str="2026-04/20-09:31:00"))])])
    query = job.start(stream_frames(spark, f"{folder}/landing"), processingTime="0 seconds")

    def out():
        try:
            return spark.read.parquet(f"{folder}/log").count()
        except Exception:
            return 0

    until = time.time() + 120
    while (job.latest() is None or job.drained().count() == 0) and time.time() < until:
        time.sleep(0.5)
    assert out() == 0
    now[0] = minute(1) + timedelta(seconds=8)
    while out() == 0 and time.time() < until:
        time.sleep(0.5)
    query.stop()
    assert out() == 1
    job.start(stream_frames(spark, f"{folder}/landing"), availableNow=True).awaitTermination()
    assert out() == 1


def test_drained_bars_reach_the_sinks_once(spark, folder):
    from barloom.sources.frames import stream_frames

    def go(job):
        job.start(stream_frames(spark, f"{folder}/landing", 1), availableNow=True).awaitTermination()

    job = Ingest(spark, f"{folder}/job", None, [("log", table_sink(f"{folder}/log"))], width=8)
    point = {"bar_type": 1, "ts_str": "2026-04/20-09:31:00"}
    landed(spark, folder, [frames(spark, [("SPY", payload(**point))])])
    go(job)
    assert job.drain().count() == 1 and job.drained().count() == 0
    assert spark.read.parquet(f"{folder}/log").count() == 1
    again = frames(spark, [("SPY", payload(**point)), ("SPY", payload(bar_type=1, ts_str="2026-04/20-09:32:00"))])
    landed(spark, folder, [again.withColumn("arrival", F.col("arrival") + 1)])
    go(job)
    assert spark.read.parquet(f"{folder}/log").count() == 1
    assert job.table("stale").count() == 0 and job.drained().count() == 1 or job.table("stale").count() == 1


def test_two_log_partitions_lose_nothing(spark, folder):
    from barloom.sources.frames import frames_from_log

    messages = spark.createDataFrame(
        [(t, payload(seq=i), p, i) for i in range(4) for p, t in enumerate(("SPY", "QQQ"))],
        "key string, value string, partition int, offset bigint",
    ).selectExpr("cast(key AS BINARY) key", "cast(value AS BINARY) value", "partition", "offset", "now() timestamp")
    got = frames_from_log(messages, partitions=2)
    assert sorted(collect(got, "arrival")) == [(i,) for i in range(8)]
    with pytest.raises(Exception, match="more than 1 partitions"):
        frames_from_log(messages).collect()


def test_extreme_numbers_end_no_job(spark):
    top = 2**63 - 1
    out = [("SPY", payload(seq=s, el_volume=v, el_ticks=v, el_upticks=v, el_downticks=v)) for s, v in ((top, top), (-top, 1), (top, top), (3, -top))]
    decoded = dec.decode(frames(spark, out))
    found = sequence.steps(dec.observed(decoded)).orderBy("arrival").collect()
    assert [r.lost for r in found] == [0, 0, 0, 0] and [r.regressed for r in found] == [False, True, False, True]
    rising = dec.decode(frames(spark, [("SPY", payload(seq=s)) for s in (-top, top, top)]))
    assert sequence.loss_total(sequence.steps(dec.observed(rising))).first()["messages_lost"] == top
    from barloom.operators import quality

    assert quality.identity_checks(dec.points(decoded)).first()["rows"] >= 1
    totals = quality.total_volume(store.as_bars(dec.points(decoded))).first()
    assert totals["total_volume"] is not None


def test_jobs_that_catch_up_together_share_the_landed_frames(spark, monkeypatch):
    from barloom.plans import stream_queries as sq

    landed, followed = [], []
    monkeypatch.setattr(sq.fr, "write_frames", lambda part, path: landed.append(path))
    monkeypatch.setattr(sq.fr, "stream_frames", lambda spark, path, max_files: path)
    sq.catching_up(spark, "/root/testdata/sf0.001", lambda s: followed.append(("a", s)), lambda s: followed.append(("b", s)))
    assert len(landed) == 2 and len(set(landed)) == 1
    assert followed == [(job, landed[0]) for _ in range(2) for job in "ab"]
