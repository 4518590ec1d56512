"""The counting job: totals of any cut, sessions that are forgotten, numbers at the ends."""

import time

import numpy as np
import pytest
from feed import collect, frames, payload
from pyspark.sql import functions as F

from barloom.operators import decode as dec
from barloom.operators import sequence
from barloom.sources.frames import stream_frames
from barloom.streaming import loss

COLUMNS = ("topic", "frames", "messages_lost", "gaps", "regressions", "baselines")


def walked(numbers, largest=None):
    """Totals by taking the numbers one by one."""
    total = dict.fromkeys(COLUMNS[1:], 0)
    for seq in numbers:
        total["frames"] += 1
        if largest is None:
            total["baselines"] += 1
            largest = seq
            continue
        expected = min(largest + 1, loss.TOP)
        missing = min(loss.TOP, max(0, seq - expected))
        total["messages_lost"] = min(loss.TOP, total["messages_lost"] + missing)
        total["gaps"] += missing > 0
        total["regressions"] += seq < expected
        largest = max(largest, seq)
    return largest, total


@pytest.mark.parametrize("seed", range(80))
def test_segments_add_up_wherever_they_are_cut(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 50))
    numbers = np.cumsum(rng.choice([1, 1, 1, 2, 5, 0, -3], n)) + rng.integers(-9, 9)
    if seed % 4 == 0:
        numbers = rng.choice([loss.TOP, loss.TOP - 1, -loss.TOP, -loss.TOP - 1, 3, 4], n)
    numbers = numbers.astype(np.int64)
    edges = sorted({0, n, *rng.integers(1, n + 1, 4).tolist()})
    largest, total = None, dict.fromkeys(COLUMNS[1:], 0)
    for lo, hi in zip(edges, edges[1:]):
        run = {c: v.tolist() if isinstance(v, np.ndarray) else v for c, v in loss.rises(numbers[lo:hi]).items()}
        largest, more = loss.taken_up(largest, run)
        total = {c: min(loss.TOP, total[c] + more[c]) for c in total}
    assert (largest, total) == walked(numbers.tolist())


def landed(spark, folder, messages, first=0):
    part = frames(spark, messages).withColumn("arrival", F.col("arrival") + first)
    part.coalesce(1).write.mode("append").json(f"{folder}/landing")
    return stream_frames(spark, f"{folder}/landing")


def started(job, stream):
    return loss.caught_up(job.start(stream, processingTime="200 milliseconds"))


@pytest.fixture(autouse=True)
def long_memory(spark):
    """Batches run while nothing comes in; their reports must not push out the others."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "5000")
    yield
    spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def taken(query):
    """Rows of all batches so far."""
    return sum(p.numInputRows for p in query.recentProgress)


def feed(n, sid):
    """Two topics with gaps, repeats and numbers that fall back."""
    out = []
    for i in range(n):
        seq = 1 + i + i // 7 * 2 - (5 if i % 11 == 10 else 0)
        out.append((("SPY", "QQQ")[i % 5 == 0], payload(seq=seq, sid=sid + i // 40)))
    return out


@pytest.mark.parametrize("width", [3, 1 << 18])
def test_the_job_equals_the_batch_over_restarts(spark, folder, width):
    messages = feed(90, 7)
    job = loss.LossCounter(spark, f"{folder}/job", None, width=width)
    for lo, hi in ((0, 31), (31, 60), (60, 90)):
        started(job, landed(spark, folder, messages[lo:hi], lo)).stop()
    steps = sequence.steps(dec.observed(dec.decode(frames(spark, messages))))
    assert sorted(collect(job.messages_lost(), *COLUMNS)) == sorted(collect(sequence.loss_by_topic(steps), *COLUMNS))
    largest = steps.groupBy("sid", "topic").agg(F.max("seq").alias("seq"))
    assert sorted(collect(job.counters(), "sid", "topic", "seq")) == sorted(collect(largest, "sid", "topic", "seq"))


def test_quiet_sessions_leave_the_state_and_totals_stay(spark, folder):
    """Many sessions come and go: the state holds the live ones, the totals hold all."""
    job = loss.LossCounter(spark, f"{folder}/job", None, ttl_ms=4000)
    sizes, messages = [], []
    query = None
    for wave in range(3):
        some = [("SPY", payload(sid=100 * wave + s, seq=seq)) for s in range(40) for seq in (1, 2, 5)]
        stream = landed(spark, folder, some, len(messages))
        query = query or job.start(stream, processingTime="200 milliseconds")
        messages += some
        until = time.time() + 60
        while taken(query) < len(messages) and time.time() < until:
            time.sleep(0.2)
        sizes.append(job.counters().count())
        time.sleep(5)
    until = time.time() + 60
    while job.counters().count() > 0 and time.time() < until:
        time.sleep(1)
    left = job.counters().count()
    query.stop()
    assert max(sizes) <= 40 and left == 0
    assert collect(job.messages_lost(), *COLUMNS) == [("SPY", 360, 240, 120, 0, 120)]


def test_a_forgotten_session_starts_anew(spark, folder):
    job = loss.LossCounter(spark, f"{folder}/job", None, ttl_ms=2000)
    query = started(job, landed(spark, folder, [("SPY", payload(sid=1, seq=1))]))
    time.sleep(4)
    landed(spark, folder, [("SPY", payload(sid=1, seq=90)), ("SPY", payload(sid=1, seq=92))], 1)
    until = time.time() + 60
    while taken(query) < 3 and time.time() < until:
        time.sleep(0.2)
    query.stop()
    assert collect(job.messages_lost(), *COLUMNS) == [("SPY", 3, 1, 1, 0, 2)]


def test_a_batch_planned_before_the_last_stop_is_no_sign_of_having_caught_up():
    from types import SimpleNamespace

    reports = [(7, 0), (7, 0), (8, 45), (9, 0)]  # batch 7 was planned before part two landed

    class Query:
        asked = 0

        @property
        def recentProgress(self):
            batch, rows = reports[min(self.asked, 3)]
            self.asked += 1
            return [SimpleNamespace(batchId=batch, numInputRows=rows)]

        def exception(self):
            return None

    query = Query()
    assert loss.caught_up(query, 10) is query and query.asked == 4
