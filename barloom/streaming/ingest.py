"""The live job: frames to closed bars and dead letters; `loss` counts lost messages.

Every micro-batch runs the batch operators on its rows and the state tables. All
outputs are one folder per batch and replaced on a retry, so they hold each batch
exactly once. No frame can stop the stream: decoding uses `try_` expressions, and every
sink has its own ledger, which offers it what it missed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barloom.operators import decode as dec
from barloom.operators import closing, sealing
from barloom.operators.ordered import SEGMENT_WIDTH
from barloom.schemas import TICK
from barloom.streaming import closing_step
from barloom.streaming.heartbeat import COUNTERS, Beat
from barloom.streaming.ledger import Ledger
from barloom.streaming.sinks import Writer
from barloom.streaming.state import StateTable, latest_batch

FAILURES = "batch_id bigint, sink string, missed bigint, error string"


class Ingest:
    """A restartable job under one `root` folder.

    `clock` gives the time by which quiet charts are closed; without it a bar
    waits for its successor, and a day for a later one. A day that is over is sealed when
    its chart has been quiet for `quiet`. `width` is the segment width of ordered scans.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        subscribed: DataFrame | None,
        sinks: Sequence[tuple[str, Writer]] = (),
        clock: Callable[[], datetime] | None = None,
        width: int = SEGMENT_WIDTH,
        quiet: timedelta = sealing.QUIET,
    ) -> None:
        self.root = root.rstrip("/")
        self._spark = spark
        self._subscribed = subscribed
        self._clock = clock
        self._quiet = quiet
        self._ledger = Ledger(spark, f"{self.root}/ledger", sinks)
        self._width = width
        self._charts = StateTable(spark, f"{self.root}/state/charts", closing_step.CHART_STATE)
        self._sealed = StateTable(spark, f"{self.root}/state/sealed", sealing.STATE)

    def _table(self, name: str, batch_id: int, df: DataFrame, beat: Beat | None = None) -> DataFrame:
        path = f"{self.root}/{name}/batch={batch_id}"
        if beat is not None:
            df = beat.watched(df, name)
        df.write.mode("overwrite").parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def table(self, name: str) -> DataFrame:
        """An output over all batches so far."""
        return self._spark.read.parquet(f"{self.root}/{name}")

    def process(self, frames: DataFrame, batch_id: int) -> None:
        """Run one micro-batch; safe to run again."""
        frames = frames.where("arrival IS NOT NULL")  # the clock's rows carry nothing
        beat = Beat()
        decoded = self._table("decoded", batch_id, dec.decode(frames, self._subscribed), beat)
        self._table("refused", batch_id, dec.refused(decoded), beat)
        self._table("announcements", batch_id, dec.announcements(decoded))
        self._close(dec.points(decoded), batch_id, beat)
        charts = self._charts.before(batch_id + 1).select("symbol")
        seen = charts.unionByName(self._sealed.before(batch_id + 1).select("symbol"))
        before = self.counters(batch_id - 1) if batch_id > 0 else None
        totals = beat.totals(before, seen.agg(F.count_distinct("symbol")).first()[0])
        self._table("counters", batch_id, self._spark.createDataFrame([totals], COUNTERS))

    def counters(self, batch_id: int | None = None) -> dict | None:
        """What the job has counted up to a batch, the last one by default; None before any."""
        last = self.latest() if batch_id is None else batch_id
        if last is None:
            return None
        return self._spark.read.schema(COUNTERS).parquet(f"{self.root}/counters/batch={last}").first().asDict()

    def _close(self, points: DataFrame, batch_id: int, beat: Beat) -> None:
        now = None
        if self._clock is not None:
            utc = self._clock().astimezone(timezone.utc).replace(tzinfo=None)
            now = F.lit(utc).cast("timestamp_ntz").cast("timestamp")
        state = self._charts.before(batch_id)
        marked = self._table("direct", batch_id, closing_step.mark(points, state, self._width), beat)
        self._table("stale", batch_id, marked.where("stale"))
        kept = closing_step.in_hand(marked, state)
        suspected = closing.refresh_steps(kept, self._width).where("subminute_suspected")
        self._table("suspected", batch_id, suspected.select(*closing.BAR_KEY, "arrival"), beat)
        closed, waiting = closing_step.closed_and_waiting(kept, now)
        ticks = points.where(F.col("bar_type") == TICK).select(*closed.columns)
        waiting = self._table("waiting", batch_id, waiting, beat)
        closed = self._table("closed", batch_id, closed.unionByName(ticks), beat)
        self._charts.put(batch_id, closing_step.next_state(state, closed, waiting))

        before = self._sealed.before(batch_id)
        aged = before if now is None else sealing.quiet_days(before, now, self._quiet)
        split = self._table("split", batch_id, sealing.split(closed, aged, self._width))
        self._table("late", batch_id, split.where("late").drop("late"), beat)
        self._table("sealed", batch_id, sealing.newly_sealed(before, aged, split))
        written = F.current_timestamp() if now is None else now
        self._sealed.put(batch_id, sealing.next_state(aged, split, written))

        self._give_out(split.where("NOT late").drop("late", "day"), batch_id)

    def _give_out(self, bars: DataFrame, batch_id: int) -> None:
        failures = self._ledger.hand_out(bars, batch_id)
        if failures:
            rows = [(batch_id, sink, missed, error) for missed, sink, error in failures]
            self._table("failures", batch_id, self._spark.createDataFrame(rows, FAILURES))

    def missing(self, sink: str) -> list[int]:
        """Batches that a sink has not taken in yet, oldest first; see `ledger`."""
        return self._ledger.missing(sink)

    def latest(self) -> int | None:
        """The last batch that is complete."""
        return latest_batch(self._spark, f"{self.root}/checkpoint")

    def drained(self) -> DataFrame:
        """Bars still waiting after the last batch; a stopped replay adds these."""
        last = self.latest()
        if last is None:
            return self._spark.createDataFrame([], closing_step.POINT)
        path = f"{self.root}/waiting/batch={last}"
        return self._spark.read.schema(closing_step.POINT).parquet(path)

    def drain(self) -> DataFrame:
        """Give the waiting bars of a stopped job to the sinks and forget them.

        They go out as batch `-1 - last`, so a sink that is handed them again replaces
        them. The state learns how far its charts are closed: a job started again takes
        their later refreshes for stale and gives nothing out twice.
        """
        last = self.latest()
        if last is None:
            return self.drained()
        batch_id = -1 - last
        bars = self._table("closed", batch_id, self.drained())
        self._give_out(bars, batch_id)
        nothing = self._spark.createDataFrame([], closing_step.POINT)
        state = closing_step.next_state(self._charts.before(last + 1), bars, nothing)
        # The state is read from where it is written to.
        aside = f"{self.root}/state/drain"
        state.write.mode("overwrite").parquet(aside)
        self._charts.put(last, self._spark.read.schema(state.schema).parquet(aside))
        self._table("waiting", last, nothing)
        return bars

    def start(self, frames: DataFrame, **trigger) -> StreamingQuery:
        """Follow a stream of frames; `trigger` as in `writeStream.trigger`.

        With a `clock`, a source of one empty row a second runs beside the frames, so
        that quiet charts are closed while nothing arrives. A job that has run with a clock
        must be started again with one: its checkpoint knows both sources.
        """
        metered = frames.observe(
            "frames",
            F.count(F.lit(1)).alias("frames_in"),
            F.approx_count_distinct("topic").alias("topics"),
        )
        if self._clock is not None:
            second = self._spark.readStream.format("rate").option("rowsPerSecond", 1).load()
            empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in metered.schema]
            metered = metered.unionByName(second.select(*empty))
        return (
            metered.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", f"{self.root}/checkpoint")
            .trigger(**(trigger or {"processingTime": "1 second"}))
            .start()
        )
