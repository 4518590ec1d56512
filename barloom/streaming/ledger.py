"""Which sink has taken in which batch.

Each batch of closed bars is kept under `given/` until every sink has it. A sink's progress
is one empty marker file per batch, made after the sink has returned, so a stopped job
hands a batch out again rather than losing it; sinks replace a batch that comes twice. A
sink that failed is offered its missing batches in order before any new one, and never
holds up the others.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from barloom.streaming.sinks import Writer

log = logging.getLogger(__name__)


def _turn(batch_id: int) -> tuple[int, int]:
    """Place of a batch in time: what is drained after batch n has the number -1 - n."""
    return (batch_id, 0) if batch_id >= 0 else (-1 - batch_id, 1)


class Ledger:
    def __init__(self, spark: SparkSession, root: str, sinks: Sequence[tuple[str, Writer]]) -> None:
        names = [name for name, _ in sinks]
        if len(set(names)) < len(names):
            raise ValueError(f"sinks need names of their own: {names}")
        self._spark, self._root, self._sinks = spark, root, list(sinks)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._path = hadoop.Path
        self._fs = hadoop.Path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _batches(self, folder: str) -> list[int]:
        path = self._path(f"{self._root}/{folder}")
        names = [f.getPath().getName() for f in self._fs.listStatus(path)] if self._fs.exists(path) else []
        return sorted((int(n.removeprefix("batch=")) for n in names if n.startswith("batch=")), key=_turn)

    def missing(self, sink: str) -> list[int]:
        """Batches that a sink has not taken in yet, oldest first."""
        done = set(self._batches(f"done/{sink}"))
        return [b for b in self._batches("given") if b not in done]

    def _mark(self, sink: str, batch_id: int) -> None:
        self._fs.create(self._path(f"{self._root}/done/{sink}/batch={batch_id}"), True).close()

    def _kept(self, batch_id: int, schema) -> DataFrame:
        return self._spark.read.schema(schema).parquet(f"{self._root}/given/batch={batch_id}")

    def hand_out(self, bars: DataFrame, batch_id: int) -> list[tuple[int, str, str]]:
        """Offer a batch to every sink, after what it has missed; (batch, sink, error) of failures.

        A batch that is run again is offered again to all.
        """
        if not self._sinks:
            return []
        for name, _ in self._sinks:
            self._fs.delete(self._path(f"{self._root}/done/{name}/batch={batch_id}"), False)
        bars.write.mode("overwrite").parquet(f"{self._root}/given/batch={batch_id}")
        failures = [f for name, write in self._sinks if (f := self._offer(name, write, bars.schema))]
        self._forget()
        return failures

    def _offer(self, name: str, write: Callable[[DataFrame, int], None], schema) -> tuple[int, str, str] | None:
        for batch_id in self.missing(name):
            try:
                write(self._kept(batch_id, schema), batch_id)
            except Exception as exc:
                log.exception("sink %s failed on batch %s", name, batch_id)
                return batch_id, name, f"{type(exc).__name__}: {exc}"
            self._mark(name, batch_id)
        return None

    def _forget(self) -> None:
        """Drop the batches that all sinks have, but for the last, which may be run again."""
        given = self._batches("given")
        wanted = {b for name, _ in self._sinks for b in self.missing(name)}
        for batch_id in given[:-1]:
            if batch_id not in wanted:
                self._fs.delete(self._path(f"{self._root}/given/batch={batch_id}"), True)
                for name, _ in self._sinks:
                    self._fs.delete(self._path(f"{self._root}/done/{name}/batch={batch_id}"), False)
