"""Small state tables carried from one micro-batch to the next.

A micro-batch is an ordinary DataFrame inside `foreachBatch`, so it runs the same
operators as a whole recording, split by segment where a symbol is hot. What it
needs from before is one row per chart or counter. Two folders are written in
turn: batch `n` reads the folder of `n - 1` and writes the other, so a batch that
is tried again finds its input unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STAMP = "_batch"


def latest_batch(spark: SparkSession, checkpoint: str) -> int | None:
    """The number of the last batch that a query has committed."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return None
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return max((int(n) for n in names if n.isdigit()), default=None)


class StateTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType) -> None:
        self._spark = spark
        self._path = path
        self._schema = schema

    def _slot(self, batch_id: int) -> str:
        return f"{self._path}/slot={batch_id % 2}"

    def before(self, batch_id: int) -> DataFrame:
        """The state that batch `batch_id` starts from."""
        if batch_id == 0:
            return self._spark.createDataFrame([], self._schema)
        stamped = T.StructType([*self._schema.fields, T.StructField(STAMP, T.LongType())])
        state = self._spark.read.schema(stamped).parquet(self._slot(batch_id - 1))
        wrong = state.where(F.col(STAMP) != batch_id - 1).select(STAMP).first()
        if wrong is not None:
            raise RuntimeError(
                f"{self._path} holds batch {wrong[0]}, expected {batch_id - 1}: "
                "state and checkpoint must stay together"
            )
        return state.drop(STAMP)

    def put(self, batch_id: int, state: DataFrame) -> None:
        rows = state.select(*self._schema.fieldNames())
        rows.withColumn(STAMP, F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(
            self._slot(batch_id)
        )
