"""Frames: raw `(topic, payload)` messages, kept verbatim."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.schemas import FRAME

TEXT_COLUMNS = ["topic", "payload", "payload_invalid_utf8"]


def read_recording(spark: SparkSession, path: str) -> DataFrame:
    """Read recorded JSON lines without landing number; their order is file order.

    `arrival` is the rows before this row's file block (a sum over blocks, not
    rows) plus its position inside the block. Blank lines are skipped.
    """
    schema = FRAME.fieldNames()
    text = [f for f in FRAME.fields if f.name in TEXT_COLUMNS]
    lines = (
        spark.read.schema(type(FRAME)(text))
        .json(path)
        .select(
            *TEXT_COLUMNS,
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    blocks = lines.groupBy("_file", "_block").agg(F.count("*").alias("_n"))
    in_order = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "_file", "_block", F.coalesce(F.sum("_n").over(in_order), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy("_file", "_block").orderBy("_row")
    placed = lines.withColumn("_pos", F.row_number().over(inside)).join(offsets, ["_file", "_block"])
    return placed.select(
        (F.col("_offset") + F.col("_pos") - 1).cast("bigint").alias("arrival"),
        *TEXT_COLUMNS,
        F.lit(None).cast("timestamp").alias("landed_at"),
    ).select(*schema)


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    """Read landed JSON lines that carry their `arrival` number."""
    return spark.read.schema(FRAME).json(path)


def stream_frames(spark: SparkSession, path: str, max_files: int = 64) -> DataFrame:
    """Follow a folder of landed JSON lines, a bounded number of files per trigger."""
    return spark.readStream.schema(FRAME).option("maxFilesPerTrigger", max_files).json(path)


def frames_from_log(messages: DataFrame, partitions: int = 1) -> DataFrame:
    """Frames from a message log's `(key, value, partition, offset, timestamp)` columns.

    `partitions` is the number of the log's partitions. `arrival` counts through them in
    turn, so it is unique, keeps the order of each partition and grows as densely as the
    partitions fill evenly. A topic's frames must share a partition to keep their order.
    Bytes that are not UTF-8 are kept apart, as replacement text.
    """
    place = F.col("partition") if "partition" in messages.columns else F.lit(0)
    known = F.when(place < partitions, place).otherwise(
        F.raise_error(F.lit(f"the log has more than {partitions} partitions"))
    )
    text = F.expr("try_validate_utf8(cast(value AS STRING))")
    return messages.select(
        (F.col("offset").cast("bigint") * partitions + known).alias("arrival"),
        F.expr("make_valid_utf8(cast(key AS STRING))").alias("topic"),
        text.alias("payload"),
        F.when(text.isNull(), F.expr("make_valid_utf8(cast(value AS STRING))")).alias(
            "payload_invalid_utf8"
        ),
        F.col("timestamp").alias("landed_at"),
    )


def write_frames(frames: DataFrame, path: str, mode: str = "append") -> None:
    """Append frames as JSON lines, payload untouched, before any parsing."""
    frames.write.mode(mode).option("ignoreNullFields", "true").json(path)
