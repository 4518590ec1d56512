"""Lost messages from publisher sequence numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions import whole
from barloom.operators.ordered import SEGMENT_WIDTH, max_before, seeded, unseeded

COUNTER = ["sid", "topic"]


def steps(
    observed: DataFrame, history: DataFrame | None = None, width: int = SEGMENT_WIDTH
) -> DataFrame:
    """Per frame: the number expected, the messages lost before it, and regressions.

    A counter belongs to one publisher session and topic. Its first frame sets
    the baseline, a smaller number than expected leaves the expectation alone.
    Numbers stay in BIGINT: after its largest one, that is still expected.
    `history` holds the largest `seq` per counter of earlier data.
    """
    ready = seeded(observed, COUNTER, "arrival", maxima=["seq"], history=history, width=width)
    largest = unseeded(ready.withColumn("largest", max_before("seq", COUNTER, "arrival")))
    return largest.withColumn("expected", whole.plus(F.col("largest"), F.lit(1))).select(
        "arrival",
        *COUNTER,
        "seq",
        "expected",
        F.greatest(
            F.coalesce(whole.minus(F.col("seq"), F.col("expected")), F.lit(0)), F.lit(0)
        ).alias("lost"),
        F.coalesce(F.col("seq") < F.col("expected"), F.lit(False)).alias("regressed"),
    )


def loss_by_topic(seq_steps: DataFrame) -> DataFrame:
    return seq_steps.groupBy("topic").agg(
        F.count("*").alias("frames"),
        whole.total(F.col("lost")).alias("messages_lost"),
        F.count_if(F.col("lost") > 0).alias("gaps"),
        F.count_if("regressed").alias("regressions"),
        F.count_if(F.col("expected").isNull()).alias("baselines"),
    )


def loss_total(seq_steps: DataFrame) -> DataFrame:
    """One row; `messages_lost` is NULL when no numbered frame was seen."""
    return seq_steps.agg(
        F.count("*").alias("frames"),
        whole.total(F.col("lost")).alias("messages_lost"),
        (F.count("*") > 0).alias("gap_detection_available"),
    )


def counters(seq_steps: DataFrame) -> DataFrame:
    """What the next batch needs to go on: the largest number per counter."""
    return seq_steps.groupBy(*COUNTER).agg(
        F.max("seq").alias("seq"),
        F.count("*").alias("frames"),
        whole.total(F.col("lost")).alias("lost"),
    )
