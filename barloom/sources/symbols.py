"""The symbol dimension: category, role and session policy."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from barloom.schemas import SYMBOLS

PREMARKET_MINUTES = 60


def with_policy_defaults(raw: DataFrame) -> DataFrame:
    """Fill the session policy from the category where a symbol sets none.

    Breadth indices clear at each session and keep no pre-market history; all
    others keep 60 minutes ahead of the open.
    """
    breadth = F.col("category") == "breadth"
    return raw.select(
        "id",
        "category",
        "role",
        F.coalesce("session_reset", breadth).alias("session_reset"),
        F.coalesce(
            "pre_market_window_minutes", F.when(~breadth, F.lit(PREMARKET_MINUTES))
        ).alias("pre_market_window_minutes"),
    )


def symbols_table(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """The dimension from configuration entries.

    As an Arrow table its size is known to the planner, which broadcasts it if it is
    below `spark.sql.autoBroadcastJoinThreshold`.
    """
    columns = {c: [r.get(c) for r in rows] for c in SYMBOLS.fieldNames()}
    table = pa.table(columns, schema=to_arrow_schema(SYMBOLS))
    return with_policy_defaults(spark.createDataFrame(table, SYMBOLS))


def read_symbols(spark: SparkSession, path: str) -> DataFrame:
    """The dimension from JSON lines."""
    return with_policy_defaults(spark.read.schema(SYMBOLS).json(path))


def with_role(symbols: DataFrame, role: str) -> DataFrame:
    """Ids of the symbols to trade, or to observe as context."""
    return symbols.where(F.col("role") == role).select("id")


def policies(symbols: DataFrame) -> DataFrame:
    return symbols.select(
        F.col("id").alias("symbol"), "session_reset", "pre_market_window_minutes"
    )
