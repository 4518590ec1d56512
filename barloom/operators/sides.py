"""Intermediate tables in the shared folder."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame

from barloom.session import shared_dir


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a result to the shared folder and read it back.

    It is computed once however often it is used, survives lost executors, and
    its file size is known to the planner, which broadcasts it only if it is
    below `spark.sql.autoBroadcastJoinThreshold`.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/staged/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
