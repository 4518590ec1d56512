"""The corpus pipeline: quality, lines, near-duplicates, benchmark leaks, token ids.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame. All but the last give the
columns of `documents`; the last one adds the token ids. Rows of a null id and rows that
repeat an id are documents like others: decisions hold for an id together with its text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import bpe, chosen_path, lines, quality, queries, templates
from barloom.llm.common import Scratch, unused

#: SQL has neither SimHash lines, nor the tokenizer; the tests compare with plain Python.
ORACLE_SQL = None


def bounded(spark: SparkSession) -> None:
    """Settings under which stages carry whole texts: Arrow batches and row groups of a few MB."""
    queries.prepared(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    spark.conf.set("parquet.block.size", str(32 << 20))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """`docs` without those whose (doc_id, text_hash) is in `gone`."""
    g = unused("gone", docs)
    gone = gone.select(F.struct("doc_id", "text_hash").alias(g))
    same = F.col("doc_id").eqNullSafe(F.col(f"{g}.doc_id")) & (F.xxhash64("text") == F.col(f"{g}.text_hash"))
    return docs.join(gone, same, "left_anti")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed rules and the limits of their language and source accept."""
    bounded(spark)
    others = F.struct(*[c for c in docs.columns if c != "text"]).alias("row")
    kept = quality.judged(docs.select("text", "lang", "source", others)).where("kept")
    return kept.select(*[F.col("text" if c == "text" else f"row.{c}") for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One occurrence of every group of similar lines; documents without a word left go."""
    bounded(spark)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    cleaned = lines.dedup_lines(docs.select("doc_id", "text", F.struct("doc_id", *others).alias("row")))
    changed = F.col("n_removed") > 0
    columns = {c: F.col(f"row.{c}") for c in others} | {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(changed, F.length("text").cast("bigint")).otherwise(columns["n_chars"])
    kept = cleaned.where(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return kept.select(*[columns[c].alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near copies, the first by id, text and the other columns.

    Null ids come last; rows alike in everything are told apart by a number written once.
    """
    bounded(spark)
    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64("text"), F.xxhash64(*docs.columns), F.monotonically_increasing_id()]
    place = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(order)])
    placed = Scratch(spark, "near-dup").keep(docs.select(F.struct(*docs.columns).alias("row"), place.alias("place")), "placed")
    judged = chosen_path.near_duplicates(placed.select("place", "row.text"), id_col="place")
    gone = judged.where("not kept").select(F.col("place.c4").alias("gone"))
    return placed.join(gone, F.col("place.c4") == F.col("gone"), "left_anti").select("row.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, re-parameterised or not."""
    bounded(spark)
    benchmark = queries.table(spark, sf_dir, "benchmark")
    return without(docs, templates.leaks(docs, benchmark))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their ids, the number of these, and whether they decode to the text."""
    bounded(spark)
    encoded = bpe.encode(docs, queries.RANKS, queries.PATTERN, offsets=False)
    decoded = bpe.decode(encoded, queries.RANKS, queries.PATTERN)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return decoded.withColumns(
        {"n_tokens": F.size("ids").cast("bigint"), "round_trip": F.col("decoded") == text}
    ).drop("decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_rules),
    ("lines", line_dedup),
    ("near_dup", near_dedup),
    ("decontaminate", decontaminate),
    ("token_ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; every result but the last is written to the shared folder once."""
    scratch = Scratch(spark, "pipeline")
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
