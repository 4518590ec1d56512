"""Shards whose rows mix all sources in the corpus's own proportions.

The rows of each source are shuffled by a seeded hash and numbered; row r of n gets the
fraction (2 r + 1) / 2 n. In the order of these fractions every stretch holds the sources
in proportion, so cutting it into equal parts gives shards that all match the mixture.
Both numberings are range shuffles with per-partition offsets, so a source with a third
of all rows is spread over as many tasks as its rows need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import Scratch, numbered


def interleaved(
    docs: DataFrame, shards: int, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """(id, source, size, text_crc32, shard, slot) of every row.

    Shard sizes differ by one row at most; a shard's rows of one source differ by less than
    two from the source's share. `slot` numbers a shard's rows without gaps from 0. `size`
    is the text's UTF-8 bytes plus 16; a null text counts as an empty one. A null source
    is a source, a null id an id. Rows that repeat an id are ordered by their texts'
    checksums and sizes; rows alike in all of that may change places. Other columns are not
    looked at. An empty table gives no rows; with fewer rows than shards, some stay empty.
    """
    scratch = Scratch(docs.sparkSession, "interleave")
    binary = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).alias("id_"),
        F.col(source_col).alias("source_"),
        (F.octet_length(binary) + 16).cast("bigint").alias("size"),
        F.crc32(binary).alias("text_crc32"),
    )
    rows = rows.withColumn("shuffled", F.xxhash64(F.lit(seed), "id_", "text_crc32"))
    ties = [F.col(c) for c in ("shuffled", "id_", "text_crc32", "size")]
    ranked = numbered(rows, [F.col("source_"), *ties], scratch, "rank_at")
    totals = ranked.groupBy("source_").agg(F.min("rank_at").alias("first"), F.count("*").alias("n"))
    totals = totals.withColumnRenamed("source_", "of_source")
    mixed = ranked.join(totals, F.col("source_").eqNullSafe(F.col("of_source")))
    fraction = (2 * (F.col("rank_at") - F.col("first")) + 1) / (2 * F.col("n"))
    mixed = mixed.withColumn("fraction", fraction).drop("of_source", "first", "n", "rank_at")
    placed = numbered(mixed, [F.col("fraction"), F.col("source_"), *ties], scratch, "place")
    n = max(ranked.count(), 1)
    shard = F.expr(f"place * {shards} div {n}")
    begin = F.expr(f"(shard * {n} + {shards} - 1) div {shards}")
    return (
        placed.withColumn("shard", shard)
        .withColumn("slot", F.col("place") - begin)
        .select(
            F.col("id_").alias(id_col), F.col("source_").alias(source_col), "size", "text_crc32",
            F.col("shard").cast("int").alias("shard"), "slot",
        )
    )


def write_shards(docs: DataFrame, path: str, shards: int, id_col: str = "doc_id", **options) -> None:
    """Write `docs` as one folder per shard, each in the order of its slots.

    Ids must be unique and not null here, since whole rows are joined to their places.
    """
    places = interleaved(docs, shards, id_col=id_col, **options).select(id_col, "shard", "slot")
    rows = docs.drop("shard", "slot").join(places, id_col).repartition(shards, "shard")
    rows.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
