"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import align, bpe, chosen_path, interleave, langid, lines, neighbours, quality, quotes, records, templates, urls, whiten
from barloom.llm.common import Scratch
from barloom.llm.sql import ORACLE
from barloom.session import configure

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
PATTERN = public_tokenizers.PATTERN
END_ID = 2
SHARDS = 40
URL_RULES = [  # (host, path, verdict)
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]


def prepared(spark: SparkSession) -> SparkSession:
    """Session settings, and Arrow batches that hold a bounded part of long texts."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, RANKS, PATTERN)
    decoded = bpe.decode(encoded, RANKS, PATTERN)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(bpe.id_bytes("ids"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.threaded(table(spark, sf_dir, "conversations"))


def held_out(doc_id: str):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~held_out("doc_id")))
    said = langid.predict(docs.select("doc_id", "text"), model)
    return said.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality.judged(docs).select("doc_id", *[F.col(f"m.{c}").alias(c) for c in quality.COUNTS], "base_failed", "kept")


def op5_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return templates.leaks(docs, table(spark, sf_dir, "benchmark")).drop("text_hash")


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs)


def op7_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return chosen_path.near_duplicates(docs, shingle_words=4).drop("text_hash")


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, spark.createDataFrame(URL_RULES, urls.RULES)).drop("url")


def op9_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = Scratch(spark, "records").root
    packed = bpe.packed_tokenizer(spark, TOKENIZER, None)

    index = records.write(docs, folder, bpe.id_arrays(packed, END_ID), width=2)
    back = records.read(index, folder, with_ids=False)
    return back.join(F.broadcast(records.starts(index)), "part").select(  # one line per file
        "doc_id", (F.col("file_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def op10_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return interleave.interleaved(docs, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return align.alignments(docs, TOKENIZER, PIECES, keep=["doc_id"])


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.search(rows, "vec_id", "embedding", F.col("vec_id") % 20 == 0)


def op13_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    fitted = whiten.fit(rows, "embedding")
    made = whiten.whitened(rows, "embedding", fitted)
    error = whiten.identity_error(made, fitted)
    shares = F.array(*[F.lit(e) for e in fitted.explained]) if fitted else F.array().cast("array<double>")
    placed = made.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return placed.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(fitted.n if fitted else 0).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("place")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def _ready(fn: Callable) -> Callable:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepared(spark), sf_dir)

    return run


QUERIES = {
    fn.__name__: _ready(fn)
    for fn in (
        op1_bpe, op2_quotes, op3_langid, op4_quality, op5_templates, op6_lines, op7_near_dup, op8_urls, op9_records,
        op10_interleave, op11_align, op12_neighbours,
        op13_whiten,
    )
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
