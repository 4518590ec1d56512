"""Language identification by prediction by partial matching over bytes.

Each language gets a tree of byte contexts of order 0 to `ORDER`: how often each byte
followed the context in the language's sample. A context beyond order 1 that was met only
once is left out, so the order used varies with what was seen. A byte costs the exact
code length of this coder under frozen counts: in the longest known context, minus
log2 of c / (n + q) if the byte followed it c times, where n is the sum of the counts and
q the number of different bytes; otherwise the escape, minus log2 of q / (n + q), and
then the same in the context one byte shorter, without the bytes already ruled out. Below
order 0 the bytes not ruled out are equally likely. The bytes that follow a context all
follow its shorter ones, so what is ruled out depends on the longer context alone.

The text's language is the one that codes it in the fewest bits; the score is that
language's share of 2 ** -(bits per byte) over all languages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import Scratch, shipped

ORDER = 3
MAX_LANGS = 10_000
PIECE = 1 << 21  # bytes whose code lengths are computed at once
GRAMS = T.StructType([T.StructField("lang", T.StringType()), T.StructField("gram", T.LongType()), T.StructField("n", T.LongType())])
PREDICTED = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def grams_of(data: np.ndarray) -> np.ndarray:
    """Every byte with the `ORDER` bytes before it, in one integer; `data` begins with those."""
    out = np.zeros(len(data) - ORDER, np.int64)
    for k in range(ORDER + 1):
        out = (out << 8) | data[k : len(data) - ORDER + k]
    return out


def lead() -> bytes:
    """What stands before each text: it begins like a line after empty ones."""
    return b"\n" * ORDER


class Tree:
    """Code lengths of one language, by arrays sorted by context and byte.

    `grams` are (context, byte) integers of order `ORDER` with their counts; shorter
    contexts are their sums.
    """

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.levels = []  # per order: symbols, their costs; contexts, escapes
        below = None
        for order in range(ORDER + 1):
            keys, at = np.unique(grams & ((1 << 8 * (order + 1)) - 1), return_inverse=True)
            c = np.bincount(at, counts, len(keys)).astype(np.int64)
            contexts, of = np.unique(keys >> 8, return_inverse=True)
            n = np.bincount(of, c, len(contexts)).astype(np.int64)
            q = np.bincount(of, minlength=len(contexts))
            if order > 1:
                keep = n > 1
                chosen = keep[of]
                keys, c, of = keys[chosen], c[chosen], (np.cumsum(keep) - 1)[of[chosen]]
                contexts, n, q = contexts[keep], n[keep], q[keep]
            level = {"keys": keys, "c": c, "contexts": contexts, "n": n, "q": q}
            if below is not None:
                # In the shorter context only bytes that never followed the longer one remain.
                short = np.searchsorted(below["contexts"], contexts & ((1 << 8 * (order - 1)) - 1))
                kin = below["c"][np.searchsorted(below["keys"], keys & ((1 << 8 * order) - 1))]
                level["n_left"] = below["n"][short] - np.bincount(of, kin, len(contexts)).astype(np.int64)
                level["q_left"] = below["q"][short] - q
            self.levels.append(level)
            below = level

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """Exact code length of each (context, byte)."""
        out = np.zeros(len(grams))
        todo = np.arange(len(grams))
        n, q = np.full(len(grams), -1), np.zeros(len(grams), np.int64)  # n of -1: nothing is ruled out
        for order in range(ORDER, -1, -1):
            level, g = self.levels[order], grams[todo] & ((1 << 8 * (order + 1)) - 1)
            if not len(level["keys"]):
                continue
            at = np.minimum(np.searchsorted(level["contexts"], g >> 8), len(level["contexts"]) - 1)
            known = level["contexts"][at] == g >> 8
            total = np.where(n[todo] < 0, level["n"][at], n[todo])
            kinds = np.where(n[todo] < 0, level["q"][at], q[todo])
            i = np.minimum(np.searchsorted(level["keys"], g), len(level["keys"]) - 1)
            hit = known & (level["keys"][i] == g)
            out[todo[hit]] -= np.log2(level["c"][i[hit]] / (total + kinds)[hit])
            gone = known & ~hit
            real = gone & (kinds > 0)
            out[todo[real]] -= np.log2(kinds[real] / (total + kinds)[real])
            if order:
                n[todo[gone]], q[todo[gone]] = level["n_left"][at[gone]], level["q_left"][at[gone]]
            else:
                n[todo[gone]] = 0
            todo = todo[~hit]
        left = np.maximum(256 - np.where(n[todo] < 0, 0, len(self.levels[0]["keys"])), 1)
        out[todo] += np.log2(left)
        return out


def training_rows(docs: DataFrame, sample_rows: int) -> DataFrame:
    """At most `sample_rows` whole labelled rows per language: those with the smallest hashes.

    A first count finds the share of hashes that holds about twice as many, so that the
    ranking sees a bounded number of rows of any language.
    """
    labelled = docs.where("lang is not null and text is not null").withColumn("h", F.xxhash64("doc_id", "text"))
    counted = docs.where("lang is not null and text is not null").groupBy("lang").count().limit(MAX_LANGS + 1).collect()
    if len(counted) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    shares = [(r["lang"], min(1.0, 2.0 * sample_rows / r["count"])) for r in counted]
    share = docs.sparkSession.createDataFrame(shares, "lang string, share double")
    unit = F.pmod("h", F.lit(1 << 30)) / float(1 << 30)
    few = labelled.join(F.broadcast(share), "lang").where(unit < F.col("share"))  # a line per language
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    return few.withColumn("r", F.row_number().over(order)).where(F.col("r") <= sample_rows).select("lang", "text")


def count_grams(rows: DataFrame) -> DataFrame:
    """(lang, gram, n) of all training texts; every task sums its own before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                grams, n = np.unique(grams_of(np.frombuffer(lead() + text.encode(), np.uint8)), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.int64()), pa.array(n, pa.int64())],
                    names=["lang", "gram", "n"],
                )

    return rows.mapInArrow(count, GRAMS).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, sample_rows: int = 400, max_grams: int = 4_000_000) -> Broadcast:
    """The languages' counts, sent to the executors.

    `docs` needs doc_id, text and lang. The sample is `sample_rows` whole documents per
    language; the model of all languages is refused above `max_grams` entries.
    """
    scratch = Scratch(docs.sparkSession, "langid")
    counts = scratch.keep(count_grams(training_rows(docs.select("doc_id", "text", "lang"), sample_rows)), "grams")
    if (size := counts.count()) > max_grams:
        raise ValueError(f"{size} contexts; lower sample_rows or raise max_grams ({max_grams})")
    table = counts.orderBy("lang", "gram").toArrow()
    scratch.drop(counts)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return shipped(docs.sparkSession, sink.getvalue().to_pybytes(), "the language model")


def trees(content: bytes) -> dict[str, Tree]:
    table = pa.ipc.open_stream(content).read_all()
    langs = np.array(table["lang"].to_pylist(), object)
    grams, n = table["gram"].to_numpy(), table["n"].to_numpy()
    return {lang: Tree(grams[langs == lang], n[langs == lang]) for lang in sorted(set(langs))}


def code_lengths(models: dict[str, Tree], texts: list[bytes]) -> np.ndarray:
    """Bits of every text under every language, `PIECE` bytes at a time."""
    out = np.zeros((len(texts), len(models)))
    group: list[tuple[int, np.ndarray]] = []
    size = 0

    def work() -> None:
        grams = [grams_of(part) for _, part in group]
        every, at = _distinct(np.concatenate(grams))
        ends = np.cumsum([len(g) for g in grams])
        starts, owners = ends - [len(g) for g in grams], [i for i, _ in group]
        for k, tree in enumerate(models.values()):
            cost = tree.bits(every)[at]
            np.add.at(out[:, k], owners, np.add.reduceat(cost, starts))
        group.clear()

    for i, text in enumerate(texts):
        data = np.frombuffer(lead() + text, np.uint8)
        for start in range(0, len(text), PIECE):
            part = data[start : start + PIECE + ORDER]
            group.append((i, part))
            size += len(part)
            if size >= PIECE:
                work()
                size = 0
    if group:
        work()
    return out


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, and the place of each value among them."""
    import pandas as pd

    at, every = pd.factorize(values)
    return every, at


def predictor(model: Broadcast):
    """Arrow function: texts to `PREDICTED`; a null text gives `und`."""

    @F.arrow_udf(PREDICTED)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        models = trees(model.value)
        names = list(models)
        for batch in batches:
            texts = [t or b"" for t in batch.cast(pa.binary()).to_pylist()]
            langs, scores = ["und"] * len(texts), [0.0] * len(texts)
            if names:
                bits = code_lengths(models, texts)
                best = bits.argmin(1)
                each = bits / np.maximum([len(t) for t in texts], 1)[:, None]
                share = 1 / np.exp2(np.minimum(each[np.arange(len(texts)), best][:, None] - each, 0)).sum(1)
                langs = [names[b] if t else "und" for b, t in zip(best, texts)]
                scores = [float(s) if t else 0.0 for s, t in zip(share, texts)]
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    return run


def has_letter(text: str) -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: Broadcast, text_col: str = "text") -> DataFrame:
    """Every row with `lang_pred` and `score`.

    Only the whole text is looked at. A null text and one without a letter are `und` with
    score 0, as is every text if no language was learned; among languages of equal code
    length the first by name wins. Equal texts get equal answers. Columns with the two
    names are replaced; rows and other columns stay, and an empty table stays empty.
    """
    text = F.when(has_letter(text_col), F.col(text_col))
    made = docs.withColumn("lang_pred", predictor(model)(text))
    return made.withColumns({"lang_pred": F.col("lang_pred.lang_pred"), "score": F.col("lang_pred.score")})
