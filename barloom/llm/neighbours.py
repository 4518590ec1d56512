"""Nearest neighbours by inner product in learned partitions.

1. A bounded sample of the vectors, at most `SAMPLE` of them, gets its graph of nearest
   neighbours (a Spark job over blocks of the sample).
2. The graph is cut into cells of equal size, by halves along its slowest mode with swaps.
3. A small classifier learns, from a sampled vector, in which cells its neighbours lie.
   Every vector of the table goes to its most probable cell.
4. A query goes to its most probable cells until they hold a share of probability that is
   calibrated: `CALIBRATED` vectors are compared with the whole table, and the share is the
   least at which those find `recall` of their true neighbours.
5. Cells are cut into blocks of bounded size; every block of candidates meets every block
   of the queries of its cell, and the nearest are scored again one by one. A task keeps
   the nearest of a block of queries over all blocks of candidates that come in a row.

Copies of a vector are one candidate that carries its smallest ids, as many as any query
can return, and one query whose answer all copies share.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import Scratch

SAMPLE = 8192  # vectors the cells are learned from
SAMPLE_BYTES = 32 << 20
CALIBRATED = 256
RECALL = 0.95  # of the calibration; the operator promises 0.9
GRAPH_NEAREST = 10
LEAST_CELLS, MOST_CELLS = 16, 256  # between them their number grows with the root of the rows
BLOCK_ROWS, BLOCK_QUERIES = 2048, 512
HIDDEN, EPOCHS, RATE = 64, 60, 3e-3
NEAR_TIE = 1e-9  # relative; scores nearer than this are compared by their exact sums

BLOCK = "cell int, salt int, keys binary, vectors binary, ids array<array<bigint>>"
QUERY_BLOCK = "cell int, q_salt int, q_keys binary, q_vectors binary"
FOUND = "q_key bigint, key bigint, vec_id bigint, score double"


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, each summed in one fixed order."""
    return (left * right).sum(axis=1)


def usable(vector: Column) -> Column:
    """Whether a vector has entries, all of them finite, and is not zero."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    held = vector.isNotNull() & F.forall(vector, finite) & F.exists(vector, lambda c: c != 0)
    return F.coalesce(held, F.lit(False))


def _matrix(vectors: pa.Array) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1)


# Learning the cells


def _graph(spark, sample: np.ndarray) -> np.ndarray:
    """The nearest other sampled vectors of each; blocks of the sample are Spark's tasks."""
    held, nearest, step = spark.sparkContext.broadcast(sample), min(GRAPH_NEAREST, len(sample) - 1), 256

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = held.value
        for batch in batches:
            for start in batch.column(0).to_pylist():
                rows = np.arange(start, min(start + step, len(every)))
                scores = every[rows] @ every.T
                scores[np.arange(len(rows)), rows] = -np.inf
                best = np.argpartition(-scores, nearest - 1, axis=1)[:, :nearest].astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([start], pa.int64()), pa.array([best.tobytes()], pa.binary())], ["start", "best"])

    blocks = spark.range(0, len(sample), step, max(1, len(sample) // 1024)).mapInArrow(run, "start bigint, best binary")
    rows = sorted(blocks.toArrow().to_pylist(), key=lambda r: r["start"])  # `SAMPLE` lines of ids in all
    return np.concatenate([np.frombuffer(r["best"], np.int32).reshape(-1, nearest) for r in rows])


def _halved(a: np.ndarray, b: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """Which of n nodes go to the second half: equal halves with few edges (a, b) between."""
    degree = np.bincount(a, minlength=n) + 1e-9
    x = rng.standard_normal(n)
    for _ in range(80):
        x = (x + np.bincount(a, x[b], n) / degree) / 2
        x -= (x * degree).sum() / degree.sum()
        x /= np.abs(x).max() + 1e-300
    second = np.zeros(n, bool)
    second[np.argsort(x, kind="stable")[n // 2 :]] = True
    for _ in range(10):
        other = np.bincount(a, second[a] != second[b], n)
        gain = 2 * other - np.bincount(a, minlength=n)
        firsts, seconds = (np.flatnonzero(second == s) for s in (False, True))
        firsts, seconds = (x[np.argsort(-gain[x], kind="stable")] for x in (firsts, seconds))
        swaps = min(len(firsts), len(seconds), max(1, n // 50))
        good = int(np.sum(gain[firsts[:swaps]] + gain[seconds[:swaps]] > 0))
        trial = second.copy()
        trial[firsts[:good]], trial[seconds[:good]] = True, False
        if not good or np.sum(trial[a] != trial[b]) >= np.sum(second[a] != second[b]):
            break
        second = trial
    return second


def balanced_cells(nearest: np.ndarray, cells: int) -> np.ndarray:
    """The cell of each node of a neighbour graph; sizes differ by one at most."""
    n = len(nearest)
    a = np.repeat(np.arange(n), nearest.shape[1])
    b = nearest.ravel().astype(np.int64)
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    cell, rng = np.zeros(n, np.int64), np.random.default_rng(0)
    while cells > 1:
        after = np.empty(n, np.int64)
        for c in range(int(cell.max()) + 1):
            nodes = np.flatnonzero(cell == c)
            at = np.full(n, -1)
            at[nodes] = np.arange(len(nodes))
            inside = (cell[a] == c) & (cell[b] == c)
            after[nodes] = 2 * c + _halved(at[a[inside]], at[b[inside]], len(nodes), rng)
        cell, cells = after, cells // 2
    return cell


@dataclass(frozen=True)
class Router:
    """A classifier with one hidden layer: vectors to probabilities of cells."""

    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = np.maximum(x * self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def trained(x: np.ndarray, nearest: np.ndarray, cell: np.ndarray, cells: int) -> Router:
    """The classifier of a sample; a vector's target is its own and its neighbours' cells."""
    rng, n = np.random.default_rng(1), len(x)
    scale = 1.0 / max(float(np.sqrt((x * x).mean())), 1e-300)
    target = np.zeros((n, cells))
    for ids in (np.arange(n), *nearest.T):
        target[np.arange(n), cell[ids]] += 1.0 / (nearest.shape[1] + 1)
    p = [
        rng.standard_normal((x.shape[1], HIDDEN)) * np.sqrt(2 / x.shape[1]), np.zeros(HIDDEN),
        rng.standard_normal((HIDDEN, cells)) * np.sqrt(1 / HIDDEN), np.zeros(cells),
    ]
    first, second, step = [np.zeros_like(w) for w in p], [np.zeros_like(w) for w in p], 0
    for epoch in range(EPOCHS):
        order = rng.permutation(n)
        for start in range(0, n, 256):
            rows = order[start : start + 256]
            inputs = x[rows] * scale
            hidden = np.maximum(inputs @ p[0] + p[1], 0)
            wrong = (Router(1.0, *p).probabilities(inputs) - target[rows]) / len(rows)
            back = wrong @ p[2].T * (hidden > 0)
            step += 1
            for i, slope in enumerate((inputs.T @ back, back.sum(0), hidden.T @ wrong, wrong.sum(0))):
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope * slope
                rate = RATE * (1 - epoch / EPOCHS) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                p[i] = p[i] - rate * first[i] / (np.sqrt(second[i]) + 1e-8)
    return Router(scale, *p)


def _drawn(distinct: DataFrame, n: int, most: int, seed: int) -> DataFrame:
    """About `most` of the vectors, or all if there are fewer, chosen by a hash."""
    if n <= most:
        return distinct
    bound = int(min(most / n, 1.0) * 2**63)
    return distinct.where(F.xxhash64(F.lit(seed), "hash").bitwiseAND(2**63 - 1) < bound)


def learned(distinct: DataFrame, n: int, dims: int) -> Router:
    """Cells of a sample of the vectors and the classifier that leads to them."""
    spark = distinct.sparkSession
    most = min(SAMPLE, SAMPLE_BYTES // (8 * dims))
    drawn = _drawn(distinct, n, most, 1).orderBy("hash", "key").select("vector").toArrow()
    sample = _matrix(drawn.column("vector").combine_chunks())
    cells = 1
    while cells * 2 <= min(MOST_CELLS, max(LEAST_CELLS, n**0.5 / 16), len(sample) / 64):
        cells *= 2
    if cells == 1 or len(sample) < 2:
        return Router(1.0, np.zeros((dims, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    nearest = _graph(spark, sample)
    return trained(sample, nearest, balanced_cells(nearest, cells), cells)


# Routing


def routes(probabilities: np.ndarray, share: float, sizes: np.ndarray, least: int) -> Iterator[np.ndarray]:
    """Each query's cells: the most probable until they hold `share` and `least` rows."""
    order = np.argsort(-probabilities, axis=1, kind="stable")
    before = np.cumsum(np.take_along_axis(probabilities, order, 1), axis=1)
    before = np.concatenate([np.zeros((len(before), 1)), before[:, :-1]], axis=1)
    rows = np.cumsum(sizes[order], axis=1)
    rows = np.concatenate([np.zeros((len(rows), 1)), rows[:, :-1]], axis=1)
    wanted = (before < share) | (rows < least)
    for cells, go in zip(order, wanted):
        yield cells[go]


def _cell_of(router):
    @F.arrow_udf(T.IntegerType())
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            best = router.value.probabilities(_matrix(vectors)).argmax(axis=1) if len(vectors) else []
            yield pa.array(best, pa.int32())

    return run


def _cells_of(router, share: float, sizes: np.ndarray, least: int):
    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            found = routes(router.value.probabilities(_matrix(vectors)), share, sizes, least) if len(vectors) else []
            yield pa.array([cells.tolist() for cells in found], pa.list_(pa.int32()))

    return run


def calibrated(placed: DataFrame, n: int, router: Router, k: int, recall: float) -> float:
    """The least share of probability at which drawn vectors find `recall` of their nearest.

    About `CALIBRATED` vectors meet all others of the table; each task returns their `k`
    nearest of its own with the cells those are in.
    """
    spark = placed.sparkSession
    drawn = _drawn(placed, n, CALIBRATED, 2).select("key", "vector").toArrow()
    keys, queries = drawn.column("key").to_numpy(), _matrix(drawn.column("vector").combine_chunks())
    held = spark.sparkContext.broadcast((keys, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, asked = held.value
        score, cell = np.full((len(own), 0), -np.inf), np.zeros((len(own), 0), np.int32)
        for batch in batches:
            if not batch.num_rows:
                continue
            new = asked @ _matrix(batch.column(1)).T
            new[own[:, None] == batch.column(0).to_numpy()[None, :]] = -np.inf
            score = np.concatenate([score, new], axis=1)
            cell = np.concatenate([cell, np.broadcast_to(batch.column(2).to_numpy(), new.shape)], axis=1)
            if score.shape[1] > k:
                best = np.argpartition(-score, k - 1, axis=1)[:, :k]
                score, cell = np.take_along_axis(score, best, 1), np.take_along_axis(cell, best, 1)
        query = np.repeat(np.arange(len(own)), score.shape[1])
        there = np.isfinite(score.ravel())
        columns = [pa.array(query[there].astype(np.int32)), pa.array(score.ravel()[there]), pa.array(cell.ravel()[there].astype(np.int32))]
        yield pa.RecordBatch.from_arrays(columns, ["query", "score", "cell"])

    near = placed.select("key", "vector", "cell").mapInArrow(run, "query int, score double, cell int")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "cell"))
    best = near.withColumn("rank", rank).where(F.col("rank") <= k).select("query", "cell").toArrow()  # k each
    chance = router.probabilities(queries)
    query, cell = best.column("query").to_numpy(), best.column("cell").to_numpy()
    if not len(query):
        return 1.0
    # A neighbour is found as soon as the share is above what the cells before its own hold.
    own = chance[query, cell]
    more = (chance[query] > own[:, None]) | ((chance[query] == own[:, None]) & (np.arange(chance.shape[1]) < cell[:, None]))
    before = np.sort((chance[query] * more).sum(axis=1))
    return float(np.nextafter(before[int(np.ceil(recall * len(before))) - 1], 2.0)) + 1e-9


# Searching


def _packed(group: pa.Table) -> pa.Table:
    first = group.slice(0, 1)
    keys = group.column("key").to_numpy().astype(np.int64)
    vectors = _matrix(group.column("vector").combine_chunks())
    out = [first.column("cell"), first.column("salt"), pa.array([keys.tobytes()], pa.binary()), pa.array([vectors.tobytes()], pa.binary())]
    names = ["cell", "salt", "keys", "vectors"]
    if "ids" in group.column_names:
        out.append(pa.array([group.column("ids").to_pylist()], pa.list_(pa.list_(pa.int64()))))
        names.append("ids")
    return pa.table(out, names)


def nearest_of(queries: np.ndarray, vectors: np.ndarray, keys: np.ndarray, ids: list[list[int]], k: int) -> Iterator[list[tuple]]:
    """Each query's first `k` rows (-score, id, key), nearest first, then by id."""
    rough = queries @ vectors.T
    room = NEAR_TIE * np.abs(rough).max(axis=1, initial=0)
    for i, query in enumerate(queries):
        scores = rough[i]
        if len(scores) > k:
            edge = np.partition(scores, len(scores) - k)[len(scores) - k] - room[i]
            chosen = np.flatnonzero(scores >= edge)
        else:
            chosen = np.arange(len(scores))
        exact = products(np.broadcast_to(query, (len(chosen), len(query))), vectors[chosen])
        rows = [(-s, v, int(keys[j])) for s, j in zip(exact.tolist(), chosen) for v in ids[j]]
        yield sorted(rows)[:k]


def _searched(k: int, dims: int):
    def out(asked: list[int], best: list[list[tuple]]) -> pa.RecordBatch:
        lines = [(q, key, v, -s) for q, rows in zip(asked, best) for s, v, key in rows]
        columns = list(zip(*lines)) or [()] * 4
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["q_key", "key", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, best = [], []
        for batch in batches:
            column = dict(zip(batch.schema.names, batch.columns))
            for at in range(batch.num_rows):
                keys, q_keys = (np.frombuffer(column[n][at].as_buffer(), np.int64) for n in ("keys", "q_keys"))
                vectors, queries = (np.frombuffer(column[n][at].as_buffer(), np.float64).reshape(-1, dims) for n in ("vectors", "q_vectors"))
                found = list(nearest_of(queries, vectors, keys, column["ids"][at].as_py(), k))
                if q_keys.tolist() == asked:
                    best = [sorted(old + new)[:k] for old, new in zip(best, found)]
                    continue
                yield out(asked, best)
                asked, best = q_keys.tolist(), found
        yield out(asked, best)

    return run


def search(rows: DataFrame, id_col: str, vector_col: str, is_query: Column, k: int = 20, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the `k` nearest found of every query row.

    Queries are the rows for which `is_query` (of the columns of `rows`) holds, candidates
    all rows but the query's own; nearness is the inner product in double precision, ties
    go to the smaller id. A query with at most `k` candidates in the table gets them all.

    Rows without an id or whose vector is null, empty, zero, has a null or non-finite entry
    or another length than most take no part. Rows alike in id and vector are one; an id
    with several vectors is several rows, each a query of its own and a candidate for the
    others. Columns of other names play no part. An empty table gives no rows.
    """
    spark, scratch = rows.sparkSession, Scratch(rows.sparkSession, "neighbours")
    vector = F.col(f"`{vector_col}`")
    named = rows.select(
        F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), vector.cast("array<double>").alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asked")
    )
    good = named.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    sizes = good.groupBy(F.size("vector").alias("dims")).agg(F.count("*").alias("n"))
    commonest = sizes.orderBy(F.col("n").desc(), F.col("dims").desc()).first()
    if commonest is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    dims = commonest["dims"]
    good = good.where(F.size("vector") == dims).withColumn("hash", F.xxhash64("vector"))
    # No query returns more ids of one vector than k, and one more is its own.
    single = good.groupBy("hash", "vector", "vec_id").agg(F.max("asked").alias("asked"))
    rank = F.row_number().over(Window.partitionBy("hash", "vector").orderBy("vec_id"))
    first = single.withColumn("rank", rank).where(F.col("rank") <= k + 1)
    distinct = first.groupBy("hash", "vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    distinct = scratch.keep(distinct.withColumn("key", F.monotonically_increasing_id()), "distinct")
    n = distinct.count()

    router = learned(distinct, n, dims)
    held = spark.sparkContext.broadcast(router)
    placed = scratch.keep(distinct.withColumn("cell", _cell_of(held)("vector")), "placed")
    counted = placed.groupBy("cell").agg(F.count("*").alias("n"), F.sum(F.size("ids")).alias("rows")).toArrow().to_pylist()
    cells = router.w2.shape[1]
    held_rows, vectors_of = np.zeros(cells), np.zeros(cells, np.int64)
    for line in counted:  # one per cell
        held_rows[line["cell"]], vectors_of[line["cell"]] = line["rows"], line["n"]
    share = calibrated(placed, n, router, k, recall) if cells > 1 else 1.0

    blocks = _blocks(placed.select("key", "vector", "ids", "cell"), vectors_of, BLOCK_ROWS, "hash(key)").applyInArrow(_packed, BLOCK)
    asking = single.where("asked").select("vec_id", "hash", "vector")
    wanted = placed.join(asking.select("hash", "vector").distinct(), ["hash", "vector"], "left_semi").select("key", "vector")
    routed = wanted.withColumn("cells", _cells_of(held, share, held_rows, k + 1)("vector"))
    routed = scratch.keep(routed.select("key", "vector", F.explode("cells").alias("cell")), "routed")
    asked_of = np.zeros(cells, np.int64)
    for line in routed.groupBy("cell").count().toArrow().to_pylist():
        asked_of[line["cell"]] = line["count"]
    asks = _blocks(routed, asked_of, BLOCK_QUERIES, "hash(key)").applyInArrow(_packed, "cell int, salt int, keys binary, vectors binary")
    asks = asks.select("cell", F.col("keys").alias("q_keys"), F.col("vectors").alias("q_vectors"))

    # A block of queries and then all blocks of its cell: the join walks its left side.
    met = asks.join(blocks, "cell").select("keys", "vectors", "ids", "q_keys", "q_vectors")
    found = met.mapInArrow(_searched(k + 1, dims), FOUND)
    order = [F.col("score").desc(), F.col("vec_id").asc(), F.col("key").asc()]
    best = found.withColumn("rank", F.row_number().over(Window.partitionBy("q_key").orderBy(*order))).where(F.col("rank") <= k + 1)
    answer = F.array_sort(F.collect_list(F.struct("rank", "key", "vec_id", "score"))).alias("answer")
    answers = best.groupBy("q_key").agg(answer)
    shared = placed.join(answers, placed["key"] == answers["q_key"]).select("hash", "vector", "key", "answer")
    return (
        asking.withColumnRenamed("vec_id", "query_id")
        .join(shared, ["hash", "vector"])
        .select("query_id", F.expr(f"slice(filter(answer, r -> r.key <> key OR r.vec_id <> query_id), 1, {k})").alias("answer"))
        .select("query_id", F.posexplode("answer").alias("place", "row"))
        .select("query_id", (F.col("place") + 1).alias("rank"), F.col("row.vec_id").alias("vec_id"), F.col("row.score").alias("score"))
    )


def _blocks(rows: DataFrame, sizes: np.ndarray, most: int, by: str):
    """Rows of each cell grouped into blocks of about `most`, by a hash of their keys."""
    salts = F.array(*[F.lit(int(max(1, -(-s // most)))) for s in sizes])
    return rows.withColumn("salt", F.pmod(F.expr(by), F.get(salts, F.col("cell")))).groupBy("cell", "salt")
