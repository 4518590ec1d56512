"""Searches against brute force: exact answers in one cell, recall in many."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import neighbours, queries

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "vec_id bigint, embedding array<float>"


def plain(rows, k=20, query=lambda i: i % 20 == 0):
    """Every query row's nearest among all other rows, by the definition."""
    rows = sorted({(i, tuple(v)) for i, v in rows})
    v = np.array([r[1] for r in rows], np.float32).astype(float)
    out = {}
    for at, (i, _) in enumerate(rows):
        if query(i):
            scores = neighbours.products(np.broadcast_to(v[at], v.shape), v)
            best = sorted((-s, rows[j][0]) for j, s in enumerate(scores.tolist()) if j != at)[:k]
            out.setdefault(i, []).append([(j, -s) for s, j in best])
    return out


def answers(df):
    got = {}
    for r in df.collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(rows) for q, rows in got.items()}


def search(spark, rows, schema=SCHEMA, **more):
    df = spark.createDataFrame(rows, schema).repartition(4)
    return neighbours.search(df, "vec_id", "embedding", F.col("vec_id") % 20 == 0, **more)


def recall(got, want):
    """The share of true neighbours found; every query has its 20, with their scores."""
    assert set(got) == set(want)
    found = total = 0
    for q, (best,) in want.items():
        assert [r for r, *_ in got[q]] == list(range(1, len(best) + 1))
        found, total = found + len({(i, s) for _, i, s in got[q]} & set(best)), total + len(best)
    return found / total


def test_query_finds_nine_in_ten(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    assert recall(answers(queries.QUERIES["op12_neighbours"](spark, SF_DIR)), plain(rows)) >= 0.9


def test_copies_ties_repeats_and_lengths_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 7)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 3)
    rng = np.random.default_rng(1)
    some = rng.integers(-2, 3, (30, 5)).astype(float)
    some[0] = [1, 2, 0, 0, 1]
    rows = [(i, some[0 if i % 3 == 0 else i % 30].tolist()) for i in range(400)]
    rows += rows[:40]
    rows = [(i, v) for i, v in rows if any(v)]
    got, want = answers(search(spark, rows)), plain(rows)
    assert {q: [(i, s) for _, i, s in r] for q, r in got.items()} == {q: w[0] for q, w in want.items()}


def test_unusable_rows_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(40, None), (60, []), (80, [0.0, 0.0]), (100, [nan, 1.0]), (120, [inf, 1.0]), (140, [1.0, None]), (160, [1.0]), (None, [9.0, 9.0])]
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [1.0, 0.0]), (3, [-1.0, 0.0]), (20, [0.0, 2.0])]
    df = spark.createDataFrame([(i, v, "k", "r") for i, v in rows + bad], "vec_id bigint, embedding array<double>, key string, rank string")
    got = neighbours.search(df, "vec_id", "embedding", F.col("vec_id") % 20 == 0).collect()
    pairs = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got)
    assert [p for p in pairs if p[0] == 0] == [(0, 1, 20, 1.0), (0, 2, 1, 0.5), (0, 3, 20, 0.0), (0, 4, 3, -1.0)]
    # An id with two vectors is two queries, each a candidate of the other.
    assert sorted(p[2] for p in pairs if p[0] == 20) == sorted([0, 1, 3, 20] * 2)
    assert {p[0] for p in pairs} == {0, 20}


def test_empty_table_and_one_row(spark):
    assert search(spark, []).collect() == [] and search(spark, [(0, None)]).collect() == []
    assert search(spark, [(0, [1.0, 2.0])]).collect() == []


@pytest.mark.parametrize("kind", ["clusters", "noise", "one vector in three"])
def test_recall_in_many_cells(spark, monkeypatch, kind):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 150)
    monkeypatch.setattr(neighbours, "LEAST_CELLS", 32)
    rng = np.random.default_rng(7)
    v = rng.standard_normal((6000, 16))
    if kind != "noise":
        v = v * 0.4 + rng.standard_normal((40, 16))[rng.integers(0, 40, 6000)]
    if kind == "one vector in three":
        v[::3] = v[0]
    rows = [(i, x) for i, x in enumerate(v.astype(np.float32).tolist())]
    assert recall(answers(search(spark, rows)), plain(rows)) >= 0.9


def test_cells_are_balanced_and_follow_the_graph():
    rng = np.random.default_rng(3)
    groups = np.repeat(np.arange(4), 100)
    nearest = np.array([rng.choice(np.flatnonzero(groups == g), 6) for g in groups])
    cell = neighbours.balanced_cells(nearest, 4)
    assert np.bincount(cell).tolist() == [100] * 4
    assert np.mean(cell[nearest] == cell[:, None]) > 0.95


def test_routes_take_the_share_and_enough_rows():
    chance, sizes = np.array([[0.5, 0.3, 0.2]]), np.array([5, 10, 30])
    assert [r.tolist() for r in neighbours.routes(chance, 0.4, sizes, 1)] == [[0]]
    assert [r.tolist() for r in neighbours.routes(chance, 0.6, sizes, 1)] == [[0, 1]]
    assert [r.tolist() for r in neighbours.routes(chance, 0.4, sizes, 16)] == [[0, 1, 2]]
