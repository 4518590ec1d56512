"""Whitening against exact integers and a full eigenvalue decomposition."""

import numpy as np
import pytest

from barloom.llm import bidiagonal, queries, whiten

SF_DIR = "/root/testdata/sf0.01"


def plain(vectors, components=8):
    """Deviations in Python's integers; eigenvalues and vectors of the covariance."""
    x = np.array([[int(np.floor(1024 * float(c))) + 100_000 for c in v] for v in vectors], object)
    n, sums = len(x), x.sum(axis=0)
    apart = n * x - sums
    centred = (apart / n).astype(float)
    values, vecs = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    return n, [int(s) for s in (apart**2).sum(axis=1)], centred, values[order], vecs[:, order], values.sum()


def check(got, vectors, error):
    n, deviation, centred, values, vecs, trace = plain(vectors)
    assert got and error <= 1e-4
    by_row = {}
    for r in got:
        by_row.setdefault(r["vec_id"], {})[r["component"]] = r
    assert set(by_row) == set(range(len(vectors)))
    components = sorted(by_row[0])
    whitened = np.array([[by_row[i][c]["whitened"] for c in components] for i in range(n)])
    assert np.abs(whitened.T @ whitened / n - np.eye(len(components))).max() < 1e-9
    for i in range(n):
        for c in components:
            r = by_row[i][c]
            assert (r["n"], r["deviation"]) == (n, deviation[i])
            assert r["explained"] == pytest.approx(values[c - 1] / trace, rel=1e-9)
    for c in components:
        want = centred @ vecs[:, c - 1] / np.sqrt(values[c - 1])
        got_c = whitened[:, c - 1]
        assert np.abs(got_c - want).max() < 1e-6 or np.abs(got_c + want).max() < 1e-6
    return len(components)


def run(spark, rows, schema="vec_id bigint, embedding array<float>", parts=5):
    df = spark.createDataFrame(rows, schema).repartition(parts)
    fitted = whiten.fit(df, "embedding")
    made = whiten.whitened(df, "embedding", fitted)
    error = whiten.identity_error(made, fitted)
    out = []
    for r in made.collect():
        for i, w in enumerate(r["whitened"] or []):
            out.append({"vec_id": r["vec_id"], "component": i + 1, "n": fitted.n, "deviation": r["deviation"], "whitened": w, "explained": fitted.explained[i]})
    return out, error, fitted


@pytest.mark.parametrize("fan", [2, 32])
def test_rows_equal_a_full_decomposition(spark, monkeypatch, fan):
    monkeypatch.setattr(whiten, "FAN", fan)
    rng = np.random.default_rng(1)
    vectors = (rng.standard_normal((3000, 12)) * np.linspace(1, 3, 12)).astype(np.float32)
    got, error, _ = run(spark, [(i, v.tolist()) for i, v in enumerate(vectors)], parts=40)
    assert check(got, vectors.tolist(), error) == 8


def test_few_dimensions_and_dependent_ones(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((200, 3))
    vectors = np.hstack([base, np.floor(1024 * base[:, :1]) / 1024, np.full((200, 1), 0.25)])
    vectors[:, 0] = vectors[:, 3]
    got, error, fitted = run(spark, [(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    assert check(got, vectors.tolist(), error) == 3 and fitted.scales.shape == (3,)


def test_unusable_rows_and_clashing_columns(spark):
    rng = np.random.default_rng(3)
    good = [(i, rng.standard_normal(4).tolist()) for i in range(50)]
    nan, inf = float("nan"), float("inf")
    bad = [(90, None), (91, []), (92, [1.0, None, 2.0, 3.0]), (93, [nan, 0.0, 0.0, 0.0]), (94, [inf, 0.0, 0.0, 0.0]), (95, [1.0] * 3), (96, [1e300] * 4)]
    rows = [(i, v, "mine", 7, "row") for i, v in [*good, good[0], (None, good[1][1]), *bad]]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, whitened string, n int, row string")
    fitted = whiten.fit(df, "embedding")
    made = whiten.whitened(df, "embedding", fitted).collect()
    assert fitted.n == 52 and sorted((r.vec_id is None, r.vec_id) for r in made if r.vec_id is not None) == [(False, i) for i in sorted([*range(50), 0])]
    assert all((r.n, r["row"]) == (7, "row") and len(r.whitened) == 4 for r in made) and len(made) == 52
    _, deviation, *_ = plain([v for _, v in good] + [good[0][1], good[1][1]])
    assert {r.vec_id: r.deviation for r in made if r.vec_id is not None} == {i: deviation[i] for i in range(50)}


def test_huge_entries_stay_exact(spark):
    vectors = [[2.0**45, 1.0], [-(2.0**45), 2.0], [3.0, 2.0**40], [5.0, 6.0]]
    got, error, _ = run(spark, [(i, v) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    _, deviation, *_ = plain(vectors)
    assert error <= 1e-4 and all(r["deviation"] == (deviation[r["vec_id"]] if deviation[r["vec_id"]] < 2**63 else None) for r in got)


def test_alike_rows_one_row_and_no_rows(spark):
    schema = "vec_id bigint, embedding array<float>"
    for rows in ([(1, [0.5, 0.5])], [(i, [0.5, 0.5]) for i in range(9)]):
        got, error, fitted = run(spark, rows, schema)
        assert got == [] and error is None and fitted.n == len(rows)
    for rows in ([], [(1, None)]):
        df = spark.createDataFrame(rows, schema)
        assert whiten.fit(df, "embedding") is None and whiten.identity_error(df, None) is None
        assert whiten.whitened(df, "embedding", None).collect() == []


def test_query_equals_a_full_decomposition(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").orderBy("vec_id").collect()
    got = [r.asDict() for r in queries.QUERIES["op13_whiten"](spark, SF_DIR).collect()]
    assert [r.vec_id for r in rows] == list(range(len(rows)))
    assert check(got, [r.embedding for r in rows], got[0]["identity_error"]) == 8


@pytest.mark.parametrize("kind", ["spread", "equal", "rank", "blocks", "wide"])
def test_bidiagonal_equals_the_library(kind):
    rng = np.random.default_rng(4)
    a = {
        "spread": rng.standard_normal((99, 20)) * 10.0 ** np.linspace(0, -9, 20),
        "equal": np.linalg.qr(rng.standard_normal((60, 10)))[0] * 3,
        "rank": rng.standard_normal((50, 3)) @ rng.standard_normal((3, 12)),
        "blocks": np.kron(np.eye(3), rng.standard_normal((8, 4))),
        "wide": rng.standard_normal((4, 9)),
    }[kind]
    r, d = np.linalg.qr(a, mode="r"), a.shape[1]
    values, vecs = bidiagonal.leading(np.vstack([r, np.zeros((d - len(r), d))]), 8)
    square, top = a.T @ a, np.linalg.norm(a, 2) ** 2
    assert np.abs(np.sqrt(values[: min(a.shape)]) - np.linalg.svd(a, compute_uv=False)).max() < 1e-7 * top**0.5
    k = min(vecs.shape[1], 3 if kind == "rank" else 8)
    assert np.abs(vecs[:, :k].T @ vecs[:, :k] - np.eye(k)).max() < 1e-11
    assert all(np.linalg.norm(square @ vecs[:, i] - values[i] * vecs[:, i]) < 1e-12 * top for i in range(k))
