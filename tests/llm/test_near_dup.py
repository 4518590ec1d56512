import fixtures
from pyspark.sql import functions as F

from barloom.llm import chosen_path
from barloom.llm.common import Scratch
from barloom.llm.linking import components


def shingles(text, size):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + size]) for i in range(max(len(words) - size + 1, 1))} if words else set()


def brute(rows, size):
    """{row number: (set size, group's smallest id)} by comparing all pairs; nulls are last."""
    sets = [shingles(r[1], size) for r in rows]
    order = [(r[0] is None, r[0] or 0, i) for i, r in enumerate(rows)]
    links = [
        (order[i], order[j])
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    top = fixtures.groups(order, links)
    return sorted(
        (r[0] is None, r[0] or 0, len(s), rows[top[o][2]][0] is None, rows[top[o][2]][0] or 0) for r, s, o in zip(rows, sets, order)
    )


def answer(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id is None, r.component_id or 0) for r in df.collect())


def test_equals_all_pairs(docs):
    got = chosen_path.near_duplicates(docs, shingle_words=4)
    assert answer(got) == brute(fixtures.rows(), 4)
    for r in got.collect():
        assert r.kept == (r.doc_id == r.component_id)


def test_large_nodes_are_split_and_met_by_pivots(spark):
    import random

    rng = random.Random(3)
    base, other = fixtures.document(rng, 14), fixtures.document(rng, 14)
    rows = []
    for i in range(120):
        words = (base if i % 3 else other).split(" ")
        for _ in range(rng.randrange(1, 6)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(50)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = chosen_path.near_duplicates(df, leaf=4)
    assert answer(got) == brute([(i, t) for i, t in rows], 5)


def test_empty_table(no_docs):
    assert chosen_path.near_duplicates(no_docs).collect() == []


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.id: r.label for r in components(df, Scratch(spark, "t")).collect()}
    want = fixtures.groups({x for e in edges for x in e}, edges)
    assert got == {k: v for k, v in want.items() if k != v}
