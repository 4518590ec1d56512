import random

import fixtures
import pytest

from barloom.llm import templates

ITEMS = [
    (1, "If Alice has 12 apples and gives 5 apples to Bob then how many apples does Alice still have at the end of the day"),
    (2, "a train leaves the station at 40 km and meets another train after 3 hours of slow travel through the green hills"),
    (3, "too short"),
    (4, None),
    (5, "what is the value of the sum of the first ten odd numbers in the list below"),
    (6, "what is the value of the sum of the first ten prime numbers above one hundred"),
]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, text string")


def found(df):
    return {(r.doc_id, r.item_id, r.exchanged) for r in df.collect()}


def plain(docs, items, min_percent=80, slot_percent=90):
    """Every document against every item."""
    words, cache, out = templates.Words(), templates.WordHashes(), set()
    for doc_id, text in docs:
        dh, dat, dv = templates.template_windows(text or "", words, cache)
        for item, question in items:
            ih, iat, iv = templates.template_windows(question or "", words, cache)
            bins = {}
            for h, at in zip(dh.tolist(), dat.tolist()):
                for k, i in zip(ih.tolist(), iat.tolist()):
                    if h == k:
                        for b in (0, 1):
                            bins.setdefault((at - i) // templates.DRIFT + b, []).append((h, at, i))
            for hits in bins.values():
                if 100 * len({h for h, _, _ in hits}) < min_percent * len(set(ih.tolist())):
                    continue
                values, seen = {}, set()
                for _, at, i in hits:
                    for k in range(templates.WINDOW):
                        if iv[i + k]:
                            seen.add((i + k, iv[i + k], dv[at + k]))
                for _, a, b in seen:
                    values.setdefault(a, {}).setdefault(b, 0)
                    values[a][b] += 1
                n, most = sum(sum(v.values()) for v in values.values()), sum(max(v.values()) for v in values.values())
                if 100 * most >= slot_percent * n:
                    out.add((doc_id, item))
    return out


def documents(seed=3):
    rng = random.Random(seed)
    q = {i: t for i, t in ITEMS if t}
    texts = [fixtures.document(rng) for _ in range(12)]
    texts.append(fixtures.document(rng) + "\n" + q[1] + " " + fixtures.sentence(rng, 30))
    texts.append("Intro text. " + q[1].replace("Alice", "Mary Ann").replace("12", "48").replace("Bob", "Tom").replace(" 5 ", " 7 "))
    texts.append(q[1].replace("Alice", "Mary", 1).replace("Alice", "Zoe").replace("Bob", "Tom"))
    texts.append(q[2].replace("km", "miles").replace("40", "90"))
    texts.append(" ".join(q[2].split(" ")[:12]))
    texts += [q[5], q[6], q[5].upper(), None, "", q[2] + " " + q[2], "x " * 5000 + q[2]]
    return [(i, t) for i, t in enumerate(texts)]


def test_equals_all_pairs_and_catches_exchanged_slots(spark, items):
    rows = documents()
    df = spark.createDataFrame([(i, t, "a", "b") for i, t in rows], "doc_id bigint, text string, h string, slots string")
    got = templates.leaks(df, items)
    assert {(d, i) for d, i, _ in found(got)} == plain(rows, ITEMS)
    assert {(12, 1, False), (13, 1, True), (15, 2, True), (17, 5, False), (18, 6, False)} <= found(got)
    assert not {14, 16} & {d for d, _, _ in found(got)} and not set(range(12)) & {d for d, _, _ in found(got)}


def test_awkward_ids(spark, items):
    rows = [(None, ITEMS[1][1]), (7, ITEMS[1][1]), (7, "nothing of it here at all my friend"), (7, ITEMS[1][1]), (8, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(templates.leaks(df, items)) == {(None, 2, False), (7, 2, False)}


def test_empty_tables(spark, items, no_docs):
    assert templates.leaks(no_docs, items).collect() == []
    some = spark.createDataFrame(documents(), "doc_id bigint, text string")
    assert templates.leaks(some, items.limit(0)).collect() == []


def test_windows_that_many_items_share(spark):
    """A common stem brings no pairs; only the items really held are found."""
    stem = "what is the total of all the values in the table below when"
    items = [(i, f"{stem} the letter w{i} stands for x{i} and nothing else y{i} z{i} matters here now a{i} b{i}") for i in range(60)]
    docs = [(i, stem + " nobody asks for anything more than this at any time of day") for i in range(30)] + [(99, items[7][1])]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = templates.leaks(df, spark.createDataFrame(items, "item_id bigint, text string"))
    assert found(got) == {(99, 7, False)}


def test_one_number_in_two_roles(spark):
    """Numbers may be exchanged place by place; a name must stay the same person."""
    text = "{} buys {} apples at the market and then walks for {} hours to the house where {} will eat them all"
    items = spark.createDataFrame([(1, text.format("Alice", 2, 2, "Alice"))], "item_id bigint, text string")
    rows = [(1, text.format("Alice", 3, 5, "Alice")), (2, text.format("Tom", 3, 5, "Tom")), (3, text.format("Tom", 2, 2, "Zoe"))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(templates.leaks(df, items)) == {(1, 1, True), (2, 1, True)}


def test_items_without_telling_windows_and_in_capitals(spark):
    """Short items, sums, names and unspaced scripts are found verbatim, others in capitals too."""
    items = [
        (1, "Who wrote Hamlet?"),
        (2, "12 + 7 * 3 - 48 / 6 = 27"),
        (3, "Anna Berg, Carl Dahl, Emil Falk"),
        (4, "从一加到一百的和是多少?"),
        (5, ITEMS[0][1]),
        (6, "What Is The Value Of The Sum Of The First Ten Odd Numbers In The List Below"),
    ]
    texts = [f"some words before it {t} and some words behind it" for _, t in items]
    texts += [t.upper() for _, t in items] + [items[5][1].lower()]
    texts += ["who wrote it was not hamlet", "12 + 7 * 3 - 48 / 7 = 27", "前文从一加到一百的和是多少后文", "Anna Berg, Carl Dahl, Emil Frank"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {(d, i) for d, i, _ in found(templates.leaks(df, spark.createDataFrame(items, "item_id bigint, text string")))}
    assert got == {(k, k % 6 + 1) for k in range(12)} | {(12, 6), (15, 4)}
