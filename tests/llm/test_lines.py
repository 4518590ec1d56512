import re

import fixtures
import pytest
import xxhash

from barloom.llm import lines


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return row[-1]


@pytest.mark.parametrize("seed", range(6))
def test_edit_distance(seed):
    import random

    rng = random.Random(seed)
    for _ in range(60):
        a = "".join(rng.choice("abcd ") for _ in range(rng.randrange(40)))
        b = "".join(c if rng.random() > 0.2 else rng.choice("abx") for c in a) + rng.choice(["", "zz"])
        want = plain_distance(a, b)
        assert lines.edit_distance(a, b, 100) == want
        for most in (0, 2, 5):
            assert (lines.edit_distance(a, b, most) <= most) == (want <= most)


def plain_features(words, min_words=5):
    """Words, or runs of four characters where words are few; None of short lines."""
    text = " ".join(words)
    if len(words) >= min_words:
        return words
    return None if len(text) < 4 * min_words else [text[i : i + 4] for i in range(len(text) - 3)]


def plain_simhash(words):
    ones, total = [0] * 64, 0
    for w in words:
        h = xxhash.xxh3_64_intdigest(w.encode())
        weight = min(max(len(w.encode()) - 2, 1), 30)
        total += weight
        for b in range(64):
            ones[b] += weight * (h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > total)


def brute(rows, min_words=5, min_percent=80):
    """{(doc_id, text): cleaned text} by comparing all pairs of lines."""
    seen = {}
    docs = sorted({(r[0] is None, r[0] or 0, r[1]) for r in rows if r[1] is not None})
    for none, doc_id, text in docs:
        for no, line in enumerate(text.split("\n")):
            words = re.sub(r"[\x00-\x7f]", lambda c: c[0] if c[0].isalnum() else " ", line.lower()).split(" ")
            if words := [w for w in words if w]:
                seen[(none, doc_id, no, text)] = (words, " ".join(words))
    norms = sorted({v[1] for v in seen.values()})
    made = {n: plain_features(n.split(" "), min_words) for n in norms}
    sims = {n: plain_simhash(f) for n, f in made.items() if f}
    links = []
    for i, a in enumerate(norms):
        for b in norms[:i]:
            longest = max(len(a), len(b))
            if a in sims and b in sims and (sims[a] ^ sims[b]).bit_count() <= 3 and plain_distance(a, b) <= (100 - min_percent) * longest // 100:
                links.append((a, b))
    group = fixtures.groups(norms, links)
    first = {}
    for key, (_, norm) in seen.items():
        first[group[norm]] = min(first.get(group[norm], key), key)
    out = {}
    for none, doc_id, text in docs:
        keep = [
            line
            for no, line in enumerate(text.split("\n"))
            if (key := (none, doc_id, no, text)) not in seen or first[group[seen[key][1]]] == key
        ]
        out[(None if none else doc_id, text)] = "\n".join(keep)
    return out


def fuzzy_rows(seed=1, n=30):
    """Documents whose lines repeat with small edits. Ids are unique."""
    import random

    rng = random.Random(seed)
    pool = [fixtures.sentence(rng, 30) for _ in range(12)]
    out = []
    for i in range(n):
        text = []
        for _ in range(4):
            words = rng.choice(pool).split(" ")
            if rng.random() < 0.5:
                k = rng.randrange(len(words))
                words[k] = words[k] + "s"
            text.append(" ".join(words).capitalize() + "!")
        out.append((i, "\n".join(text)))
    return out


@pytest.mark.parametrize("leaf", [2, 64])
def test_fuzzy_lines_equal_all_pairs(spark, leaf):
    rows = fuzzy_rows()
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r.doc_id, t): r.text for r in lines.dedup_lines(df, leaf=leaf).collect() for t in [dict(rows)[r.doc_id]]}
    want = brute(rows)
    assert got == want
    assert sum(v != k[1] for k, v in want.items()) > 20


def test_awkward_documents(docs):
    rows = [r for r in fixtures.rows() if r[0] is not None]
    df = docs.where("doc_id is not null")
    want = brute(rows)
    texts = {r[0]: r[1] for r in rows}
    got = lines.dedup_lines(df).collect()
    assert len(got) == len(rows)
    for r in got:
        before = texts[r.doc_id]
        assert r.text == (None if before is None else want[(r.doc_id, before)])
        assert r.n_lines == (0 if before is None else before.count("\n") + 1)
        assert r.n_removed == (0 if before is None else r.n_lines - len(r.text.split("\n")) if r.text or before == "" else r.n_lines)
        assert r.kept == "k" and r.m == "m"


def test_null_ids_come_last(spark):
    line = "one two three four five six"
    df = spark.createDataFrame([(None, line), (9, line + "\nand a tail"), (None, None)], "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in lines.dedup_lines(df).collect() if r.text is not None}
    assert got == {9: line + "\nand a tail", None: ""}


def test_empty_table(no_docs):
    assert lines.dedup_lines(no_docs).collect() == []


def test_simhashes_of_long_lines_and_many_words(monkeypatch):
    monkeypatch.setattr(lines.WordLanes, "LIMIT", 500)
    cache = lines.WordLanes()
    words = [[f"w{i}" for i in range(7000)], ["a", "b"], ["x" * 70_000], [f"abcdefgh{i}" for i in range(3000)]]
    words += [[f"{i}", "one", "two"] for i in range(2000)]
    for part in (words, words[1:5]):
        got = lines.simhashes([[w.encode() for w in line] for line in part], cache)
        assert [int(h) for h in got] == [plain_simhash(line) for line in part]


def test_many_dissimilar_lines_of_one_heavy_word(spark):
    """All have the SimHash of their heaviest word; only planted copies are similar."""
    import random

    rng = random.Random(4)
    texts = ["internationalization " + " ".join(str(rng.randrange(10**5, 10**6)) for _ in range(4)) for _ in range(700)]
    for i in range(0, 60, 3):
        texts[600 + i] = texts[i][:-1] + "x"
    assert len({plain_simhash(t.split(" ")) for t in texts}) == 1
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id for r in lines.dedup_lines(df).where("n_removed > 0").collect()}
    assert got == {600 + i for i in range(0, 60, 3)}


def test_alike_hashes_of_two_values_are_finished(spark):
    """Lines of two SimHashes that stay together in most parts of the bits equal all pairs."""
    import random

    rng = random.Random(6)
    rows = [(i, f"internationalization {'ab'[i % 2] * 12} " + " ".join(str(rng.randrange(10**4)) for _ in range(3))) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want, texts = brute(rows), dict(rows)
    got = lines.dedup_lines(df, leaf=4).collect()
    assert {(r.doc_id, texts[r.doc_id]): r.text for r in got} == want


def test_short_lines_and_lines_without_spaces(spark):
    """Equal lines of any length go, and similar ones of a script that has no spaces."""
    chinese = "".join(chr(0x4E00 + 37 * i) for i in range(60))
    texts = [f"Read more\nalpha {i} beta\n---" for i in range(50)] + [chinese, chinese[:30] + "\u3400" + chinese[31:], chinese[::-1]]
    rows = list(enumerate(texts))
    got = {(r.doc_id, texts[r.doc_id]): r.text for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == brute(rows)
    assert got[(0, texts[0])] == texts[0]
    assert all(got[(i, texts[i])] == f"alpha {i} beta\n---" for i in range(1, 50))
    assert got[(50, chinese)] == chinese and got[(52, texts[52])] == texts[52]


def test_clashing_names(spark):
    names = ["gone", "Gone_", "gone_id", "gone_th", "gone_of", "id_", "th", "l", "place", "first", "sim"]
    line = "one two three four five six"
    schema = "doc_id bigint, text string, " + ", ".join(f"`{c}` string" for c in names)
    df = spark.createDataFrame([(1, line, *names), (2, line + "\nx", *names), (2, None, *names)], schema)
    got = lines.dedup_lines(df)
    assert got.columns == [*df.columns, "n_lines", "n_removed"]
    assert sorted((r.doc_id, str(r.text), r.n_removed) for r in got.collect()) == [(1, line, 0), (2, "None", 0), (2, "x", 1)]
    assert all(r[c] == c for r in got.collect() for c in names)


@pytest.mark.parametrize("blocks", [5, 6, 7])
def test_close_hashes_share_a_key(spark, blocks):
    import random

    rng = random.Random(blocks)
    rows = []
    for i in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randrange(4)):
            b ^= 1 << bit
        rows.append((i, *[x - (x >> 63 << 64) for x in (a, b)]))
    df = spark.createDataFrame(rows, "id bigint, a bigint, b bigint")
    keys = df.select(lines.block_keys("a", blocks).alias("x"), lines.block_keys("b", blocks).alias("y"))
    assert keys.where("not arrays_overlap(x, y)").isEmpty()
    assert keys.where("size(array_distinct(x)) < size(x)").isEmpty()


@pytest.mark.parametrize("most", [((0, 5), (1 << 29, 6)), ()])
def test_more_blocks_give_the_same_lines(spark, monkeypatch, most):
    monkeypatch.setattr(lines, "MOST_LINES", most)
    rows = fuzzy_rows(seed=2)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {(r.doc_id, dict(rows)[r.doc_id]): r.text for r in lines.dedup_lines(df).collect()} == brute(rows)


def test_two_lines_that_meet_by_chance_are_not_joined(spark):
    """Of nodes of two lines only those go on whose lines can be similar."""
    from barloom.llm.linking import Linker

    bounds = [lines.F.bit_xor("sim").alias("differ")]
    hopeless = (bounds, (lines.F.col("in_node") == 2) & (lines.F.bit_count("differ") > 3))
    rows = [(1, 1, 0), (1, 2, 255), (2, 3, 0), (2, 4, 7), (3, 5, 0), (3, 6, 255), (3, 7, 1)]
    df = spark.createDataFrame(rows, "path bigint, id bigint, sim bigint")
    nodes = Linker(None, None, None, None, hopeless=hopeless).nodes(df)
    assert sorted((r.path, r.id) for r in nodes.collect()) == [(2, 3), (2, 4), (3, 5), (3, 6), (3, 7)]
