import re
from collections import Counter

import fixtures
import pytest

from barloom.llm import quality


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {i + k for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for k in range(5)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), len(lines),
    )


def plain_bucket(v):
    cut = max(v.bit_length() - 5, 0)
    return v >> cut << cut


def plain_quartiles(own, language, weight):
    """The values at a quarter and three quarters of own ones and `weight` of the language's."""
    parts = Counter({v: 10**6 * n for v, n in Counter(own).items()})
    parts.update({v: weight * 10**6 * n // len(language) for v, n in Counter(language).items()})
    out, upto = [], 0
    for quarters in (1, 3):
        upto = 0
        for v in sorted(parts):
            upto += parts[v]
            if 4 * upto >= quarters * parts.total():
                out.append(v)
                break
    return out


def plain_verdicts(rows, reach=4, weight=25):
    """base_failed and kept of each (text, lang, source), limits from sorted buckets."""
    def rates(c):
        return {
            "symbol_rate": 1000 * c[2] // c[0] if c[0] else 0,
            "dup_line_rate": 1000 * c[3] // c[5] if c[5] else 0,
            "repeat_rate": 1000 * c[4] // c[0] if c[0] else 0,
            "word_length": 100 * c[1] // c[0] if c[0] else 0,
        }

    counted = [plain_counts(t) for t, _, _ in rows]
    failed = [c[0] < 10 or 100 * c[4] > 20 * c[0] for c in counted]
    values = {}
    for c, f, (_, lang, source) in zip(counted, failed, rows):
        for rate, v in rates(c).items():
            for key in ((lang, source), (lang,)):
                if not f:
                    values.setdefault((key, rate), []).append(plain_bucket(v))
    out = []
    for c, f, (_, lang, source) in zip(counted, failed, rows):
        ok = not f
        for rule in quality.RULES:
            if f:
                break
            q1, q3 = plain_quartiles(values[((lang, source), rule.rate)], values[((lang,), rule.rate)], weight)
            spread, x = max(q3 - q1, rule.least), rates(c)[rule.rate]
            ok &= x <= q3 + reach * spread if rule.upper else x >= q1 - reach * spread
        out.append((f, ok))
    return counted, out


@pytest.mark.parametrize("weight", [0, 25, 1000])
def test_equals_plain_python(docs, weight):
    rows = fixtures.rows()
    counted, verdicts = plain_verdicts([(r[1], r[2], r[3]) for r in rows], weight=weight)
    want = sorted(map(str, ((r[0], *c[:5], *v) for r, c, v in zip(rows, counted, verdicts))))
    got = quality.judged(docs, weight=weight)
    assert sorted(map(str, ((r.doc_id, *[r.m[c] for c in quality.COUNTS], r.base_failed, r.kept) for r in got.collect()))) == want
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "path", "m", "base_failed", "kept"]


@pytest.mark.parametrize("text", ["a b c d e a b c d e", "a a a a a a", "a\tb\vc\fd\re f\x1cg\u00a0h", "", "x y z w", "b a b a b a b a"])
def test_counts(text):
    assert quality.counts_of(text) == plain_counts(text)


def test_outliers_go_and_clean_documents_stay(spark):
    import random

    rng = random.Random(2)
    rows = [(i, fixtures.document(rng, 8), "en", "a") for i in range(300)]
    rows += [(1000 + i, fixtures.document(rng, 8).replace(" ", " %%% "), "en", "a") for i in range(5)]
    got = quality.judged(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).collect()
    assert {r.doc_id for r in got if r.kept} == set(range(300))


def test_limits_follow_the_source(spark):
    """Where symbols are common they are no reason to refuse."""
    import random

    rng = random.Random(2)

    def text(mark):
        return " ".join(f"{rng.choice(fixtures.WORDS)}{rng.randrange(1000)}{mark}" for _ in range(80))

    rows = [(i, text(" <b>"), "en", "html") for i in range(150)]
    rows += [(500 + i, text(""), "en", "prose") for i in range(150)]
    rows += [(999, text(" <b>"), "en", "prose")]
    got = quality.judged(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).collect()
    assert {r.doc_id for r in got if not r.kept} == {999}


def test_empty_table(no_docs):
    assert quality.judged(no_docs).collect() == []


def test_one_document_more_moves_no_limit_by_a_switch(spark):
    """At 99 and 100 documents of a source the same documents are kept."""
    import random

    rng = random.Random(4)
    rows = [(i, fixtures.document(rng, 8), "en", "prose") for i in range(200)]
    rows += [(1000 + i, fixtures.document(rng, 8).replace(" ", "# "), "en", "code") for i in range(100)]
    schema = "doc_id bigint, text string, lang string, source string"
    for n in (299, 300):
        got = quality.judged(spark.createDataFrame(rows[:n], schema)).collect()
        assert all(r.kept for r in got)


def test_clashing_names(spark):
    names = ["limit_0", "of_lang", "of_source", "bounds", "Bounds_", "n_words", "kept", "m", "base_failed"]
    schema = "doc_id bigint, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in names)
    text = " ".join(f"word{i}" for i in range(30))
    got = quality.judged(spark.createDataFrame([(1, text, None, "a", *names), (1, text, None, "a", *names), (2, None, "en", None, *names)], schema))
    assert got.columns == ["doc_id", "text", "lang", "source", *names[:6], "m", "base_failed", "kept"]
    rows = sorted(got.collect(), key=lambda r: r.doc_id)
    assert [r.kept for r in rows] == [True, True, False]
    assert all(r[c] == c for r in rows for c in names[:6])


def test_a_text_of_megabytes(spark):
    text = " ".join(f"w{i % 70001}x{i}" for i in range(400_000))
    got = quality.judged(spark.createDataFrame([(1, text, "en", "a")], "doc_id bigint, text string, lang string, source string")).collect()
    assert [(r.m.n_words, r.m.n_repeat_words, r.kept) for r in got] == [(400_000, 0, True)]
