import math
import random

import fixtures
import numpy as np
import pytest

from barloom.llm import langid
from barloom.llm.queries import held_out


def plain_bits(sample, text):
    """Code length of `text` under counts of `sample`, with exclusion, a byte at a time."""
    counts = {}
    for t in sample:
        data = langid.lead() + t
        for i in range(langid.ORDER, len(data)):
            for k in range(langid.ORDER + 1):
                c = counts.setdefault(data[i - k : i], {})
                c[data[i]] = c.get(data[i], 0) + 1
    data, bits = langid.lead() + text, 0.0
    for i in range(langid.ORDER, len(data)):
        out, done = set(), False
        for k in range(langid.ORDER, -1, -1):
            c = counts.get(data[i - k : i])
            if not c or (k > 1 and sum(c.values()) < 2):
                continue
            left = {b: n for b, n in c.items() if b not in out}
            total = sum(left.values()) + len(left)
            if data[i] in left:
                bits -= math.log2(left[data[i]] / total)
                done = True
                break
            if left:
                bits -= math.log2(len(left) / total)
            out |= set(c)
        if not done:
            bits += math.log2(max(256 - len(out), 1))
    return bits


def test_code_lengths_equal_a_plain_coder(monkeypatch):
    rng = random.Random(1)
    sample = [fixtures.sentence(rng, 12).encode() for _ in range(8)]
    grams, n = np.unique(np.concatenate([langid.grams_of(np.frombuffer(langid.lead() + t, np.uint8)) for t in sample]), return_counts=True)
    models = {"x": langid.Tree(grams, n)}
    texts = [fixtures.sentence(rng, 20).encode(), "Éa ñ 漢字 zzz".encode(), b"", b"q", sample[0]]
    want = [plain_bits(sample, t) for t in texts]
    assert langid.code_lengths(models, texts)[:, 0] == pytest.approx(want)
    monkeypatch.setattr(langid, "PIECE", 7)
    assert langid.code_lengths(models, texts)[:, 0] == pytest.approx(want)


def test_code_lengths_are_a_distribution():
    """After any context the 256 bytes have probabilities that sum to one."""
    data = np.frombuffer(langid.lead() + b"abracadabra abba " * 4, np.uint8)
    grams, n = np.unique(langid.grams_of(data), return_counts=True)
    tree = langid.Tree(grams, n)
    for context in (b"abr", b"zzz", b" ab", b"xab", b"zza"):
        each = langid.grams_of(np.frombuffer(b"".join(context + bytes([b]) for b in range(256)), np.uint8))[::4]
        assert np.exp2(-tree.bits(each)).sum() == pytest.approx(1)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.train(docs.where(~held_out("doc_id")))
    said = langid.predict(docs.where(held_out("doc_id")), model).collect()
    assert sum(r.lang == r.lang_pred for r in said) >= 0.95 * len(said) and all(0 < r.score <= 1 for r in said)


def test_awkward_texts(docs):
    model = langid.train(docs)
    got = langid.predict(docs.withColumnRenamed("m", "score"), model).collect()
    assert len(got) == len(fixtures.rows())
    for r in got:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) and 0 <= r.score <= 1
        assert r.lang_pred in ("und", "en", "de")


def test_sample_is_bounded(docs):
    picked = langid.training_rows(docs, 5).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in picked} == {"en": 5, "de": 5}


def test_nothing_learned(docs, no_docs):
    model = langid.train(no_docs)
    assert {(r.lang_pred, r.score) for r in langid.predict(docs, model).collect()} == {("und", 0.0)}
    assert langid.predict(no_docs, model).collect() == []


def test_model_size_is_checked(docs):
    with pytest.raises(ValueError):
        langid.train(docs, max_grams=10)
