"""Alignment against a plain loop over both libraries."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import fixtures
from barloom.llm import align, bpe, perfect_hash, queries

A = Tokenizer.from_file(queries.TOKENIZER)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
ODD = ["a  b\n c", "<s> </s> <unk> <0x41>", "<|endoftext|> x", "x▁y", "ﬁ ２\t\r\n", "   ", "end ", "\x00 é é 😀漢", "▁", "naïve  café", " lead"]


def byte_strings(table, ids):
    return [table[i] for i in ids]


def plain(texts):
    """Rows by the definition: ends, groups, links, then counts over all texts."""
    byte_of = {c: b for b, c in enumerate(bpe.byte_table())}
    vocab = {i: bytes(byte_of[c] for c in t) for t, i in A.get_vocab().items() if all(c in byte_of for c in t)}
    found, counts = [], Counter()
    for text in texts:
        if not text:
            found.append(None)
            continue
        a = A.encode(" " + text, add_special_tokens=False).ids
        b = B.encode(text)
        ba = [vocab[i] for i in a]
        bb = [
            bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()
            for p in (B.id_to_piece(i) for i in b)
        ]
        if b"".join(ba) != (" " + text).encode() or b"".join(bb) != (" " + text).encode():
            found.append(None)
            continue
        ends_a = dict(zip(np.cumsum([len(x) for x in ba]).tolist(), range(len(a))))
        ends_b = dict(zip(np.cumsum([len(x) for x in bb]).tolist(), range(len(b))))
        groups, links, i, j = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            x, y = ends_a[end], ends_b[end]
            groups.append(",".join(map(str, a[i : x + 1])) + "|" + ",".join(map(str, b[j : y + 1])))
            links.append((a[x], b[y]))
            i, j = x + 1, y + 1
        counts.update(links)
        found.append((len(a), len(b), ";".join(groups), links))
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    out = []
    for row in found:
        if row is None:
            out.append((0, 0, 0, 0, 0, 0, "", ""))
            continue
        n_a, n_b, groups, links = row
        n_best = sum(counts[p] == best[p[1]] for p in links)
        digest = hashlib.sha256(groups.encode()).hexdigest()
        out.append((n_a, n_b, len(links), len(links), n_best, sum(counts[p] for p in links), digest, groups))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]


@pytest.mark.parametrize("most_pairs", [align.MOST_PAIRS, 150])
def test_alignments_equal_a_plain_loop(spark, monkeypatch, most_pairs):
    monkeypatch.setattr(perfect_hash, "BUCKET_KEYS", 100)
    texts = [r[1] for r in fixtures.rows()] + ODD
    rows = [(i, t, "groups of the caller", "row") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, groups string, row string").repartition(40)
    made = align.alignments(docs, queries.TOKENIZER, queries.PIECES, with_groups=True, most_pairs=most_pairs)
    got = {r.doc_id: r for r in made.collect()}
    want = plain(texts)
    assert len(got) == len(texts) and all(r.row == "row" for r in got.values())
    assert sum(w[0] > 0 for w in want) > 60 and sum(w[0] == 0 for w in want) >= 4
    for i, text in enumerate(texts):
        assert tuple(got[i][c] for c in COLUMNS) == want[i] and got[i].text == text


def test_parts_give_the_ids_of_the_whole_text(monkeypatch):
    monkeypatch.setattr(align, "REMEMBERED", 5)
    files = [open(f, "rb").read() for f in (queries.TOKENIZER, queries.PIECES)]
    assert align.cuts_at_spaces(files[1])
    aligner = align.Aligner(align.Pair(*files), *files)
    texts = [r[1] or "" for r in fixtures.rows()] + ODD + [" \n x", "a\n\n b \n", "word " * 300_000, "x" * 200_000]
    for cuts in (True, True, False):
        aligner.ids_b.cuts = cuts
        for text, found in zip(texts, aligner(texts)):
            if found is None:
                assert plain([text])[0][0] == 0
                continue
            assert np.array_equal(np.frombuffer(found[0], "<u2"), A.encode(" " + text, add_special_tokens=False).ids)
            assert np.array_equal(np.frombuffer(found[1], "<u2"), B.encode(text))


def test_empty_and_null_tables(spark, no_docs):
    made = align.alignments(no_docs, queries.TOKENIZER, queries.PIECES, keep=["doc_id"])
    assert made.collect() == [] and made.columns == ["doc_id", *COLUMNS[:-1]]
    nulls = spark.createDataFrame([(None, None), (1, "")], "doc_id bigint, text string")
    made = align.alignments(nulls, queries.TOKENIZER, queries.PIECES, keep=["doc_id"])
    assert {tuple(r) for r in made.collect()} == {(k, 0, 0, 0, 0, 0, 0, "") for k in (None, 1)}


@pytest.mark.parametrize("n", [1, 2, 100, 30_000])
def test_perfect_hash_numbers_every_key_once(spark, n):
    keys = np.unique(np.random.default_rng(n).integers(0, 2**63, n)).astype(np.int64)
    made = perfect_hash.build(spark.createDataFrame([(int(k),) for k in keys], "key bigint"), len(keys)).toArrow()
    buckets = perfect_hash.buckets_for(len(keys))
    rows = {r["bucket"]: r for r in made.to_pylist()}
    hashed = perfect_hash.PerfectHash(0, buckets, [rows[b]["levels"] for b in range(buckets)], [rows[b]["words"] for b in range(buckets)])
    kept = np.frombuffer(b"".join(rows[b]["keys"] for b in range(buckets)), np.int64)
    numbers = hashed.numbers(keys.view(np.uint64))
    assert sorted(numbers) == list(range(len(keys))) and np.array_equal(kept[numbers], keys)
    assert hashed.n == len(keys)


def test_equal_keys_are_refused():
    with pytest.raises(ValueError, match="distinct"):
        perfect_hash.built(np.array([5, 5], np.uint64))


def test_tokenizer_files_are_the_public_ones():
    assert queries.PIECES == public_tokenizers.path("piece_bpe_32k.model")
