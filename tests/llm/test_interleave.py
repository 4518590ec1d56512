import zlib
from collections import Counter

import fixtures
import pytest

from barloom.llm import interleave


def plain(rows, shards):
    """Positions by sorting exact fractions; needs the operator's own seeded order."""
    total = Counter(r["source"] for r in rows)
    return {s: n / len(rows) for s, n in total.items()}


@pytest.mark.parametrize("shards", [1, 4, 7, 500])
def test_every_shard_matches_the_mixture(docs, shards):
    got = interleave.interleaved(docs, shards).collect()
    rows = fixtures.rows()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    by_id = {r[0]: r for r in rows if r[0] is not None}
    for r in got:
        if r.doc_id is not None:
            data = (by_id[r.doc_id][1] or "").encode()
            assert r.size == len(data) + 16 and r.text_crc32 == zlib.crc32(data)
    sizes = Counter(r.shard for r in got)
    counts = [sizes.get(s, 0) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(rows)
    for s in range(shards):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    share = plain([r.asDict() for r in got], shards)
    for s in range(shards):
        inside = Counter(r.source for r in got if r.shard == s)
        for source, part in share.items():
            assert abs(inside.get(source, 0) - part * counts[s]) < 2


def test_order_within_a_source_is_the_fraction_order(docs):
    """Exact fractions, sorted in Python, give the same places."""
    got = sorted(interleave.interleaved(docs, 5).collect(), key=lambda r: (r.shard, r.slot))
    sources = sorted({r.source for r in got}, key=lambda s: (s is not None, s or ""))
    total, seen, want = Counter(r.source for r in got), Counter(), []
    for r in got:
        want.append(((2 * seen[r.source] + 1) / (2 * total[r.source]), sources.index(r.source)))
        seen[r.source] += 1
    assert want == sorted(want)


def test_seed_decides(docs):
    one, same, other = (
        [(r.doc_id, r.shard, r.slot) for r in sorted(interleave.interleaved(docs, 4, seed=s).collect(), key=lambda r: (r.shard, r.slot))]
        for s in (1, 1, 2)
    )
    assert one == same and one != other


def test_shard_files(spark, docs, folder):
    rows = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    interleave.write_shards(rows, f"{folder}/shards", 4)
    back = spark.read.parquet(f"{folder}/shards")
    assert back.count() == rows.count() and back.select("shard").distinct().count() == 4


def test_empty_table(no_docs):
    assert interleave.interleaved(no_docs, 40).collect() == []
