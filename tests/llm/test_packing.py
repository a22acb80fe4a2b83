import itertools
import random
from collections import defaultdict

import pytest
from llm_helpers import SF, awkward, no_docs, read  # noqa: F401

from tabscope.llm import packing as p


@pytest.mark.parametrize("seed", range(30))
def test_boundaries_against_brute_force(seed):
    r = random.Random(seed)
    tops = sorted(r.sample(range(1, 60), r.randint(1, 9)))
    counts = [r.randint(1, 20) for _ in tops]
    cost = lambda ends: sum(n * next(e for e in sorted(ends) if e >= t) for t, n in zip(tops, counts, strict=True))
    for buckets in (1, 2, 3, 20):
        got = p.boundaries(tops, counts, buckets)
        assert len(got) <= buckets and got[-1] == tops[-1] and set(got) <= set(tops)
        best = min(cost([*c, tops[-1]]) for k in range(min(buckets, len(tops))) for c in itertools.combinations(tops[:-1], k))
        assert cost(got) == best
    assert p.boundaries([], [], 4) == []


def check(rows, budget, shard):
    batches = defaultdict(list)
    for r in rows:
        assert r.n_tokens <= r.bucket_length
        batches[r.batch].append(r)
    for rs in batches.values():
        assert len({r.bucket for r in rs}) == 1 and sorted(r.slot for r in rs) == list(range(len(rs)))
        assert len(rs) * rs[0].bucket_length <= budget or len(rs) == 1
    for bucket, rs in itertools.groupby(sorted(rows, key=lambda r: r.bucket), key=lambda r: r.bucket):
        rs = list(rs)
        room = max(1, budget // rs[0].bucket_length)
        short = sum(len(batches[b]) < room for b in {r.batch for r in rs})
        assert short <= max(1, -(-len(rs) // shard))


@pytest.mark.parametrize("budget,shard", [(16_384, 50_000), (700, 50_000), (700, 20)])
def test_batches(spark, monkeypatch, budget, shard):
    monkeypatch.setattr(p, "SHARD", shard)
    docs = read(spark, "documents")
    rows = p.pack_documents(docs, budget=budget, buckets=5).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in rows) == sorted((r.doc_id, len(r.text.encode().split()) + 1) for r in docs.collect())
    assert len({r.bucket for r in rows}) == 5
    check(rows, budget, shard)


def test_query(spark):
    rows = p.op10_packing(spark, SF).collect()
    assert len(rows) == read(spark, "documents").count()
    check(rows, 16_384, p.SHARD)


def test_awkward_rows(spark, awkward, no_docs):
    rows = p.pack_documents(awkward).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in rows) == sorted((r.doc_id or -1, len((r.text or "").encode().split()) + 1) for r in awkward.collect())
    check(rows, 16_384, p.SHARD)
    assert p.pack_documents(no_docs).collect() == []
    nulls = spark.createDataFrame([(1, None), (2, 5), (2, 5)], "doc_id long, n_tokens long")
    assert sorted((r.doc_id, r.bucket is None) for r in p.pack(nulls).collect()) == [(1, True), (2, False), (2, False)]


def test_boundaries_between_like_lengths(spark):
    r = random.Random(3)
    counts = {n: r.randint(1, 30) for n in [*range(1000, 1012), 5000, 5001, 5002]}
    lengths = spark.createDataFrame([(n, n) for n, c in counts.items() for _ in range(c)], "doc_id long, n_tokens long")
    cost = lambda ends: sum(c * next(e for e in sorted(ends) if e >= n) for n, c in counts.items())
    best = min(cost([*c, 5002]) for c in itertools.combinations(sorted(counts)[:-1], 4))
    rows = p.pack(lengths, buckets=5).collect()
    assert sum(r.bucket_length for r in rows) == best
    check(rows, 16_384, p.SHARD)
    r = random.Random(4)  # many distinct lengths are no burden
    tops = sorted(r.sample(range(1, 10**6), 20_000))
    assert len(p.boundaries(tops, [r.randint(1, 9) for _ in tops], 16)) == 16
