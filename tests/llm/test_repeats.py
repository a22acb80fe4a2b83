import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from llm_helpers import SF, awkward, no_docs, read  # noqa: F401

from tabscope.llm import repeats as m
from tabscope.llm.suffix_arrays import common_prefixes, factors, passage_order, suffix_order


@pytest.mark.parametrize("seed", range(30))
def test_factors_against_brute_force(seed):
    r = np.random.default_rng(seed)
    x = r.integers(0, r.integers(1, 4), r.integers(1, 60))
    depth = int(r.integers(1, 80))
    lcp = lambda i, j: next((k for k in range(min(len(x) - max(i, j), depth)) if x[i + k] != x[j + k]), min(len(x) - max(i, j), depth))
    order, levels = suffix_order(x, depth)
    assert [tuple(x[i : i + depth]) for i in order] == sorted(tuple(x[i : i + depth]) for i in range(len(x)))
    shared = common_prefixes(order, levels)
    assert shared.tolist() == [0] + [lcp(order[k - 1], order[k]) for k in range(1, len(x))]
    starts = np.arange(max(0, len(x) - depth + 1))
    placed, same = passage_order(x, starts, depth)
    assert placed.tolist() == sorted(starts.tolist(), key=lambda i: (tuple(x[i : i + depth]), i))
    assert same.tolist() == [depth * (k > 0 and lcp(placed[k - 1], placed[k]) == depth) for k in range(len(placed))]
    for earlier in (True, False):
        long = factors(placed, same, earlier)
        assert [bool(long[i]) for i in starts] == [any(lcp(i, j) == depth for j in (range(i) if earlier else range(i + 1, len(starts)))) for i in starts]
    assert factors(order, shared).tolist() == [max([lcp(i, j) for j in range(i)], default=0) for i in range(len(x))]
    assert factors(order, shared, earlier=False).tolist() == [max([lcp(i, j) for j in range(i + 1, len(x))], default=0) for i in range(len(x))]


def brute(docs, length, earlier):
    """docs: (order, text); a result for each."""
    places = Counter(t[k : k + length] for _, t in docs for k in range(len(t) - length + 1))
    seen, out = set(), {}
    for n, (_, t) in sorted(enumerate(docs), key=lambda x: x[1][0]):
        hit = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - length + 1):
            w = t[k : k + length]
            if (w in seen) if earlier else places[w] > 1:
                hit[k : k + length] = True
            seen.add(w)
        runs = int((np.diff(np.concatenate([[0], hit.astype(int)])) == 1).sum())
        out[n] = (len(t), int(hit.sum()), runs, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~hit[:-1]])).hexdigest())
    return [out[n] for n in range(len(docs))]


def texts(seed):
    r = random.Random(seed)
    word = lambda: r.choice(["ab", "ba", "cde", "é", "x"])
    base = "".join(word() for _ in range(120))
    out = []
    for i in range(25):
        kind = r.random()
        t = base[r.randrange(60) : 60 + r.randrange(60)] if kind < 0.5 else "".join(word() for _ in range(r.randrange(60)))
        t = t + r.choice(["", "z" * r.randrange(40), base[:30] + r.choice("pqrs") + base[30:70]])
        out.append((i, t))
    return out + [(25, ""), (26, "a"), (27, "y" * 90), (28, "é" * 30)]


@pytest.mark.parametrize("seed,many", [(0, 1024), (1, 1024), (2, 1), (3, 1)])
def test_against_brute_force(spark, monkeypatch, seed, many):
    monkeypatch.setattr(m, "SEGMENTS", many)  # with 1 every anchor of several segments goes by hashes
    docs = texts(seed)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, spans string, start long").repartition(4)
    for earlier in (False, True):
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in m.repeats(df, length=12, earlier=earlier).collect()}
        assert [got[i] for i, _ in docs] == brute([(i, t.encode()) for i, t in docs], 12, earlier)


def test_long_texts_are_cut_into_pieces(spark, monkeypatch):
    r = random.Random(1)
    long = bytes(r.choice(b"abcdefgh") for _ in range(700_000))
    found = [long, long[500_000:500_300], b"-" * 10]
    keys = [x for _, _, _, key in m.segments(found, 200) for x in key.tolist()]
    short = [x for _, _, _, key in m.segments([found[1]], 200) for x in key.tolist()]
    assert set(short) <= set(keys)
    starts = sorted((s, s + n) for t, start, n, _ in m.segments([long], 200) for s, n in zip(start.tolist(), n.tolist(), strict=True))
    assert starts[0][0] == 0 and starts[-1][1] == len(long) - 199 and all(a[1] == b[0] for a, b in zip(starts, starts[1:], strict=False))


def test_awkward_rows(awkward, no_docs):
    rows = m.repeats(awkward, length=20).collect()
    assert len(rows) == awkward.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert [r.n_removed == r.n_bytes > 0 for r in by[1]] == [True, True]  # rows of equal id and text are copies
    assert by[3][0].n_bytes == by[3][0].n_spans == 0 and by[7][0].n_removed == 5000
    cleaned = m.remove_repeats(awkward, length=20)
    assert cleaned.columns == awkward.columns
    texts_ = sorted((r.doc_id or -1, r.text or "") for r in cleaned.collect())
    assert len(texts_) == awkward.count() and (3, "") in texts_
    assert [t for i, t in texts_ if i == 2] == ["the cat"[:1]]  # all but "t" stands in document 1
    assert cleaned.where("doc_id = 3 AND text IS NULL").count() == 1
    assert m.repeats(no_docs).collect() == [] and m.remove_repeats(no_docs).collect() == []


def test_whole_characters(spark):
    a = "é" * 20
    df = spark.createDataFrame([(1, "a" + a), (2, a + "b")], "doc_id long, text string")
    texts_ = {r.doc_id: r.text for r in m.remove_repeats(df, length=9).collect()}
    assert texts_[1].encode().decode() == texts_[1] and texts_[2].endswith("b") and len(texts_[2]) < 20


def test_query(spark):
    docs = [(r.doc_id, (r.text or "").encode()) for r in read(spark, "documents").orderBy("doc_id").collect()]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in m.op7_repeats(spark, SF).collect()}
    assert [got[i] for i, _ in docs] == brute(docs, 200, False)
