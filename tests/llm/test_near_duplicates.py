import random

import numpy as np
import pytest
from llm_helpers import SF, awkward, no_docs, pairs, read  # noqa: F401

from tabscope.llm import common
from tabscope.llm import near_duplicates as m
from tabscope.llm.components import components


def sets_of(text, size):
    ws = (text or "").encode().lower().split()
    return {tuple(ws[k : k + size]) for k in range(len(ws) - size + 1)} if len(ws) >= size else {tuple(ws)} - {()}


def brute(rows, size, percent):
    """Smallest id of the component of each of (id, text), ids told apart by place."""
    sets = [sets_of(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(sets[k]), least.get(find(k))) for k, (i, _) in enumerate(rows)), key=str)


def corpus(seed):
    """Families whose members are edits of each other's edits, so that links form chains, and texts that share much but too little."""
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(400)}"
    rows = []
    for _ in range(4):
        family = [[word() for _ in range(r.choice([3, 20, 90]))]]
        for _ in range(25):
            t = list(r.choice(family))
            for _ in range(max(1, int(len(t) * r.choice([0.01, 0.03, 0.05, 0.08])))):
                t[r.randrange(len(t))] = word()
            family.append(t)
        rows += [" ".join(t).upper() if r.random() < 0.1 else "  ".join(t) for t in family]
    rows += ["", " ", None, "one", "ONE", "one two", rows[3], rows[3]]
    r.shuffle(rows)
    return [(i if r.random() < 0.97 else None, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed,size,block", [(0, 2, 1024), (1, 5, 1024), (2, 2, 4)])
def test_against_brute_force(spark, monkeypatch, seed, size, block):
    monkeypatch.setattr(m, "BLOCK", block)
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, 0, "c") for i, t in rows], "doc_id long, text string, n_shingles long, root string").repartition(3)
    got = m.near_duplicates(df, size=size).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, size, 80)


def test_components(spark):
    r = random.Random(3)
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + r.randrange(50)) for _ in range(30)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(pairs(components(spark.createDataFrame(links, "a long, b long")), "node", "root"))
    assert got == {**{k: 0 for k in range(1, 41)}, **{b: 100 for _, b in links if 100 < b < 200}, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_sketches_estimate_similarity():
    r = np.random.default_rng(0)
    for share in (0.7, 0.8, 0.95):
        n = 900
        common = int(2 * n * share / (1 + share))
        both = r.integers(0, 1 << 62, common, dtype=np.uint64)
        a, b = (np.unique(np.concatenate([both, r.integers(0, 1 << 62, n - common, dtype=np.uint64)])) for _ in "ab")
        x = m.odd_sketches(m.samples([a, b]))
        bits = int(m.differing(x[:1], x[1:])[0, 0])
        got = 1 + m.BITS / (4 * m.SAMPLES) * np.log(1 - 2 * bits / m.BITS)
        assert abs(got - share) < 0.17 and bits <= m.MOST


def unlinked(n, seed=11):
    """Texts that share much with each other and too little for a link: about 0.57 of their word pairs."""
    r = random.Random(seed)
    base = [f"b{k}" for k in range(28)]
    rows = []
    for k in range(n):
        t = list(base)
        for at in r.sample(range(28), 2):
            t[at] = f"n{k}x{at}"
        rows.append((k, " ".join(t)))
    return rows


def test_rows_grow_with_the_documents(spark, monkeypatch):
    counts, kept = [], m._may_join

    def counting(*frames):
        out = common.stored(kept(*frames))
        counts.append(out.count())
        return out

    monkeypatch.setattr(m, "_may_join", counting)
    for n in (250, 500, 1000):
        rows = unlinked(n)
        got = m.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), size=2).collect()
        if n == 250:
            assert sorted((tuple(r) for r in got), key=str) == brute(rows, 2, 80)
    assert counts[1] < 2.3 * counts[0] and counts[2] < 2.3 * counts[1] and counts[2] <= 2 * m.BANDS * 1000


def test_keep_one(awkward, no_docs):
    kept = m.keep_one(awkward)
    assert kept.columns == awkward.columns
    # 1 twice and 2 are one text; every other row stays, those without words or ids among them.
    left = sorted((r.doc_id or -1, (r.text or "")[:10]) for r in kept.collect())
    want = sorted({(r.doc_id or -1, (r.text or "")[:10]) for r in awkward.collect() if r.doc_id != 2})
    assert left == want
    assert m.keep_one(no_docs).collect() == [] and m.near_duplicates(no_docs).collect() == []


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, "documents").collect()]
    got = m.op8_near_duplicates(spark, SF).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, 2, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
