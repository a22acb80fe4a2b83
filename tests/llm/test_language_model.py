import zlib
from collections import Counter

import numpy as np
import pytest
from llm_helpers import SF, awkward, no_docs, read  # noqa: F401

from tabscope.llm import language_model as lm


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def test_stirling_numbers_and_draws():
    d = 0.4
    ways = lm.stirling(d, 4)
    # One customer after the other: a new table, or one of those there, weighted by its customers less the discount.
    seatings = Counter()

    def seat(tables, left, weight):
        if not left:
            seatings[sum(tables), len(tables)] += weight
            return
        seat([*tables, 1], left - 1, weight)
        for k in range(len(tables)):
            seat([n + (j == k) for j, n in enumerate(tables)], left - 1, weight * (tables[k] - d))

    for c in range(1, 5):
        seat([1], c - 1, 1.0)
    for (c, t), w in seatings.items():
        assert np.isclose(np.exp(ways[c, t]), w)
    n, a = 200_000, 0.7
    uniform = (np.arange(n) + 0.5) / n
    drawn = lm.draw_tables(np.full(n, 4), np.full(n, a), lm.stirling(d), d, uniform)
    p = np.array([seatings[4, t] * a**t for t in range(1, 5)])
    assert np.allclose(np.bincount(drawn.astype(int), minlength=5)[1:] / n, p / p.sum(), atol=1e-4)
    many = lm.draw_tables(np.array([1, 1000, 10**6]), np.array([5.0, 5.0, 5.0]), lm.stirling(d), d, np.array([0.3, 0.6, 0.9]))
    assert many[0] == 1 and 5 < many[1] < 200 and many[1] <= many[2] <= 10**6


@pytest.fixture(scope="module")
def trained(spark):
    return lm.train(read(spark, "documents").where("doc_id % 7 <> 2"))


def test_probabilities_of_a_context_sum_to_one(trained):
    t = trained.totals
    rows = sorted(trained.words.toArrow().to_pylist(), key=lambda r: r["word"])
    data = np.concatenate([np.frombuffer(r["data"], lm._PAIR) for r in rows])
    sizes = np.array([len(r["data"]) // lm._PAIR.itemsize for r in rows])
    tables, p, _, _ = t.gibbs(np.array([r["word"] for r in rows]), data, sizes, *trained.samples)
    assert len(rows) == t.words and data["c"].sum() == t.tokens
    parent = (p.sum() + t.unknown()) / t.sampled_mass
    assert np.isclose(parent, 1)
    own = np.bincount(data["u"], data["c"] - t.discount * tables, lm.CONTEXTS)
    total = (own + (t.strength + t.discount * t.sampled_tables) * parent) / (t.strength + t.customers)
    assert np.allclose(total, 1) and (tables <= data["c"]).all() and (tables >= 1).all()


def test_query_counts_by_brute_force_and_beats_its_base(spark):
    docs = {r.doc_id: tokens(r.text) for r in read(spark, "documents").collect()}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    counts = Counter(w for i, ws in docs.items() if not out[i] for w in ws)
    n, v = sum(counts.values()), len(counts)
    rows = lm.op1_language_model(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ws = docs[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out[r.doc_id], len(ws), sum(w in counts for w in ws), n)
        assert np.isclose(r.base_score, sum(np.log10((counts[w] + 1) / (n + v + 1)) for w in ws), rtol=1e-9) and r.score < 0
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.2 * sum(r.n_tokens for r in held)


def test_awkward_rows(spark, awkward, no_docs, trained, monkeypatch):
    rows = lm.score(awkward, trained).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in rows) == sorted((r.doc_id or -1, len(tokens(r.text))) for r in awkward.collect())
    assert all(np.isfinite(r.score) and np.isfinite(r.base_score) for r in rows)
    assert lm.score(no_docs, trained).collect() == []
    nothing = lm.train(no_docs)
    assert {r.n_known for r in lm.score(awkward, nothing).collect()} == {0}
    # Words of many occurrences go to several tasks and blocks are small; the scores stay as they are.
    docs = read(spark, "documents")
    want = {r.doc_id: r.score for r in lm.score(docs, trained).collect()}
    monkeypatch.setattr(lm, "SHARE", 300)
    dealt = lm.train(docs.where("doc_id % 7 <> 2"))
    assert len(dealt.shares[0]) > 2 and max(dealt.shares[1]) > 2
    got = {r.doc_id: r.score for r in lm.score(docs.repartition(5), dealt).collect()}
    assert got.keys() == want.keys() and all(np.isclose(got[i], want[i], rtol=1e-5) for i in want)


def test_tables_of_many_customers_follow_the_exact_conditional():
    n = 400
    uniform = (np.arange(n) + 0.5) / n
    for d, w, c in [(0.8, 1, 200), (0.8, 1, 2000), (0.8, 10, 2000), (0.95, 100, 2000), (0.95, 100, 200), (0.3, 30, 1500), (0.3, 2000, 1500), (0.8, 1e5, 1100)]:
        row = np.full(c + 2, -np.inf)
        row[1] = 0.0
        for k in range(1, c):
            t = np.arange(1, k + 1)
            row[1 : k + 2] = np.logaddexp(row[: k + 1], np.append(row[1 : k + 1] + np.log(k - d * t), -np.inf))
        p = np.exp((p := row[1 : c + 1] + np.log(w) * np.arange(1, c + 1)) - p.max())
        p = np.cumsum(p / p.sum())
        want = 1 + np.searchsorted(p, uniform)
        args = np.full(n, c), np.full(n, float(w)), lm.stirling(d), d, uniform
        assert (lm.draw_tables(*args) == want).mean() > 0.99, (d, w, c)
        assert (lm._draw_many(args[0].astype(float), args[1] / d, d, uniform) == want).mean() > 0.99, (d, w, c)
    # With ever more customers the tables beside the largest are Poisson with mean w / d.
    for c in (10**7, 10**9):
        assert abs(lm.draw_tables(np.full(n, c), np.full(n, 4.0), lm.stirling(0.8), 0.8, uniform).mean() - 6) < 0.05


def test_words_of_their_own_are_chosen_from_exact_counts(spark, monkeypatch):
    # Rare in each task, frequent in all: more words than a task may keep come before it.
    texts = [" ".join([f"t{k}w{i}" for i in range(70_000)] * 2 + ["everywhere"]) for k in range(4)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    for held in (lm.HELD, 1000):
        monkeypatch.setattr(lm, "HELD", held)
        rows = docs.selectExpr("cast(text as binary) as __text").mapInArrow(lm._frequencies, "word long, n long").groupBy("word").sum("n").collect()
        counts = {r[0]: r[1] for r in rows}
        assert len(counts) == 4 * 70_000 + 2 and sum(counts.values()) == 4 * 140_002
        assert counts[int(np.array([lm._tokens([b"everywhere"])[0][0]], np.uint64).view(np.int64)[0])] == 4


def test_tokens_are_hashed_by_their_letters_alone(monkeypatch):
    long = b"x" * 5000
    texts = [b"", b" \t\n", b"A b\x0bA\x1cb", b"", long + b" " + long.upper() + b" " + b"y" * 4096, b"a" + b" " * 9000 + b"B\xc3\x84", b"ab ba aa a", b" ".join([long, b"a", long + b"x"])]
    texts += [b" ".join(b"w%d" % (i * i % 997) for i in range(3000))]
    for chunk in (lm._CHUNK, 64):
        monkeypatch.setattr(lm, "_CHUNK", chunk)
        hashes, counts = lm._tokens(texts)
        want = [w for t in texts for w in [*t.lower().split(), None]]
        assert counts.tolist() == [len(t.split()) + 1 for t in texts] and len(hashes) == len(want)
        of = {}
        assert all(of.setdefault(w, h) == h for w, h in zip(want, hashes.tolist(), strict=True))
        assert len(set(of.values())) == len(of) and of[None] == lm.END
    assert [len(x) for x in lm._tokens([])] == [0, 0]
