import hashlib
import random
import zlib

import numpy as np
import pytest
from llm_helpers import SF, awkward, no_docs, read  # noqa: F401

from tabscope.llm import periodic_runs as m


def brute(ws, least=24, times=3):
    """Runs by trying every period; a stretch with a smaller period as well is none."""
    numbers = {w: k for k, w in enumerate(dict.fromkeys(ws))}
    codes = np.array([numbers[w] for w in ws], np.int64)
    out = []
    for q in range(1, len(ws) // times + 1):
        same = np.diff(np.concatenate([[0], codes[q:] == codes[:-q], [0]]))
        for k, stop in zip(np.flatnonzero(same == 1).tolist(), np.flatnonzero(same == -1).tolist(), strict=True):
            n = stop - k + q
            part = codes[k : k + n]
            if n >= max(least, times * q) and not any((part[p:] == part[:-p]).all() for p in range(1, q)):
                out.append((k, n, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def texts(seed):
    r = random.Random(seed)
    for _ in range(60):
        ws = []
        while len(ws) < r.randrange(10, 160):
            part = [r.choice("abc") for _ in range(r.randrange(1, 12))]
            ws += part * r.choice([1, 1, 2, 3, 4, 9]) + part[: r.randrange(len(part) + 1)]
        yield ws
    a, b = "a", "ab"
    for _ in range(8):
        a, b = b, b + a
    yield list(b)  # Fibonacci word
    yield ["x"] * 100
    yield []


@pytest.mark.parametrize("least,times", [(24, 3), (2, 2), (5, 2), (7, 4)])
def test_runs_against_brute_force(least, times):
    for seed in range(4):
        for ws in texts(seed):
            codes = [ord(w) for w in ws]
            assert m.runs(codes, least, times) == brute(ws, least, times)


def test_stretches_hold_whole_runs():
    for least, times in ((24, 3), (5, 2)):
        width = m.shared_width(least, times)
        for seed in range(4):
            all_texts = list(texts(seed))
            codes = np.concatenate([np.array([ord(w) for w in ws], np.uint64) for ws in all_texts])
            ends = np.cumsum([len(ws) for ws in all_texts])
            found = m.stretches(codes, ends, width)
            assert all(sum(a < e <= b - 1 for e in ends) == 0 for a, b in found)
            for ws, end in zip(all_texts, ends, strict=True):
                for s, n, _ in brute(ws, least, times):
                    assert any(a <= end - len(ws) + s and end - len(ws) + s + n <= b for a, b in found)
    assert m.shared_width() == 16


def test_long_periodic_text():
    r = random.Random(1)
    head, unit = [r.randrange(50) for _ in range(3000)], [r.randrange(50) for _ in range(700)]
    codes = head + unit * 20 + [99]
    assert m.runs(codes) == brute(codes) != []


def expected(i, text):
    ws = (text or "").encode().split()
    h, n = (zlib.crc32(str(i).encode()), len(ws)) if i is not None else (1, 0)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = [ws[k] if k < a else ws[a + (k - a) % p] for k in range(n)]
    rs = brute(ws)
    best = max(rs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    drop = {k for s, c, q in rs for k in range(s + q, s + c)}
    left = b" ".join(w for k, w in enumerate(ws) if k not in drop)
    lines = "".join(f"{s},{c},{q}\n" for s, c, q in rs)
    numbers = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (i, len(rs), *numbers, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest())


def test_query(spark):
    got = sorted(tuple(r) for r in m.op11_periodic_runs(spark, SF).collect())
    assert got == sorted(expected(r.doc_id, r.text) for r in read(spark, "documents").collect())
    assert any(x[1] for x in got)


def test_awkward_rows(spark, awkward, no_docs):
    rows = m.periodic_runs(awkward)
    assert rows.columns == ["doc_id", "n_words", "runs", "collapsed"]
    got = {(r.doc_id, r.n_words): r for r in rows.collect()}
    assert rows.count() == awkward.count()
    assert got[(3, 0)].runs == [] and got[(3, 0)].collapsed == "" and got[(None, 0)].collapsed == ""
    assert [r.collapsed for r in got.values() if r.doc_id == 8] == [" ".join("ünï cödé 日本 🙂 \x00 ▁ <s> <|endoftext|>".split(" "))]
    assert m.periodic_runs(no_docs).collect() == []
    changed = m.periodic_runs(spark.createDataFrame([("a", "x  y\n" * 12 + "z")], "runs string, text string"), "runs", least=4, times=2, change=m.planted_period).collect()
    assert [tuple(x) for x in changed[0][2]] == [(0, 24, 2)] and changed[0][3] == "x y z"
    with pytest.raises(ValueError):
        m.periodic_runs(awkward, times=1)
