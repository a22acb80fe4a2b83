import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_helpers import SF, awkward, no_docs, read  # noqa: F401

from tabscope.llm import collocations as m

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, least, longest=5, percent=100, top=2000):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        low = re.sub("[A-Z]", lambda x: x[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            ws = re.findall("[^\x20\x09]+", piece)
            total[lang or "und"] += len(ws)
            for size in range(1, longest + 1):
                for k in range(len(ws) - size + 1):
                    counts[lang or "und"][tuple(ws[k : k + size])] += 1
    out = []
    for lang, f in counts.items():
        frequent = {p: c for p, c in f.items() if c >= least}
        kept = []
        for p, a in frequent.items():
            if len(p) < 2 or any(100 * c >= percent * a and any(q[k : k + len(p)] == p for k in range(len(q))) for q, c in frequent.items() if len(q) > len(p)):
                continue
            score, k = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def corpus(seed):
    r = random.Random(seed)
    rows = []
    for _ in range(70):
        text = ""
        for _ in range(r.randrange(30)):
            text += r.choice(["New York city", "new york", "éa Éa", "a b a b a b", "the", "big", "x\ty", "New  york CITY hall", "of the", "Ω"])
            text += r.choice([" ", " ", " ", "  ", ". ", ",", "\n", "\r\n", "\x0b", "-", "\x1c", " "])
        rows.append((r.choice(["en", "en", "en", "de", None]), text if r.random() < 0.95 else None))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(x, t, 1, "p") for x, t in rows], "lang string, text string, n int, phrase string").repartition(4)


@pytest.mark.parametrize("seed,least,percent,chunk", [(0, 5, 100, 300), (1, 2, 100, 1 << 24), (2, 8, 60, 2000)])
def test_against_brute_force(spark, monkeypatch, seed, least, percent, chunk):
    monkeypatch.setattr(m, "CHUNK", chunk)
    rows = corpus(seed)
    out = m.phrases(frame(spark, rows), least=least, percent=percent)
    assert out.columns == COLUMNS and all(kind == "bigint" for name, kind in out.dtypes if name not in ("lang", "phrase"))
    assert sorted(tuple(x) for x in out.collect()) == brute(rows, least, percent=percent) != []


def test_top_and_longest(spark):
    rows = corpus(3)
    got = m.phrases(frame(spark, rows), least=3, longest=3, top=4).collect()
    assert sorted(tuple(x) for x in got) == brute(rows, 3, longest=3, top=4)
    assert sorted(tuple(x) for x in m.phrases(frame(spark, rows), least=3, top=None).collect()) == brute(rows, 3, top=10**6)


def test_joins_of_a_chunk():
    codes = np.array([0, 1, 2, 1, 2, 0, 2, 1, 0, 0, 3, 3, 3], np.int32)
    a, b, n, longer = m.adjacent(codes, np.array([2, 1, 3]))
    assert sorted(zip(a.tolist(), b.tolist(), n.tolist(), strict=True)) == [(0, 1, 2), (1, 0, 2), (2, 2, 2)]
    assert m.compact(np.array([0, 0, 1, 0, 0, 2, 2, 0, 0])).tolist() == [1, 0, 2, 2, 0] and len(longer[longer > 0]) == 6
    a, b, n, longer = m.adjacent(np.zeros(0, np.int32), np.zeros(0, np.int64))
    assert len(a) == len(b) == len(n) == len(longer) == 0
    r = np.random.default_rng(0)
    columns = [np.sort(r.integers(0, 1 << 50, 1000)), r.integers(-5, 1 << 62, 1000), r.integers(0, 9, 1000)]
    assert all((x == y).all() for x, y in zip(columns, m.unpack(m.pack(*columns), 3), strict=True))
    assert [len(x) for x in m.unpack(m.pack(*[np.zeros(0, np.int64)] * 2), 2)] == [0, 0]
    assert m._unpack_codes(m._pack_codes(columns[2])).tolist() == columns[2].tolist()
    assert m.tokens(b"Ab c.D\x0c\te") == [b"ab", b"c", b".", b"d", b".", b"e"]


def test_exact_products(spark):
    row = spark.range(1).selectExpr("cast(900000000000001 as bigint) as a", "cast(999999999999999989 as bigint) as n", "cast(900000000000007 as bigint) as l", "cast(900000000000011 as bigint) as r")
    from pyspark.sql import functions as F

    p, q = m._exact(1000 * F.col("a")) * m._exact(F.col("n")), m._exact(F.col("l")) * m._exact(F.col("r"))
    got = row.withColumns({"p": p, "q": q}).selectExpr("p div q as s").first().s
    assert got == 1000 * 900000000000001 * 999999999999999989 // (900000000000007 * 900000000000011)


def test_query_and_awkward_rows(spark, awkward, no_docs):
    rows = [(x.lang, x.text) for x in read(spark, "documents").collect()]
    assert sorted(tuple(x) for x in m.op13_collocations(spark, SF).collect()) == brute(rows, 100)
    rows = [(x.lang, x.text) for x in awkward.collect()]
    assert sorted(tuple(x) for x in m.phrases(awkward, least=2).collect()) == brute(rows, 2)
    assert m.phrases(no_docs).collect() == []
    with pytest.raises(ValueError):
        m.phrases(awkward, longest=1)
