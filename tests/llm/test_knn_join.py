import math
import random

import pytest
from pyspark.sql import functions as F

from tabscope.llm import knn_join


def brute(rows, k):
    good = [(n, i, [math.floor(256 * x) for x in v]) for n, (i, v) in enumerate(rows) if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, v in good:
        if i % 3 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j) for m, j, w in good if m != n)[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("seed,n,chunk", [(0, 60, 7), (1, 200, 1000), (2, 3, 1)])
def test_against_brute_force(spark, monkeypatch, seed, n, chunk):
    monkeypatch.setattr(knn_join, "CHUNK", chunk)
    r = random.Random(seed)
    vector = lambda: [r.uniform(-1, 1) for _ in range(r.choice([6, 6, 6, 4]))]
    common = vector()
    rows = [(i, common if r.random() < 0.4 else vector()) for i in range(n)]
    rows += [(n, None), (n + 1, []), (n + 2, [1.0, None]), (n + 3, [float("nan")] * 6), (n + 4, [float("inf")] * 6), (None, common), (1, common), (3, vector()), (3, vector())]
    df = spark.createDataFrame([(i, v, 0, "s") for i, v in rows], "vec_id long, embedding array<double>, rank int, score string").repartition(3)
    got = knn_join.top_inner_products(df, F.col("vec_id") % 3 == 0, 4)
    assert sorted(tuple(x) for x in got.collect()) == brute(rows, 4)


def test_no_rows_no_queries(spark):
    df = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>")
    assert knn_join.top_inner_products(df.limit(0), F.col("vec_id") > 0, 5).collect() == []
    assert knn_join.top_inner_products(df, F.col("vec_id") > 5, 5).collect() == []
    assert knn_join.top_inner_products(df, F.col("vec_id") == 1, 5).collect() == []
