import numpy as np
from llm_helpers import SF, awkward, no_docs, read  # noqa: F401

from tabscope.llm import quality as q


def test_gradients():
    model = q.Network(1)
    r = np.random.default_rng(0)
    windows = r.integers(97, 105, (5, q.BLOCK * q.BLOCKS + q.WIDTH)).astype(np.int32)
    marks, weights = np.array([0, 1, 1, 0, 1], np.float32), np.array([1, 2, 1, 1, 0.5], np.float32)

    def loss():
        n = windows.shape[1] - q.WIDTH
        total = sum(model.tables[j][windows[:, j : j + n]].astype(float) for j in range(q.WIDTH))
        hidden = np.maximum(np.maximum(total.max(1) + model.bias, 0) @ model.dense + model.dense_bias, 0)
        z = hidden @ model.out + model.out_bias
        return (weights * (np.log1p(np.exp(-z)) + (1 - marks) * z)).sum() / len(marks)

    for name, g in model._gradients(windows, marks, weights).items():
        at = np.unravel_index(abs(g).argmax(), g.shape)
        p = getattr(model, name)
        before, step = p[at], 1e-3
        p[at] = before + step
        up = loss()
        p[at] = before - step
        down = loss()
        p[at] = before
        assert np.isclose((up - down) / (2 * step), g[at], rtol=0.05, atol=1e-4), name


def test_chunks_cover_all_and_texts_are_apart():
    assert q.chunk_rows(np.array([1, 4, 5, 8]))[1].tolist() == [1, 1, 2, 3]
    rows, _ = q.chunk_rows(np.array([9]))
    assert set(rows.ravel().tolist()) == set(range(9))
    model = q.Network(2)
    texts = [b"", b"a", b"some text " * 300, "é".encode() * 10_000, b"x" * 511]
    alone = np.concatenate([model.chunk_odds([t])[0] for t in texts])
    assert np.allclose(model.chunk_odds(texts)[0], alone, atol=1e-4)


def test_query_on_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in read(spark, "labels").collect()}
    rows = q.op9_quality(spark, SF).collect()
    assert len(rows) == read(spark, "documents").count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    good, poor = ([r.score for r in held if labels[r.doc_id] == y] for y in (1, 0))
    assert np.mean([g > p for g in good for p in poor]) >= 0.9
    assert np.mean([g >= 0.3 for g in good]) >= 0.9


def test_awkward_rows(spark, awkward, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 0, 1), (4, None, 0), (None, 1, 0), (6, 1, 0), (9, 0, 0)], "doc_id long, quality int, toxic int")
    model = q.train(awkward, labels)
    got = q.score(awkward, model, keep=["doc_id", "score", "text"]).collect()
    assert len(got) == awkward.count() and all(0 <= r[-1] <= 1 for r in got)
    kept = q.filter_quality(awkward, model, 0.0)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()
    assert q.filter_quality(awkward, model, 1.1).count() == 0
    assert q.score(no_docs, model).collect() == []
    one = q.train(awkward, labels.where("quality = 1"))
    assert {r.score for r in q.score(awkward, one).collect()} == {(3 - 1) / 4 + 0.25}
    assert {r.score for r in q.score(awkward, q.train(no_docs, labels.limit(0))).collect()} == {0.5}
