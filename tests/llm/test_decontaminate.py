import random

import pytest
from llm_helpers import no_docs, pairs  # noqa: F401

from tabscope.llm import decontaminate as d


def brute(text, items, window):
    doc, hit, names = d.words(text), set(), set()
    for name, item in items:
        ws = d.words(item)
        n = min(window, len(ws))
        for k in range(len(ws) - n + 1 if n else 0):
            for at in range(len(doc) - n + 1):
                if doc[at : at + n] == ws[k : k + n]:
                    hit.update(range(at, at + n))
                    names.add(name)
    return hit, names


@pytest.mark.parametrize("seed", range(40))
def test_automaton_against_brute_force(seed):
    r = random.Random(seed)
    word = lambda: r.choice(["a", "b", "c"][: r.randint(1, 3)])
    text = lambda n: " ".join(word() for _ in range(r.randint(0, n))).encode()
    items = [(str(i), text(9)) for i in range(r.randint(0, 5))]
    automaton = d.SuffixAutomaton([(n, d.words(t)) for n, t in items], 4)
    for _ in range(10):
        doc = text(30)
        spans, names = automaton.spans(d.words(doc))
        hit, want = brute(doc, items, 4)
        assert {k for a, b in spans for k in range(a, b)} == hit and names == want
        assert spans == sorted(spans) and all(b < c for (_, b), (c, _) in zip(spans, spans[1:], strict=False))


ITEMS = [("7", "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"), ("x", "short item"), ("y", ""), ("z", None), (None, "no name for this")]


@pytest.fixture(scope="module")
def frames(spark):
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    docs = spark.createDataFrame(
        [
            (1, "Say: ONE two, three four five six seven eight nine ten eleven twelve thirteen! " + "and more words " * 5, "k"),
            (2, "one two three four five six seven eight nine ten eleven twelve", "k"),
            (3, "a Short-Item é of little use " + "word " * 100, "k"),
            (4, None, None),
            (5, "", "k"),
            (6, "there is no name for this", "k"),
            (6, "there is no name for this", "k"),
        ],
        "doc_id long, text string, items string",
    )
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_passages(frames, block_bytes):
    found = d.find_passages(*frames, block_bytes=block_bytes).withColumn("n_hit", d.n_hit()).withColumn("bad", d.contaminated())
    rows = {r.doc_id: (r.n_words, r.n_hit, r["items"], r.bad) for r in found.collect()}
    assert rows == {1: (29, 13, ["7"], True), 2: (12, 0, [], False), 3: (107, 2, ["x"], False), 4: (0, 0, [], False), 5: (0, 0, [], False), 6: (6, 4, [], True)}


def test_removal(frames):
    docs, items = frames
    kept = d.remove_passages(docs, items, drop=True)
    assert kept.columns == docs.columns and pairs(kept, "doc_id") == [(2,), (3,), (4,), (5,)]
    cut = {r.doc_id: r.text for r in d.remove_passages(docs, items, least_words=3).collect()}
    assert cut[1] == "Say: ! " + "and more words " * 5 and cut[6] == "there is " and cut[3].startswith("a Short-Item é") and cut[4] is None


def test_empty_tables(frames, no_docs):
    docs, items = frames
    assert d.find_passages(no_docs, items).collect() == []
    assert {r["spans"] == [] for r in d.find_passages(docs, items.limit(0)).collect()} == {True}


def test_a_long_passage_goes_from_documents_below_the_coverage_limit(spark):
    passage, rest = " ".join(f"q{i}" for i in range(40)), [f"w{i}" for i in range(900)]
    start, end = " ".join(rest[:300]), "a short item " + " ".join(rest[300:])
    items = spark.createDataFrame([(1, passage), (2, "short item")] + [(1, passage)] * 50, "item_id long, text string")
    texts = {1: f"{start} {passage} {end}", 2: f"Say: {passage}", 3: end, 4: start, 5: None, 6: ""}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    # 42 of 943 words are hit: fewer than a twentieth, so the two of the short item stay.
    want = texts | {1: f"{start}  {end}", 2: "Say: "}
    for drop in (True, False):
        left = d.remove_passages(docs, items, drop=drop).collect()
        assert {r.doc_id: r.text for r in left} == {i: t for i, t in want.items() if i != 2 or not drop}


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_repeated_items_are_read_once(frames, spark, block_bytes):
    _, items = frames
    blocks = list(d.item_blocks(items.unionAll(items).unionAll(items), "item_id", "text", block_bytes))
    assert sorted((str(n), t.decode()) for block, _ in blocks for n, t in block) == sorted((str(n), t) for n, t in ITEMS if t)
    assert [last for _, last in blocks] == [False] * (len(blocks) - 1) + [True]
    assert list(d.item_blocks(items.limit(0), "item_id", "text", block_bytes)) == [([], True)]


def test_removal_is_one_step_in_python(frames):
    docs, items = frames
    plan = d.remove_passages(docs, items, drop=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "EvalPython" not in plan


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_removal_over_blocks(frames, block_bytes, monkeypatch):
    docs, items = frames
    whole = d.item_blocks
    monkeypatch.setattr(d, "item_blocks", lambda *a: whole(*a[:-1], block_bytes))
    left = {r.doc_id: r for r in d.remove_passages(docs, items, least_words=4).collect()}
    assert {i: r.text for i, r in left.items() if i > 2} == {3: docs.where("doc_id = 3").first().text, 4: None, 5: "", 6: "there is "}
    assert left[1].text == "Say: ! " + "and more words " * 5 and left[1]["items"] == "k" and left[4]["items"] is None
    assert {r.doc_id for r in d.remove_passages(docs, items, drop=True).collect()} == {2, 3, 4, 5}
