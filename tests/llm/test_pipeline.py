"""Each stage on what its predecessor kept, beside brute force, and queries beside their SQL."""

import os
import random
import sys

import pytest

sys.path.append(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import test_decontaminate
import test_near_duplicates
from check_oracle import compare, connect
from llm_helpers import SF, awkward, no_docs, read  # noqa: F401

import corpus_pipeline as p
from tabscope.llm import common, decontaminate, packing, quality, queries
from tabscope.llm.repeats import _removed, _whole_characters


def planted(spark):
    """The documents with copies, edited copies, a passage that many share, and one of the benchmark."""
    r = random.Random(2)
    docs = [tuple(x) for x in read(spark, "documents").collect()]
    item = max((x.text for x in read(spark, "benchmark").collect()), key=len)
    passage = " ".join(f"shared{k}" for k in range(60))
    more = []
    for k in range(6):
        i, text, *rest = docs[r.randrange(len(docs))]
        words = text.split(" ")
        words[len(words) // 2] = "changed"
        more += [(5000 + 3 * k, text, *rest), (5001 + 3 * k, " ".join(words), *rest), (5002 + 3 * k, f"{passage} {text[:150]} {k}", *rest)]
    more.append((6000, f"{item} and few words more", "en", "src1", 1))
    return spark.createDataFrame(docs + more, read(spark, "documents").schema).repartition(4)


def first_stays(docs, length=200):
    seen, out = set(), {}
    for i, text in sorted(docs):
        raw, runs = (text or "").encode(), []
        for k in range(len(raw) - length + 1):
            w = raw[k : k + length]
            if w in seen:
                runs = [*runs[:-1], (runs[-1][0], k + length)] if runs and k <= runs[-1][1] else [*runs, (k, k + length)]
            seen.add(w)
        out[i] = _removed(raw, _whole_characters(raw, runs)).decode()
    return out


def test_stages(spark):
    docs = common.stored(planted(spark))
    columns = docs.columns
    kept = []
    for _, stage in p.STAGES:
        kept.append(docs)
        docs = common.stored(stage(spark, docs, SF))
        assert docs.columns == columns or stage is p.packed
    kept.append(docs)
    rows = [{r.doc_id: r for r in k.collect()} for k in kept]
    texts = [{i: r.text for i, r in x.items()} for x in rows[:5]]
    assert all(set(b) <= set(a) for a, b in zip(rows, rows[1:], strict=False))

    network = quality.train(kept[0], read(spark, "labels").where(~quality.held_out("doc_id", 5)))
    assert set(rows[1]) == {r.doc_id for r in quality.score(kept[0], network).collect() if r.score >= 0.3}
    component = {i: c for i, _, c in test_near_duplicates.brute(list(texts[1].items()), 5, 80)}
    assert set(rows[2]) == {i for i, c in component.items() if c == i}
    assert texts[3] == first_stays(texts[2].items())
    assert all(r.n_chars == len(r.text) for r in rows[3].values())
    assert sum("shared30" in t for t in texts[2].values()) > 1 >= sum("shared30 shared31" in t for t in texts[3].values())
    items = [(str(r.item_id), r.text.encode()) for r in read(spark, "benchmark").collect()]
    automaton = decontaminate.SuffixAutomaton([(n, decontaminate.words(t)) for n, t in items], 13)
    clean = set()
    for i, t in texts[3].items():
        ws = decontaminate.words(t.encode())
        spans, _ = automaton.spans(ws)
        if not spans or 20 * sum(b - a for a, b in spans) < len(ws):
            clean.add(i)
        elif i in (6000,):
            hit, _ = test_decontaminate.brute(t.encode(), items, 13)
            assert hit == {k for a, b in spans for k in range(a, b)}
    assert set(rows[4]) == clean and 6000 not in clean
    assert {i: r.n_tokens for i, r in rows[5].items()} == {i: len(t.encode().split()) + 1 for i, t in texts[4].items()}
    assert packing.histogram(kept[5])[-1][0] == max(r.n_tokens for r in rows[5].values())


def test_run_and_awkward_rows(spark, awkward, no_docs):
    assert p.ORACLE_SQL is None and p.run(spark, SF).columns[0] == "doc_id"
    for docs in (awkward, no_docs):
        for name, stage in p.STAGES:
            out = stage(spark, docs, SF)
            assert name and (out.columns == docs.columns or stage is p.packed)
            assert out.count() <= docs.count()


@pytest.mark.parametrize("name", queries.ORACLE)
def test_queries_against_sql(spark, name):
    assert compare(spark, connect(SF), name, SF) is None
