import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from llm_helpers import SF, awkward, no_docs, read  # noqa: F401

from tabscope.llm import simhash as m
from tabscope.llm.components import spanning


def print_of(text, size=4):
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(ws[k : k + size]), 42) for k in range(max(1, len(ws) - size + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(prints, most=4):
    """Number of each one's component, by trying all pairs."""
    fp = np.array(prints, np.uint64)
    near = np.bitwise_count(fp[:, None] ^ fp[None]) <= most
    label = np.arange(len(fp))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return label.tolist()
        label = new


def test_fingerprints():
    r = random.Random(0)
    found = ["", " \t", "One", "one two", "a b c d", "a b c d E", "ünï Ü cödé 日本 x"]
    found += [" \n".join(r.choice(["a", "B", "cc", "Dd", "é"]) for _ in range(n)) for n in (5, 254, 255, 256, 258, 259, 600, 1500)]
    assert m.fingerprints([t.encode() for t in found]).tolist() == [print_of(t) for t in found]
    assert m.fingerprints([b"", b" "]).tolist() == [0, 0] and m.fingerprints([]).tolist() == []
    assert m.fingerprints([b"a b c a b"], 2).tolist() == [print_of("a b c a b", 2)]


def test_any_four_positions_hold_a_triple():
    chosen = [set(t) for t in m.triples()]
    assert len(chosen) == 20 and all(any(t <= set(four) for t in chosen) for four in combinations(range(8), 4))


def test_spanning():
    r = np.random.default_rng(4)
    near = r.random((60, 60)) < 0.02
    near |= near.T
    pairs = spanning(near)
    label = list(range(60))
    for a, b in np.argwhere(near).tolist():
        label = [label[a] if x == label[b] else x for x in label]
    star = list(range(60))
    for a, b in pairs.tolist():
        star[b] = a
    assert all((label[a] == label[b]) == (star[a] == star[b]) for a in range(60) for b in range(60))
    assert spanning(np.zeros((0, 0), bool)).shape == (0, 2)


@pytest.mark.parametrize("block,seed", [(1024, 0), (8, 1), (3, 2)])
def test_components_against_brute_force(spark, monkeypatch, block, seed):
    monkeypatch.setattr(m, "BLOCK", block)
    r = random.Random(seed)
    prints = [0, 1, (1 << 64) - 1]
    for _ in range(4):  # chains and dense groups, and neighbours a little too far away
        own = [r.getrandbits(64)]
        for _ in range(60):
            own.append(r.choice(own) ^ sum(1 << b for b in r.sample(range(64), r.choice([1, 2, 3, 4, 5, 6]))))
        prints += own
    shared = r.getrandbits(64)
    prints += [shared & ~0xFFFFFFFFFF | r.getrandbits(40) for _ in range(150)]  # a posting list of many that are far apart
    prints = sorted(set(prints))
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    found = {x.fp: x.root for x in m.fingerprint_components(spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3)).collect()}
    got = [found.get(x, x) for x in signed]
    want = brute(prints)
    assert len(set(got)) == len(set(want)) and len(set(zip(got, want, strict=True))) == len(set(want))


def test_no_pair_rows_in_a_large_group(spark):
    r = random.Random(7)
    base = r.getrandbits(64)
    rows = {base ^ sum(1 << b for b in r.sample(range(64), 2)) for _ in range(1200)}
    signed = np.array(sorted(rows), np.uint64).view(np.int64)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(np.zeros(len(signed), np.int64)), pa.array(np.zeros(len(signed), np.int32)), pa.array(signed)], names=["key", "block", "fp"])
    assert sum(b.num_rows for b in m._linked(4)(iter([batch]))) == len(signed) - 1


def test_query(spark):
    rows = read(spark, "documents").collect()
    prints = [print_of(x.text) for x in rows]
    label = brute(prints)
    least = {}
    for x, c in zip(rows, label, strict=True):
        least[c] = min(x.doc_id, least.get(c, x.doc_id))
    want = sorted((x.doc_id, f"{p:016x}", least[c]) for x, p, c in zip(rows, prints, label, strict=True))
    assert sorted(tuple(x) for x in m.op12_simhash(spark, SF).collect()) == want


def test_awkward_rows(spark, awkward, no_docs):
    out = m.similar_documents(awkward)
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    got = out.collect()
    assert len(got) == awkward.count()
    assert all(x.component_id == 3 for x in got if x.fingerprint == "0" * 16) and {x.doc_id for x in got if x.fingerprint == "0" * 16} == {3, 4, 5, None}
    assert {x.component_id for x in got if x.doc_id in (1, 2)} == {1}
    assert m.similar_documents(no_docs).collect() == []
    with pytest.raises(ValueError):
        m.similar_documents(awkward, most=5)
