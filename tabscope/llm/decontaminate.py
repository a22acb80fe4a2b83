"""Removal of benchmark passages from documents, with a generalised suffix automaton over the words of the items.

The automaton of all items reads the words of a document and keeps, at each word, the longest passage that ends there and
occurs in some item. Where it is as long as a window, the window's words are hit. Items are cut into blocks of bounded size,
each with an automaton of its own that is broadcast; documents pass the blocks one after the other, without a shuffle.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscope.llm.common import slices, stored, table

#: Lower-cases A-Z and turns what is neither a digit, a letter nor beyond ASCII into a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text: runs of digits, ASCII letters (A-Z made lower case) and whatever is beyond ASCII."""
    return text.translate(_FOLD).split()


class SuffixAutomaton:
    """All passages of all items. A window is ``window`` words of an item, or the whole of a shorter one."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window, self.vocabulary = window, {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.items: list[set[str]] = []
        self.short: dict[int, list[tuple[int, str | None]]] = {}
        items = [(name, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws]) for name, ws in items if ws]
        for _, ids in items:
            self._insert(ids)
        self.items = [set() for _ in self.next]
        for name, ids in items:
            state = 0
            for w in ids:
                state = self.next[state][w]
                up = state
                while up and name is not None and name not in self.items[up]:
                    self.items[up].add(name)
                    up = self.link[up]
            if len(ids) < window:
                self.short.setdefault(state, []).append((len(ids), name))
        self.least = min((len(ids) for _, ids in items), default=window)
        self.least = min(self.least, window)
        pairs = {a * len(self.vocabulary) + b for _, ids in items for a, b in zip(ids, ids[1:], strict=False)}
        self.pairs = np.array(sorted(pairs), np.int64)

    def _insert(self, ids: list[int]) -> None:
        last = 0
        for w in ids:
            if w in self.next[last]:
                q = self.next[last][w]
                last = q if self.length[q] == self.length[last] + 1 else self._clone(last, w, q)
                continue
            new = self._state({}, self.length[last] + 1, 0)
            p = last
            while p >= 0 and w not in self.next[p]:
                self.next[p][w] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][w]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, w, q)
            last = new

    def _state(self, after: dict[int, int], length: int, link: int) -> int:
        self.next.append(after)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _clone(self, p: int, w: int, q: int) -> int:
        copy = self._state(dict(self.next[q]), self.length[p] + 1, self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def spans(self, text: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of hit words of a document, disjoint and in order, and the items whose windows occur."""
        found: list[tuple[int, int]] = []
        items: set[str] = set()
        if len(text) < self.least or not self.vocabulary:
            return found, items
        ids = np.fromiter(map(self.vocabulary.get, text, repeat(-1)), np.int64, len(text))
        for start, stop in self._runs(ids):
            state = length = 0
            for at, w in enumerate(ids[start:stop].tolist(), start):
                while state and w not in self.next[state]:
                    state = self.link[state]
                    length = self.length[state]
                if w in self.next[state]:
                    state = self.next[state][w]
                    length += 1
                reach = 0
                if length >= self.window:
                    reach, up = self.window, state
                    while self.length[self.link[up]] >= self.window:
                        up = self.link[up]
                    items |= self.items[up]
                if self.short:
                    up = state
                    while up > 0:
                        for n, name in self.short.get(up, ()):
                            if n <= length:
                                reach = max(reach, n)
                                if name is not None:
                                    items.add(name)
                        up = self.link[up]
                if reach:
                    begin = at + 1 - reach
                    while found and found[-1][1] >= begin:
                        begin = min(begin, found.pop()[0])
                    found.append((begin, at + 1))
        return found, items

    def _runs(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Stretches of words that may hold a window: each two neighbours in them are neighbours in some item."""
        if self.least == 1:
            return [(0, len(ids))]
        codes = np.where((ids[:-1] >= 0) & (ids[1:] >= 0), ids[:-1] * len(self.vocabulary) + ids[1:], -1)
        joined = self.pairs[np.minimum(np.searchsorted(self.pairs, codes), len(self.pairs) - 1)] == codes
        edges = np.flatnonzero(np.diff(np.concatenate([[0], joined.view(np.int8), [0]])))
        return [(a, b + 1) for a, b in edges.reshape(-1, 2).tolist() if b + 1 - a >= self.least]


_built: dict[str, SuffixAutomaton] = {}


def _automaton(key: str, shared, window: int) -> SuffixAutomaton:
    """The automaton of a broadcast block of items; a worker keeps the last one."""
    if key not in _built:
        _built.clear()
        _built[key] = SuffixAutomaton([(name, words(text)) for name, text in shared.value], window)
    return _built[key]


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[tuple[list[tuple[str | None, bytes]], bool]]:
    """Different items with text, in blocks of about ``block_bytes``, and whether a block is the last; the driver holds one at a time.

    Repeated rows count once, whatever their number. Where no item has words, one empty block comes.
    """
    rows = items.where(F.length(text_col) > 0).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("binary").alias("text")).distinct()
    total = rows.agg(F.sum(F.length("text") + 16)).first()[0] or 0
    n = -(-total // block_bytes)
    if n > 1:
        rows = stored(rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(n))).repartition("block"))
    for k in range(max(n, 1)):
        block = rows.where(F.col("block") == k) if n > 1 else rows
        yield [(r.id, bytes(r.text)) for r in block.collect()], k + 1 >= n


def find_passages(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 13, keep: list[str] | None = None, block_bytes: int = 1 << 20) -> DataFrame:
    """Per row the columns of ``keep`` (the id alone by default), ``n_words``, ``spans`` (hit words, as [first, behind the last)) and ``items`` (ids as sorted strings).

    Null or empty texts have no words, spans or items; null or empty items match nothing; an item without an id hits, but
    is not listed; items of equal id are one. Repeated rows are judged apart; an empty table gives an empty result.
    """
    keep = [id_col] if keep is None else keep
    return _passages(docs, items, text_col, item_id, item_text, window, keep, block_bytes).toDF(*keep, "n_words", "spans", "items")


def _passages(docs: DataFrame, items: DataFrame, text_col: str, item_id: str, item_text: str, window: int, keep: list[str], block_bytes: int = 1 << 20, finish=None) -> DataFrame:
    """The columns of ``keep`` as __k0, __k1 …, and what is found; with ``finish``, what it makes of the text instead.

    ``finish`` turns a text, its number of words and its spans into a text, or nothing where the row goes. It runs with the last
    block, so that a row passes to Python and back once, with its text once.
    """
    kinds = ", ".join(f"__k{i} {docs.schema[k].dataType.simpleString()}" for i, k in enumerate(keep))
    rows = docs.select(
        *[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keep)],
        F.col(text_col).cast("binary").alias("__text"),
        F.lit(0).cast("long").alias("n_words"),
        F.lit(None).cast("array<array<bigint>>").alias("spans"),
        F.lit(None).cast("array<string>").alias("items"),
    )
    found = ["n_words", "spans", "items"]
    for block, last in item_blocks(items, item_id, item_text, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        left = {"__text"} if last and finish is None else set(found) if last else set()
        names = [n for n in rows.columns if n not in left]
        more = [x for x in ("__text binary", "n_words long", "spans array<array<bigint>>", "items array<string>") if x.split()[0] not in left]
        rows = rows.mapInArrow(_finder(shared, window, names, finish if last else None), ", ".join(x for x in (kinds, *more) if x))
    return rows


def _finder(shared, window: int, names: list[str], finish=None):
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(key, shared, window)
        for b in slices(batches, "__text", 4 << 20):
            n_words, spans, items, texts, stays = [], [], [], [], []
            for text, s, i in zip(*(b.column(c).to_pylist() for c in ("__text", "spans", "items")), strict=True):
                found = words(text or b"")
                more, names_of = automaton.spans(found)
                hits = merged([tuple(x) for x in s or ()] + more)
                if finish is not None:
                    out = finish(text, len(found), hits) if hits else text
                    stays.append(text is None or out is not None)
                    texts.append(out)
                    continue
                n_words.append(len(found))
                spans.append(hits)
                items.append(sorted(names_of.union(i or ())))
            columns = {n: b.column(n) for n in b.schema.names}
            if finish is not None:
                columns["__text"] = pa.array(texts, pa.binary())
            else:
                columns |= {"n_words": pa.array(n_words, pa.int64()), "spans": pa.array(spans, pa.list_(pa.list_(pa.int64()))), "items": pa.array(items, pa.list_(pa.string()))}
            done = pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)
            yield done if all(stays) else done.filter(pa.array(stays, pa.bool_()))

    return run


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint spans in order that cover the same words."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def n_hit() -> Column:
    """Hit words, from ``spans``."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])


def contaminated(share: int = 20) -> Column:
    """Whether a document has hits that make up at least one in ``share`` of its words."""
    return (n_hit() > 0) & (n_hit() * share >= F.col("n_words"))


def remove_passages(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 13, least_words: int = 13, share: int = 20, drop: bool = False) -> DataFrame:
    """``docs`` without what the limits exclude: all columns, cleaned texts.

    A hit span of at least ``least_words`` words goes from every document, from its first byte to its last. A document whose hits
    reach one in ``share`` of its words is dropped with ``drop``; without, it loses its shorter hit spans too. Texts without such
    spans stay as they are, nulls and empty ones among them; repeated rows are treated alike; an empty table gives an empty
    result, and a table without items changes nothing.
    """
    def cleaned(text: bytes, n: int, spans: list[tuple[int, int]]) -> bytes | None:
        hit = share * sum(b - a for a, b in spans) >= n
        excluded = [(a, b) for a, b in spans if hit or b - a >= least_words]
        if hit and drop or not excluded:
            return None if hit and drop else text
        at = [m.span() for m in _WORD.finditer(text.translate(_FOLD))]
        kept, start = [], 0
        for a, b in excluded:
            kept.append(text[start : at[a][0]])
            start = at[b - 1][1]
        return b"".join([*kept, text[start:]])

    others = [c for c in docs.columns if c != text_col]
    left = _passages(docs, items, text_col, item_id, item_text, window, others, finish=cleaned)
    own = {c: f"__k{i}" for i, c in enumerate(others)} | {text_col: "__text"}
    return left.select(*[F.col(own[c]).cast(docs.schema[c].dataType).alias(c) if c == text_col else F.col(own[c]).alias(c) for c in docs.columns])


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"),
    )


OP4_SQL = """
WITH folded AS (
  SELECT 0 AS item, doc_id AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT 1, item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark
), cut AS (
  SELECT item, id, regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM folded
), items AS (
  SELECT DISTINCT id AS item_id, least(len(ws), 13) AS n, array_to_string(ws[k:k + least(len(ws), 13) - 1], ' ') AS w
  FROM (SELECT id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS k FROM cut WHERE item = 1 AND len(ws) > 0)
), sizes AS (
  SELECT DISTINCT n FROM items
), windows AS (
  SELECT id AS doc_id, k, n, array_to_string(ws[k:k + n - 1], ' ') AS w
  FROM (SELECT id, ws, n, unnest(range(1, len(ws) - n + 2)) AS k FROM cut, sizes WHERE item = 0 AND len(ws) >= n)
), hits AS (
  SELECT doc_id, k, windows.n, item_id FROM windows JOIN items USING (w) WHERE windows.n = items.n
), hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY doc_id
)
SELECT id AS doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(ws), false) AS contaminated
FROM cut LEFT JOIN hit_words ON hit_words.doc_id = id LEFT JOIN hit_items ON hit_items.doc_id = id
WHERE item = 0
"""
