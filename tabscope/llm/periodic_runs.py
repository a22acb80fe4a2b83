"""Periodic runs of words: stretches that repeat themselves, found with a suffix automaton and link-cut access.

The states of the suffix automaton of a text form a tree by their suffix links, in which the state of each prefix has its
suffixes on the path to the root. Words are appended one by one: the path of the new prefix is accessed in a link-cut tree,
whose preferred paths each hold the states that last occurred at one end. Where the path meets such a segment, the distance
of the two ends, if it is not larger than the longest word sequence of the segment's part on the path, is the period of a
square that ends here, and always a smallest period. The path is then recoloured with the new end. A square extended to both
sides is a run; each run is extended once.

A run repeats sequences of a known least number of words (16 for 24 words and three periods), so texts are cut first into
the stretches that such repeated sequences cover, and only these are read by an automaton. No run reaches beyond its stretch.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscope.llm.common import slices, table, texts

#: Words of a run at least, and periods.
LEAST, TIMES = 24, 3
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

#: From an id and a number of words, the numbers of the words to read in their place, or None for the text as it is.
Change = Callable[[object, int], "np.ndarray | None"]


def suffix_automaton(codes: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix link and length of each state, 0 being the root, and the state of each prefix."""
    after: list[dict[int, int]] = [{}]
    link, length, prefixes = [0], [0], []
    last = 0
    for code in codes:
        new = len(link)
        after.append({})
        link.append(0)
        length.append(length[last] + 1)
        prefixes.append(new)
        p, at_root = last, False
        while not at_root and code not in after[p]:
            after[p][code] = new
            at_root = p == 0
            p = link[p]
        if not at_root:
            q = after[p][code]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(link)
                after.append(dict(after[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                link[q] = link[new] = copy
                while after[p].get(code) == q:
                    after[p][code] = copy
                    if p == 0:
                        break
                    p = link[p]
        last = new
    return link, length, prefixes


def squares(codes: list[int]) -> Iterator[tuple[int, int]]:
    """Last word and period of squares: of every run of at least two periods, each place from the second period's end on."""
    up, length, prefixes = suffix_automaton(codes)
    n = len(up)
    left, right, colour = [0] * n, [0] * n, [0] * n  # splay trees of preferred paths, deeper states to the right

    def rotate(x: int) -> None:
        p = up[x]
        g = up[p]
        if left[p] == x:
            b = left[p] = right[x]
            right[x] = p
        else:
            b = right[p] = left[x]
            left[x] = p
        if b:
            up[b] = p
        if g:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x
        up[x], up[p] = g, x

    def splay(x: int) -> None:
        """Makes x the root of its tree, which alone knows the colour."""
        top = x
        while (p := up[top]) and (left[p] == top or right[p] == top):
            top = p
        colour[x] = colour[top]
        while (p := up[x]) and (left[p] == x or right[p] == x):
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                rotate(p if (left[g] == p) == (left[p] == x) else x)
            rotate(x)

    for end, x in enumerate(prefixes):
        below = 0
        while x:
            splay(x)
            seen = colour[x]
            if seen and end + 1 - seen <= length[x]:
                yield end, end + 1 - seen
            if right[x]:
                colour[right[x]] = seen
            right[x] = below
            below, x = x, up[x]
        colour[below] = end + 1


def runs(codes: list[int], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """Start, length and smallest period of each run of at least ``least`` words and ``times`` periods, in this order."""
    until: dict[int, int] = {}
    found = []
    for end, period in squares(codes):
        if until.get(period, 0) > end:
            continue
        start, stop = end + 1 - 2 * period, end + 1
        while start and codes[start - 1] == codes[start - 1 + period]:
            start -= 1
        while stop < len(codes) and codes[stop] == codes[stop - period]:
            stop += 1
        until[period] = stop
        if stop - start >= max(least, times * period):
            found.append((start, stop - start, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def shared_width(least: int = LEAST, times: int = TIMES) -> int:
    """How many words the sequences have that any run repeats one period later."""
    return min(max(least, times * q) - q for q in range(1, least + 1))


def stretches(codes: np.ndarray, ends: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Where sequences of ``width`` words cover a text that it holds twice: texts lie in ``codes`` and end at ``ends``."""
    if len(codes) < width:
        return []
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    inside = np.flatnonzero(text[: len(codes) - width + 1] == text[width - 1 :])
    key = np.zeros(len(codes) - width + 1, np.uint64)
    for k in range(width):
        key = (key + codes[k : len(codes) - width + 1 + k]) * _K1
        key ^= key >> np.uint64(29)
    key = (key + text[: len(key)].astype(np.uint64))[inside] * _K2
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    starts = inside[twice]
    if not len(starts):
        return []
    edges = np.zeros(len(codes) + 1, np.int64)
    edges[starts] += 1
    edges[starts + width] -= 1
    covered = np.cumsum(edges[:-1]) > 0
    first = covered & ~np.concatenate([[False], covered[:-1] & (text[1:] == text[:-1])])
    last = covered & ~np.concatenate([covered[1:] & (text[1:] == text[:-1]), [False]])
    return list(zip(np.flatnonzero(first).tolist(), (np.flatnonzero(last) + 1).tolist(), strict=True))


def _found(least: int, times: int, change: Change | None):
    width = shared_width(least, times)
    spans = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    schema = ["__id", "n_words", "runs", "collapsed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "__text", 4 << 20):
            numbers: dict[bytes, int] = {}
            words, codes = [], []
            for name, text in zip(b.column("__id").to_pylist(), b.column("__text").to_pylist(), strict=True):
                own = text.split()
                order = change(name, len(own)) if change and own else None
                if order is not None:
                    own = [own[k] for k in order.tolist()]
                words.append(own)
                codes.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in own), np.uint64, len(own)))
            ends = np.cumsum([len(w) for w in words])
            joined = np.concatenate(codes)
            found: list[list[tuple[int, int, int]]] = [[] for _ in words]
            for start, stop in stretches(joined, ends, width):
                at = int(np.searchsorted(ends, start, side="right"))
                before = start - int(ends[at] - len(words[at]))
                found[at] += [(before + s, n, q) for s, n, q in runs(joined[start:stop].tolist(), least, times)]
            kept = []
            for own, rs in zip(words, found, strict=True):
                if rs:
                    drop = np.zeros(len(own), bool)
                    for s, n, q in rs:
                        drop[s + q : s + n] = True
                    own = [w for w, d in zip(own, drop.tolist(), strict=True) if not d]
                kept.append(b" ".join(own))
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in found])]).astype(np.int32)
            flat = np.array([r for rs in found for r in rs], np.int64).reshape(-1, 3)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(spans)))
            yield pa.RecordBatch.from_arrays([b.column("__id"), pa.array([len(w) for w in words], pa.int64()), lists, pa.array(kept, pa.binary())], names=schema)

    return run


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES, change: Change | None = None
) -> DataFrame:
    """Per row of ``docs``: id, ``n_words``, ``runs`` and ``collapsed``, the words left joined by one space.

    Words are runs of other bytes than white space. A run is a stretch of words, as long as can be, that are the same a period
    apart; ``runs`` holds ``start, length, period`` of those with at least ``least`` words and ``times`` (2 or more) smallest
    periods, by start and then period. Of a run its first period is left, of a word in several runs what they all leave.

    Null and empty texts have no words, no runs and an empty ``collapsed``. Each row stands for itself, whatever its id and
    whatever other rows hold; an empty table gives an empty result. A text is read by one task, which holds it whole.
    ``change`` may rearrange the words of a text before.
    """
    if least < 2 or times < 2:
        raise ValueError("a run has two words and two periods at least")
    kind = docs.schema[id_col].dataType.simpleString()
    rows = texts(docs, id_col, text_col).select(F.col(id_col).alias("__id"), "__text")
    found = rows.mapInArrow(_found(least, times, change), f"__id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary")
    return found.select(F.col("__id").alias(id_col), "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))


def planted_period(name: object, n: int) -> np.ndarray | None:
    """The rule of the query: the end of every tenth text, by a checksum of its id, repeats itself; not without an id."""
    if name is None:
        return None
    g, rest = divmod(zlib.crc32(str(name).encode()), 10)
    if rest or not n:
        return None
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    order = np.arange(n)
    order[a:] = a + (order[a:] - a) % period
    return order


def _order(a: Column, b: Column) -> Column:
    """Larger exponents first, compared exactly, then smaller starts and periods."""
    x, y = a["length"] * b["period"], b["length"] * a["period"]
    return F.when(x != y, F.when(x > y, -1).otherwise(1)).when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1)).otherwise(F.signum(a["period"] - b["period"]).cast("int"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(table(spark, sf_dir, "documents"), change=planted_period)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    best = found.withColumn("best", F.get(F.array_sort("runs", _order), F.lit(0)))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
