"""Scores of documents under a hierarchical Pitman-Yor model of word pairs.

Every context, the word before, has a restaurant; all of them share one parent, whose dishes come from a uniform base over the
training vocabulary and one unknown word. The most frequent words are contexts of their own, all others share contexts by hash,
so the totals of all restaurants are a table of fixed size. Customers are the training tokens, each one in the restaurant of its
context; every table there sends a customer to the parent.

Seating is sampled by blocked Gibbs steps: given the rest, the number of tables of a dish is drawn from its exact conditional
(generalised Stirling numbers), restaurant by restaurant and then in the parent, for one word after the other. Words lie
in different tasks; within a step they see the totals of the step before. Predictive probabilities are averaged over samples.

Tokens are moved once: each block of documents sends, for each of its words, the contexts and documents where it stands; the
words' tasks add the probabilities up per document and send the sums back to the block. Frequent words are dealt over several
tasks. Random numbers are hashes of word, context and step, so results don't depend on the partitioning of words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscope.llm.common import batch, discard, slices, stored, table

#: Contexts: the start of a text, the most frequent words, and what the others share.
CONTEXTS, OWN = 1 << 16, 8192
START = 0
#: In place of a task of a word: the row is about a block's texts.
_HEAD = -1
#: The end of a text, as a word.
END = 0x5851F42D4C957F2D
#: Customers of a dish up to which the Stirling numbers are tabled, and up to which dishes of equal customers are drawn together.
EXACT, SMALL = 1024, 64
#: Occurrences of a word that go to one task, and blocks of documents in bytes.
SHARE, BLOCK = 500_000, 12 << 20
#: Distinct words that a task counts before it sends them on.
HELD = 2_000_000

#: A context and its customers; of a block, more of them than fit are several pairs.
_PAIR, _SHORT = np.dtype([("u", "<u2"), ("c", "<u4")]), np.dtype([("u", "<u2"), ("c", "u1")])
#: What the samples have on average: of a word its parent probability, then the tables of its pairs of several customers.
_MEAN = np.dtype("<f4")
_PLACE = np.dtype([("doc", "<u2"), ("u", "<u2")])
_SUMS = np.dtype([("doc", "<u2"), ("score", "<f4"), ("base", "<f8"), ("known", "<u4")])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(word: np.ndarray, context: np.ndarray | int, step: int) -> np.ndarray:
    """Numbers in (0, 1) that depend on nothing but word, context and step."""
    u = np.atleast_1d(np.asarray(context, np.uint64))
    x = _mix(word.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * (u + np.uint64(1)))
    x = _mix(x + np.array([step + 1], np.uint64) * np.uint64(0xD1B54A32D192ED03))
    return ((x >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)


@lru_cache(maxsize=4)
def stirling(discount: float, most: int = EXACT) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers: ways to seat c customers at t tables, weighted by the discount."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[1, 1] = 0.0
    for c in range(1, most):
        t = np.arange(1, c + 1)
        out[c + 1, 1 : c + 1] = np.logaddexp(out[c, :c], out[c, 1 : c + 1] + np.log(c - discount * t))
        out[c + 1, c + 1] = out[c, c]
    return out


def draw_tables(customers: np.ndarray, weight: np.ndarray, ways: np.ndarray, discount: float, uniform: np.ndarray) -> np.ndarray:
    """The number of tables of each dish, given the weight w of opening one, from its conditional S(c, t) w^t.

    The numbers S come from the table of ``ways`` as far as it reaches, from contour integrals beyond.
    """
    t = np.ones(len(customers))
    log_weight = np.log(weight)
    order = np.argsort(customers, kind="stable")
    edges = np.searchsorted(customers[order], np.arange(2, min(SMALL, len(ways) - 1) + 2))
    for c, (a, b) in enumerate(zip(edges, edges[1:], strict=False), 2):
        for s in range(a, b, 100_000):
            at = order[s : min(b, s + 100_000)]
            t[at] = _drawn(ways[c, 1 : c + 1] + log_weight[at, None] * np.arange(1, c + 1), uniform[at])
    # Tables beyond the largest are fewer than Poisson with mean w / d, up to a factor that falls with c.
    middle = np.flatnonzero((customers > SMALL) & (customers < len(ways)))
    most = np.minimum(customers[middle], np.ceil(_reach(weight[middle] / discount))).astype(np.int64)
    for at, n in _parts(middle, most, 1_000_000):
        t[at] = _drawn(ways[customers[at], 1 : n + 1] + log_weight[at, None] * np.arange(1, n + 1), uniform[at])
    many = np.flatnonzero((customers >= len(ways)) & (customers > SMALL))
    if len(many):
        t[many] = _draw_many(customers[many].astype(float), weight[many] / discount, discount, uniform[many])
    return t


def _drawn(p: np.ndarray, uniform: np.ndarray) -> np.ndarray:
    """One of 1, 2, … for each row of logarithms of weights."""
    p = np.cumsum(np.exp(p - p.max(1, keepdims=True)), 1)
    return 1 + (p < (uniform * p[:, -1])[:, None]).sum(1)


def _reach(mean: np.ndarray) -> np.ndarray:
    return mean + 9 * np.sqrt(mean) + 40


def _parts(at: np.ndarray, n: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, int]]:
    """Indices in order of their n, in parts of about ``most`` elements, with the largest n of each."""
    order = np.argsort(n, kind="stable")
    start = 0
    while start < len(order):
        stop = min(len(order), start + max(1, most // int(n[order[start]])))
        while stop > start + 1 and (stop - start) * int(n[order[stop - 1]]) > 2 * most:
            stop = start + (stop - start) // 2
        yield at[order[start:stop]], int(n[order[stop - 1]])
        start = stop


_NODES, _NODE_WEIGHTS = np.polynomial.legendre.leggauss(12)


def _draw_many(c: np.ndarray, mean: np.ndarray, d: float, uniform: np.ndarray) -> np.ndarray:
    """Tables of dishes with many customers; ``mean`` is the weight of opening one over the discount.

    S(c, t) w^t is, up to a factor of c, mean^t / t! times the coefficient of z^c in (1 - (1 - z)^d)^t, an integral over a contour
    around 0. All t near the mode share a contour through the saddle point z0 of their sum: where tables are few beside customers,
    a ray in s = 1 - z (and its mirror image) that leaves it at 120 degrees, with Gauss rules over intervals that grow by half;
    else the circle, with equal steps as far as the integrand reaches.
    """
    low, high = np.full(len(c), -500.0), np.full(len(c), -1e-15)
    for _ in range(70):
        y = (low + high) / 2
        above = np.log(mean * d) + (d - 1) * y + np.log(-np.expm1(y)) > np.log(c + 1)
        low, high = np.where(above, y, low), np.where(above, high, y)
    y = np.maximum((low + high) / 2, np.log(1e-30 / c))
    s0, z0 = np.exp(y), -np.expm1(y)
    mode = mean * -np.expm1(d * y)
    first = np.maximum(1, np.floor(mode - 9 * np.sqrt(mode) - 20))
    last = np.minimum(c, np.ceil(_reach(mode)))
    width = 1 / np.sqrt(mean * d * (1 - d) * s0 ** (d - 2) + c / z0**2)
    t = np.ones(len(c))

    def draw(at: np.ndarray, z: np.ndarray, power: np.ndarray, weights: np.ndarray) -> None:
        """From the nodes of a contour: z, (c + 1) log(z / z0) and the weights."""
        f, f0 = -np.expm1(d * np.log1p(-z)), -np.expm1(d * y[at])
        value = np.exp(first[at, None] * (np.log(f) - np.log(f0)[:, None]) - power) * weights
        p = np.empty((len(at), int((last[at] - first[at]).max()) + 1))
        for k in range(p.shape[1]):
            p[:, k] = value.sum(1).real
            value *= f * (mean[at] / (first[at] + k + 1))[:, None]
        p[np.arange(p.shape[1]) > (last[at] - first[at])[:, None]] = 0
        p = np.cumsum(np.maximum(p, 0), 1)
        t[at] = first[at] + (p < (uniform[at] * p[:, -1])[:, None]).sum(1)

    few = np.flatnonzero(s0 < 0.1)
    start = np.maximum(0.25 * np.minimum(s0, width), 1e-8 / c)
    panels = np.ceil(np.log(np.expm1(np.minimum(72 / (c * (1 - d)), 300)) / start) / np.log(1.5)).astype(np.int64) + 1
    turn = np.exp(2j * np.pi / 3)
    for at, n in _parts(few, panels[few], 10_000):
        edges = np.concatenate([np.zeros((len(at), 1)), start[at, None] * 1.5 ** np.arange(n)], 1)
        half = np.diff(edges, axis=1)[:, :, None] / 2
        x = (edges[:, :-1, None] + half * (_NODES + 1)).reshape(len(at), -1)
        away = -x * turn / z0[at, None]
        draw(at, z0[at, None] * (1 + away), (c[at, None] + 1) * np.log1p(away), -1j * turn * (half * _NODE_WEIGHTS).reshape(len(at), -1) / width[at, None])
    many = np.flatnonzero(s0 >= 0.1)
    spread = (z0 / width)[many]
    narrow = np.sqrt(np.maximum(spread**2 - c[many] ** 2 / mode[many], 1e-9))  # with t given
    whole = 2 * np.ceil(8 * spread - 20 / np.log(z0[many])) + 41
    steps = np.minimum((whole - 1) / 2, np.ceil(14 / narrow * whole / (2 * np.pi))).astype(np.int64) + 1
    for part, n in _parts(np.arange(len(many)), steps, 100_000):
        at = many[part]
        angle = 1j * np.arange(n) * (2 * np.pi / whole[part])[:, None]
        draw(at, z0[at, None] * np.exp(angle), c[at, None] * angle, np.where(np.arange(n) < steps[part, None], np.where(np.arange(n) > 0, 2.0, 1.0), 0.0))
    return t


# --- texts to words and contexts ------------------------------------------------------------------------------------


#: Bytes of words that are hashed together, and the longest word that is hashed by its places.
_CHUNK, _LONGEST = 1 << 20, 4096
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: A random number of each byte, the same for A-Z and a-z and none for white space, and an odd one of each place in a word.
_OF_BYTE = np.where(_SPACE, np.uint64(0), _mix(np.arange(256, dtype=np.uint64) + np.where(np.isin(np.arange(256), np.arange(65, 91)), 32, 0).astype(np.uint64) + np.uint64(END)))
_OF_PLACE = _mix(np.arange(_LONGEST + 1, dtype=np.uint64) + np.uint64(1)) | np.uint64(1)


def _word_hashes(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hashes of the words that begin at ``starts`` and end at white space: sums over bytes of a byte's number times its place's."""
    out, edges = np.empty(len(starts), np.uint64), np.append(starts, len(raw))
    w = 0
    while w < len(starts):
        stop = max(w + 1, int(np.searchsorted(edges, edges[w] + _CHUNK, side="right")) - 1)
        if stop == w + 1 and edges[stop] - edges[w] > _LONGEST:
            word = raw[edges[w] : edges[stop]].tobytes().rstrip().lower()
            if len(word) > _LONGEST:
                out[w] = xxhash.xxh3_64_intdigest(word)
                w = stop
                continue
            part, at, gaps = np.frombuffer(word, np.uint8), np.zeros(1, np.int64), np.array([len(word)])
        else:
            part, at, gaps = raw[edges[w] : edges[stop]], edges[w:stop] - edges[w], np.diff(edges[w : stop + 1])
        place = np.minimum(np.arange(len(part)) - np.repeat(at, gaps), _LONGEST)
        out[w:stop] = np.add.reduceat(_OF_BYTE[part] * _OF_PLACE[place], at)
        for k in np.flatnonzero(gaps > _LONGEST) if stop > w + 1 else ():
            word = raw[edges[w + k] : edges[w + k + 1]].tobytes().rstrip().lower()
            if len(word) > _LONGEST:
                out[w + k] = xxhash.xxh3_64_intdigest(word)
        w = stop
    return out


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, an end behind each text, and the number of tokens of each text."""
    raw = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    space = _SPACE[raw]
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]])) if len(raw) else np.zeros(0, np.int64)
    ends = np.searchsorted(starts, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1))
    return np.insert(_word_hashes(raw, starts), ends, np.uint64(END)), np.diff(ends, prepend=0) + 1


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values in order, and the place of each value among them; only the different ones are sorted."""
    code, found = pd.factorize(values)
    order = np.argsort(found)
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    return found[order], place[code]


def _stable_order(numbers: np.ndarray) -> np.ndarray:
    """What sorts fewer than 2^31 numbers below 2^31, equal ones by place: with the place packed below each number."""
    packed = (numbers.astype(np.int64) << 32) | np.arange(len(numbers))
    packed.sort()
    return packed & 0xFFFFFFFF


def contexts_of(words: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The context that each word is: 1 … for the words of ``own`` (sorted), shared ones for others."""
    out = (OWN + (words >> np.uint64(20)) % np.uint64(CONTEXTS - OWN)).astype(np.int64)
    if len(own):
        at = np.minimum(np.searchsorted(own, words), len(own) - 1)
        out = np.where(own[at] == words, at + 1, out)
    return out


class _Block:
    """A block of texts: its distinct words, and word, context and text of every token."""

    def __init__(self, texts: list[bytes], own: np.ndarray):
        tokens, self.counts = _tokens(texts)
        self.words, self.word = _distinct(tokens)
        before = np.concatenate([[START], contexts_of(self.words, own)[self.word[:-1]]]).astype(np.int32)
        before[np.cumsum(self.counts) - self.counts] = START
        self.context = before
        self.text = np.repeat(np.arange(len(texts), dtype=np.int32), self.counts)


def _blobs(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Consecutive parts of an array as binary values."""
    ends = np.concatenate([[0], np.cumsum(sizes)]) * data.itemsize
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])


def _joined(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Binary values as one array, and the number of elements of each."""
    sizes = pc.binary_length(column).to_numpy().astype(np.int64) // kind.itemsize
    return np.frombuffer(b"".join(column.to_pylist()), kind), sizes


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All words of a task with their counts, added up as far as they fit."""
    schema, words, counts = pa.schema([("word", pa.int64()), ("n", pa.int64())]), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for b in slices(batches, "__text"):
        word, n = np.unique(_tokens(b.column("__text").to_pylist())[0], return_counts=True)
        words, at = _distinct(np.concatenate([words, word]))
        counts = np.bincount(at, np.concatenate([counts, n])).astype(np.int64)
        if len(words) > HELD:
            yield batch(schema, words.view(np.int64), counts)
            words, counts = words[:0], counts[:0]
    yield batch(schema, words.view(np.int64), counts)


def _customers(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per block and word of training texts: its contexts with their counts."""
        own, shares = shared.value
        schema = pa.schema([("word", pa.int64()), ("salt", pa.int32()), ("data", pa.binary())])
        for k, b in enumerate(slices(batches, "__text", BLOCK)):
            block = _Block(b.column("__text").to_pylist(), own)
            name = (b.column("__part")[0].as_py() << 24) | k
            pair, n = np.unique(block.word.astype(np.int64) * CONTEXTS + block.context, return_counts=True)
            times = -(-n // 255)
            data = np.empty(int(times.sum()), _SHORT)
            data["u"], data["c"] = np.repeat(pair % CONTEXTS, times), 255
            last = np.cumsum(times) - 1
            data["c"][last] = n - 255 * (times - 1)
            word, sizes = np.unique(np.repeat(pair // CONTEXTS, times), return_counts=True)
            words = block.words[word].view(np.int64)
            yield batch(schema, words, _salts(words, shares, name), _blobs(data, sizes))

    return run


def _salts(words: np.ndarray, shares: tuple[np.ndarray, np.ndarray], k: int) -> np.ndarray:
    """Which of a word's tasks a block goes to: words with many occurrences have several."""
    hot, n = shares
    out = np.zeros(len(words), np.int32)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, words), len(hot) - 1)
        mine = _mix(np.array([k], np.uint64) + words.view(np.uint64))
        out = np.where(hot[at] == words, mine % n[at].astype(np.uint64), 0).astype(np.int32)
    return out


def _merged(kind: np.dtype):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by word: one row for each, its contexts in order with their counts."""
        schema = pa.schema([("word", pa.int64()), ("data", pa.binary())])
        for words, data, sizes in _runs(batches, kind):
            code = np.repeat(np.cumsum(np.concatenate([[0], words[1:] != words[:-1]])), sizes) * CONTEXTS + data["u"]
            order = np.argsort(code, kind="stable")
            code = code[order]
            first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            pairs = np.empty(len(first), _PAIR)
            pairs["u"], pairs["c"] = code[first] % CONTEXTS, np.add.reduceat(data["c"][order].astype(np.int64), first)
            yield batch(schema, words[np.concatenate([[True], words[1:] != words[:-1]])], _blobs(pairs, np.unique(code[first] // CONTEXTS, return_counts=True)[1]))

    return run


def _runs(batches: Iterator[pa.RecordBatch], kind: np.dtype, most: int = 1_000_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of whole words, about ``most`` elements together: words, their data as one array, elements of each row."""
    held, n = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        n += b.column("data").nbytes // kind.itemsize
        if n < most:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        words = t.column("word").to_numpy()
        cut = int(np.searchsorted(words, words[-1]))  # the last word may go on
        if cut:
            yield words[:cut], *_joined(t.column("data").slice(0, cut).combine_chunks(), kind)
        held, n = t.slice(cut).to_batches(), 0
    if held:
        t = pa.Table.from_batches(held).combine_chunks()
        yield t.column("word").to_numpy(), *_joined(t.column("data").combine_chunks(), kind)


# --- the model ------------------------------------------------------------------------------------------------------


class Totals:
    """What all tasks know: customers and tables of each restaurant and of the parent, discounts, sizes."""

    def __init__(self, customers: np.ndarray, tables: np.ndarray, tokens: int, words: int, discount: float, parent: tuple[float, float, float], strength: float = 1.0):
        self.customers, self.tables, self.tokens, self.words = customers, tables, tokens, words
        self.discount, self.strength = discount, strength
        self.parent_customers, self.parent_tables, self.parent_discount = parent
        self.base = 1.0 / (words + 1)
        # Of the samples that are averaged: tables of each restaurant and what the parent's probabilities sum to.
        self.sampled_tables, self.sampled_mass = tables, 1.0

    @property
    def parent_weight(self) -> float:
        return (self.strength + self.parent_discount * self.parent_tables) * self.base

    def unknown(self) -> float:
        """The parent's probability of a word that training doesn't hold."""
        return self.parent_weight / (self.strength + self.parent_customers)

    def gibbs(self, words: np.ndarray, data: np.ndarray, sizes: np.ndarray, steps: int, burn_in: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of samples after ``burn_in`` steps, the means of: tables of each pair, parent probability, customers and tables of each word."""
        word = np.repeat(np.arange(len(words)), sizes)
        first = np.cumsum(sizes) - sizes
        c, u = data["c"].astype(np.int64), data["u"].astype(np.int64)
        t = np.ones(len(c))
        sums = np.zeros(len(c)), np.zeros(len(words)), np.zeros(len(words)), np.zeros(len(words))
        open_ = self.strength + self.discount * self.tables[u]
        several = np.flatnonzero(c > 1)
        for step in range(steps):
            sent = np.add.reduceat(t, first)  # customers in the parent
            own = draw_tables(sent.astype(np.int64), np.full(len(words), self.parent_weight), stirling(self.parent_discount), self.parent_discount, _uniform(words, CONTEXTS, seed + 2 * step))
            p = (sent - self.parent_discount * own + self.parent_weight) / (self.strength + self.parent_customers)
            if step >= burn_in:
                for total, value in zip(sums, (t, p, sent, own), strict=True):
                    total += value / (steps - burn_in)
            if step + 1 < steps:
                t[several] = draw_tables(c[several], open_[several] * p[word[several]], stirling(self.discount), self.discount, _uniform(words[word[several]], u[several], seed + 2 * step + 1))
        return sums


def _discount(one: float, two: float) -> float:
    """From the numbers of dishes with one and with two customers."""
    return min(0.95, max(0.1, one / (one + 2 * two))) if one else 0.5


_TOTAL = pa.schema([("u", pa.int32()), ("c", pa.float64()), ("t", pa.float64())])


def _start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: customers and dishes of each context, then below 0 what the parent and the discounts are made from."""
    c, t, extra = np.zeros(CONTEXTS), np.zeros(CONTEXTS), np.zeros(7)
    for b in batches:
        if not b.num_rows:
            continue
        data, sizes = _joined(b.column("data"), _PAIR)
        np.add.at(c, data["u"], data["c"])
        np.add.at(t, data["u"], 1)
        extra += [data["c"].sum(), len(sizes), (data["c"] == 1).sum(), (data["c"] == 2).sum(), sizes.sum(), (sizes == 1).sum(), (sizes == 2).sum()]
    u = np.flatnonzero(c)
    yield batch(_TOTAL, np.concatenate([u, -1 - np.arange(7)]).astype(np.int32), np.concatenate([c[u], extra]), np.concatenate([t[u], np.zeros(7)]))


def _step(shared, steps: int, burn_in: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per task: mean tables of each context; customers, tables and probabilities of the parent."""
        totals, t, parent = shared.value, np.zeros(CONTEXTS), np.zeros(3)
        for b in batches:
            if not b.num_rows:
                continue
            data, sizes = _joined(b.column("data"), _PAIR)
            tables, p, sent, own = totals.gibbs(b.column("word").to_numpy(), data, sizes, steps, burn_in, seed)
            t += np.bincount(data["u"], tables, CONTEXTS)
            parent += [sent.sum(), own.sum(), p.sum()]
        u = np.flatnonzero(t)
        yield batch(_TOTAL, np.concatenate([u, [-1, -2, -3]]).astype(np.int32), np.concatenate([np.zeros(len(u)), parent]), np.concatenate([t[u], np.zeros(3)]))

    return run


def _sampled(shared, steps: int, burn_in: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per word its pairs, and what the samples have on average."""
        schema, totals = pa.schema([("word", pa.int64()), ("data", pa.binary()), ("means", pa.binary())]), shared.value
        for b in batches:
            if not b.num_rows:
                continue
            data, sizes = _joined(b.column("data"), _PAIR)
            tables, p, _, _ = totals.gibbs(b.column("word").to_numpy(), data, sizes, steps, burn_in, seed)
            several = data["c"] > 1
            n = 1 + np.add.reduceat(several.astype(np.int64), np.cumsum(sizes) - sizes)
            means, first = np.empty(int(n.sum()), _MEAN), np.cumsum(n) - n
            means[first], means[_behind(first, len(means))] = p, tables[several]
            yield batch(schema, b.column("word"), b.column("data"), _blobs(means, n))

    return run


def _behind(first: np.ndarray, n: int) -> np.ndarray:
    """Which of n means are tables, where each word's means begin with its parent probability."""
    tables = np.ones(n, bool)
    tables[first] = False
    return tables


def _seated(data: np.ndarray, means: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean tables of all pairs and parent probabilities of all words, whose means are n each."""
    first, tables = np.cumsum(n) - n, np.ones(len(data))
    tables[data["c"] > 1] = means[_behind(first, len(means))]
    return tables, means[first].astype(float)


def _averages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: mean tables of each context, and the sum of the parent's probabilities."""
    t, total = np.zeros(CONTEXTS), 0.0
    for b in batches:
        if not b.num_rows:
            continue
        data, _ = _joined(b.column("data"), _PAIR)
        tables, p = _seated(data, *_joined(b.column("means"), _MEAN))
        t += np.bincount(data["u"], tables, CONTEXTS)
        total += p.sum()
    u = np.flatnonzero(t)
    yield batch(_TOTAL, np.append(u, -1).astype(np.int32), np.append(np.zeros(len(u)), total), np.append(t[u], 0.0))


def _sums(model: DataFrame, step) -> tuple[np.ndarray, np.ndarray, dict[int, float]]:
    rows = model.mapInArrow(step, "u int, c double, t double").groupBy("u").agg(F.sum("c").alias("c"), F.sum("t").alias("t")).toPandas()
    c, t = np.zeros(CONTEXTS), np.zeros(CONTEXTS)
    real = rows[rows["u"] >= 0]
    c[real["u"]], t[real["u"]] = real["c"], real["t"]
    return c, t, dict(zip(rows["u"], rows["c"], strict=True))


class Model:
    """Restaurants: ``words`` (word, data, means), a row for each training word, and the totals; which words are contexts, which are dealt."""

    def __init__(self, words: DataFrame, totals: Totals, own: np.ndarray, shares: tuple[np.ndarray, np.ndarray], samples: tuple[int, int, int]):
        self.words, self.totals, self.own, self.shares, self.samples = words, totals, own, shares, samples


def train(docs: DataFrame, text_col: str = "text", steps: int = 5, burn_in: int = 2) -> Model:
    """A model from all texts of ``docs``; null texts are empty and have an end only. No texts give a model that knows no word.

    Two rounds of ``steps`` Gibbs steps: the first settles the totals, of the second the samples after ``burn_in`` count.
    """
    spark = docs.sparkSession
    rows = docs.select(F.spark_partition_id().cast("long").alias("__part"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("__text"))
    heavy = rows.select("__text").mapInArrow(_frequencies, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(OWN - 1).toPandas()
    own = np.sort(heavy["word"].to_numpy(np.int64).view(np.uint64))
    hot = heavy[heavy["n"] > SHARE].sort_values("word")
    shares = hot["word"].to_numpy(np.int64), (1 + hot["n"].to_numpy(np.int64) // SHARE)
    shared = spark.sparkContext.broadcast((own, shares))
    merged = rows.mapInArrow(_customers(shared), "word long, salt int, data binary").repartition("word", "salt").sortWithinPartitions("word").select("word", "data").mapInArrow(_merged(_SHORT), "word long, data binary")
    many = F.col("word").isin(shares[0].tolist()) if len(shares[0]) else F.lit(False)
    merged = stored(merged)
    again = merged.where(many).repartition("word").sortWithinPartitions("word").mapInArrow(_merged(_PAIR), "word long, data binary")
    words = merged
    if len(shares[0]):
        words = stored(merged.where(~many).unionByName(again))
        discard(merged)

    c, t, x = _sums(words, _start)
    tokens, n = int(x.get(-1, 0)), int(x.get(-2, 0))
    discount = _discount(x.get(-3, 0), x.get(-4, 0))
    parent = (x.get(-5, 0.0), float(n), _discount(x.get(-6, 0), x.get(-7, 0)))
    totals = Totals(c, t, tokens, n, discount, parent)
    samples = (steps, burn_in, 2000)
    if tokens:
        _, t, x = _sums(words, _step(spark.sparkContext.broadcast(totals), steps, burn_in, 1000))
        totals = Totals(c, t, tokens, n, discount, (x[-1], x[-2], parent[2]))
    sampled = stored(words.mapInArrow(_sampled(spark.sparkContext.broadcast(totals), *samples), "word long, data binary, means binary"))
    discard(words)
    if tokens:
        _, t, x = _sums(sampled, _averages)
        totals.sampled_tables, totals.sampled_mass = t, x[-1] + totals.unknown()
    return Model(sampled, totals, own, shares, samples)


def _sent(shared, id_col: str):
    schema = pa.schema([("word", pa.int64()), ("salt", pa.int32()), ("block", pa.int64()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per block: for each word the texts and contexts where it stands, and one row with what is known of its texts."""
        own, shares = shared.value
        for k, b in enumerate(_texts_of(batches)):
            name = (b.column("__part")[0].as_py() << 24) | k
            block = _Block(b.column("__text").to_pylist(), own)
            order = _stable_order(block.word)
            data = np.empty(len(order), _PLACE)
            data["doc"], data["u"] = block.text[order], block.context[order]
            words = block.words.view(np.int64)
            n = len(words)
            yield batch(schema, words, _salts(words, shares, name), np.full(n, name), _blobs(data, np.bincount(block.word, minlength=n)))
            head = pa.table({"id": b.column(id_col), "n": pa.array(block.counts)})
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, head.schema) as out:
                out.write_table(head)
            yield batch(schema, [name * 2654435761 % (1 << 62)], [_HEAD], [name], [sink.getvalue().to_pybytes()])

    return run


def _texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of texts: of bounded size, and of as many as a number of two bytes can tell apart."""
    for b in slices(batches, "__text", BLOCK):
        for at in range(0, b.num_rows, 1 << 16):
            yield b.slice(at, 1 << 16)


def _dealt(shares: tuple[np.ndarray, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Words of the model, those that several tasks need to each of them: in place of a block the number of pairs below 0, the data are pairs, then means."""
        schema = pa.schema([("word", pa.int64()), ("salt", pa.int32()), ("block", pa.int64()), ("data", pa.binary())])
        hot = dict(zip(shares[0].tolist(), shares[1].tolist(), strict=True))
        for b in batches:
            words = b.column("word").to_pylist()
            at = [k for k, w in enumerate(words) for _ in range(hot.get(w, 1))]
            salts = [s for w in words for s in range(hot.get(w, 1))]
            pairs = -(pc.binary_length(b.column("data")).to_numpy().astype(np.int64) // _PAIR.itemsize)
            both = pc.binary_join_element_wise(b.column("data"), b.column("means"), pa.scalar(b"", pa.binary()))
            t = pa.table({"word": b.column("word"), "block": pairs, "data": both}).take(pa.array(at, pa.int64())).combine_chunks()
            yield batch(schema, *(c.combine_chunks() for c in (t.column("word"), pa.chunked_array([pa.array(salts, pa.int32())]), t.column("block"), t.column("data"))))

    return run


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per block, sums of its texts over the words of a task. Rows come by word, its row of the model first."""
        schema = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("data", pa.binary())])
        totals = shared.value
        held, size = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            heads = b.column("salt").to_numpy() == _HEAD
            head = b.filter(pa.array(heads))
            if head.num_rows:
                yield batch(schema, head.column("block"), np.zeros(head.num_rows, np.int32), head.column("data"))
            held.append(b.filter(pa.array(~heads)))
            size += held[-1].column("data").nbytes
            if size >= 8 << 20:
                t = pa.Table.from_batches(held).combine_chunks()
                words = t.column("word").to_numpy()
                cut = int(np.searchsorted(words, words[-1]))
                if cut or size >= 64 << 20:  # of a word that fills it alone, only the row of the model is needed again
                    cut = cut or len(words)
                    yield from sums(t.slice(0, cut), totals, schema)
                    rest = t.slice(cut) if cut < len(words) else t.slice(0, 1).filter(pc.less(t.slice(0, 1).column("block"), 0))
                    held = rest.to_batches()
                    size = sum(x.column("data").nbytes for x in held)
        if held:
            yield from sums(pa.Table.from_batches(held).combine_chunks(), totals, schema)

    def sums(t: pa.Table, totals: Totals, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        words, blocks = (t.column(c).to_numpy() for c in ("word", "block"))
        places = np.flatnonzero(blocks >= 0)
        if not len(places):
            return
        names = np.unique(words)
        base_p = np.full(len(names), totals.unknown())
        counts = np.zeros(len(names))
        pairs, tables, customers = np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        model = np.flatnonzero(blocks < 0)
        if len(model):
            both, sizes = t.column("data").take(pa.array(model)).to_pylist(), -blocks[model]
            ends = (sizes * _PAIR.itemsize).tolist()
            data = np.frombuffer(b"".join([x[:e] for x, e in zip(both, ends, strict=True)]), _PAIR)
            means = np.frombuffer(b"".join([x[e:] for x, e in zip(both, ends, strict=True)]), _MEAN)
            at, first = np.searchsorted(names, words[model]), np.cumsum(sizes) - sizes
            tables, base_p[at] = _seated(data, means, 1 + np.add.reduceat((data["c"] > 1).astype(np.int64), first))
            counts[at] = np.add.reduceat(data["c"].astype(np.int64), first)
            pairs, customers = np.repeat(at, sizes) * CONTEXTS + data["u"], data["c"].astype(float)
        data, sizes = _joined(t.column("data").take(pa.array(places)).combine_chunks(), _PLACE)
        w = np.repeat(np.searchsorted(names, words[places]), sizes)
        u = data["u"].astype(np.int64)
        own = np.zeros(len(w))
        if len(pairs):
            code = w * CONTEXTS + u
            k = np.minimum(np.searchsorted(pairs, code), len(pairs) - 1)
            own = np.where(pairs[k] == code, customers[k] - totals.discount * tables[k], 0.0)
        p = (own + (totals.strength + totals.discount * totals.sampled_tables[u]) * base_p[w] / totals.sampled_mass) / (totals.strength + totals.customers[u])
        block, which = _distinct(blocks[places])
        code, inverse = _distinct(np.repeat(which.astype(np.int64), sizes) * (1 << 16) + data["doc"])
        out = np.empty(len(code), _SUMS)
        out["doc"] = code % (1 << 16)
        out["score"] = np.bincount(inverse, np.log10(p), len(code))
        out["base"] = np.bincount(inverse, np.log10((counts[w] + 1) / (totals.tokens + totals.words + 1)), len(code))
        out["known"] = np.bincount(inverse, counts[w] > 0, len(code))
        yield batch(schema, block, np.ones(len(block), np.int32), _blobs(out, np.bincount(code >> 16, minlength=len(block))))

    return run


def _gathered(kind: pa.DataType, id_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by block, what is known of its texts first: a row for each text."""
        held: list = []

        def done() -> Iterator[pa.RecordBatch]:
            if held:
                ids, n, sums = held
                schema = pa.schema([(id_col, kind), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
                yield batch(schema, ids, n, sums["known"].astype(np.int64), sums["base"], sums["score"])

        name = None
        for b in batches:
            for block, first, data in zip(*(b.column(c).to_pylist() for c in ("block", "kind", "data")), strict=True):
                if first == 0:
                    yield from done()
                    head = pa.ipc.open_stream(data).read_all().combine_chunks()
                    name, held = block, [head.column("id").combine_chunks(), head.column("n").combine_chunks(), {k: np.zeros(head.num_rows) for k in ("score", "base", "known")}]
                    continue
                if block != name:
                    raise ValueError("sums of a block came without its texts")
                part = np.frombuffer(data, _SUMS)
                for k in ("score", "base", "known"):
                    held[2][k][part["doc"]] += part[k]
        yield from done()

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_tokens`` (words and the end), ``n_known`` (those of training), ``base_score`` and ``score``.

    ``score`` is the model's log10 probability of the whole text, ``base_score`` that of add-one smoothed word counts. Null texts
    are empty and have an end only; rows with equal or null ids are scored apart; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.own, model.shares))
    totals = spark.sparkContext.broadcast(model.totals)
    rows = docs.select(F.spark_partition_id().cast("long").alias("__part"), F.col(id_col), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("__text"))
    kinds = "word long, salt int, block long, data binary"
    both = rows.mapInArrow(_sent(shared, id_col), kinds).unionByName(model.words.mapInArrow(_dealt(model.shares), kinds))
    sums = both.repartition("word", "salt").sortWithinPartitions("word", "block").mapInArrow(_scored(totals), "block long, kind int, data binary")
    empty = spark.createDataFrame([], docs.select(id_col).schema).toArrow().schema.field(0).type
    return (
        sums.repartition("block").sortWithinPartitions("block", "kind")
        .mapInArrow(_gathered(empty, id_col), f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_tokens long, n_known long, base_score double, score double")
    )


def remainder(id_col: str, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % of


def op1_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(remainder("doc_id", 7) != 2))
    scored = score(docs, model)
    return scored.select("doc_id", (remainder("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", F.lit(model.totals.tokens).cast("long").alias("train_tokens"), "base_score", "score")
