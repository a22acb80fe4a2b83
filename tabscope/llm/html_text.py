"""Main text of web pages, from a recurrent network that labels every block of text of a page.

A page is cut into leaf blocks, the runs of text between block-level tags. Each block is described by the hashed names on
its tag path (tags, classes, ids, roles), its hashed words and a few measures. A bidirectional LSTM in numpy reads the blocks
of the whole page in both directions and says of each whether it belongs to the main text. There are no labelled pages,
so the network learns from pages whose labels are known by construction: text of a bounded sample of pages, laid out anew in
many kinds of markup, and those of the sample itself whose markup names its parts. Extraction is one pass without a shuffle.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscope.llm.common import slices, table

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags whose content is no markup, and tags that are left out with all markup in them.
_RAW = frozenset("script style textarea iframe".split())
_WHOLE = frozenset("noscript template select svg object".split())
_INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split())
#: Tags that end an open one of the same kind, and what that search does not leave.
_ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_KEEPS = frozenset("article aside body div footer form header main nav ol section table ul dl blockquote td".split())


class Block(NamedTuple):
    text: str  # decoded, white space made one space
    path: tuple[str, ...]  # names on the tag path
    linked: float  # share of its characters inside links


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order; markup, comments, scripts, styles and closed drawings, objects and the like hold none."""
    found: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked = 0
    links = at = 0
    ends: dict[int, int] | None = None

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                path = tuple(dict.fromkeys(n for _, names in stack for n in names))
                found.append(Block(text, path, min(1.0, linked / len(text))))
            parts.clear()
        linked = 0

    while at < len(page):
        m = _TAG.search(page, at)
        text = page[at : m.start() if m else len(page)]
        if text:
            parts.append(text)
            if links:
                linked += len(text)
        if not m:
            break
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        closing = bool(m["end"] or m["end2"])
        if name == "br":
            parts.append(" ")
            continue
        if name not in _INLINE and name not in _RAW and name not in _WHOLE:
            flush()
        if closing:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            if depth is not None:
                if name in _INLINE and any(t in _KEEPS for t, _ in stack[depth + 1 :]):
                    continue  # an inline end doesn't close containers
                flush() if any(t not in _INLINE for t, _ in stack[depth:]) else None
                links -= sum(t == "a" for t, _ in stack[depth:])
                del stack[depth:]
            continue
        if name in _RAW:
            at = _past(page, name, at)
            parts.append(" ")
            continue
        if name in _WHOLE:
            ends = _matches(page) if ends is None else ends
            if at in ends or (m["rest"] or "").endswith("/"):
                at = ends.get(at, at)
                parts.append(" ")
                continue
        if name in _VOID or (m["rest"] or "").endswith("/") and name not in _INLINE and name not in _KEEPS:
            continue
        for k in range(len(stack) - 1, -1, -1) if name in _ENDS else ():
            if stack[k][0] in _ENDS[name]:
                links -= sum(t == "a" for t, _ in stack[k:])
                del stack[k:]
                break
            if stack[k][0] in _KEEPS and stack[k][0] not in _ENDS[name]:
                break
        stack.append((name, _names(name, m["rest"] or m["rest2"] or "")))
        links += name == "a"
    flush()
    return found


def _past(page: str, name: str, at: int) -> int:
    """Where the end tag ends up to which a page holds no markup."""
    end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
    return end.end() if end else len(page)


def _matches(page: str) -> dict[int, int]:
    """Of tags of ``_WHOLE`` that are closed, where the tag ends and where its own end tag does."""
    found, opened, at = {}, {name: [] for name in _WHOLE}, 0
    while m := _TAG.search(page, at):
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if m["end"] or m["end2"]:
            if opened.get(name):
                found[opened[name].pop()] = at
        elif name in _RAW:
            at = _past(page, name, at)
        elif name in _WHOLE and not (m["rest"] or "").endswith("/"):
            opened[name].append(at)
    return found


@lru_cache(maxsize=50_000)
def _names(tag: str, attributes: str) -> tuple[str, ...]:
    names = [tag]
    if "=" in attributes:
        for kind, *values in _NAMES.findall(attributes):
            for value in "".join(values).lower().split():
                names += [f"{kind.lower()}={value}", *(f"~{w}" for w in re.findall(r"[a-z]+", value))]
    return tuple(names)


# --- features -------------------------------------------------------------------------------------------------------

PATHS, WORDS, PATH_SIZE, WORD_SIZE, MEASURES, HIDDEN = 4096, 8192, 24, 8, 6, 16
INPUT = PATH_SIZE + WORD_SIZE + MEASURES
_WORD = re.compile(r"\w+")


@lru_cache(maxsize=200_000)
def _bucket(name: str, size: int) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % size


class Features(NamedTuple):
    """Names and words of many blocks as bucket numbers, one block after the other, and how many each has."""

    path: np.ndarray
    path_n: np.ndarray
    words: np.ndarray
    words_n: np.ndarray
    measures: np.ndarray


def features(pages: list[list[Block]]) -> Features:
    path, path_n, words, words_n, measures = [], [], [], [], []
    for page in pages:
        for i, b in enumerate(page):
            path += [_bucket(n, PATHS) for n in b.path]
            path_n.append(len(b.path))
            found = _WORD.findall(b.text.lower())
            words += [_bucket(w, WORDS) for w in found]
            words_n.append(len(found))
            n = len(b.text)
            measures.append((np.log1p(len(found)) / 4, b.linked, min(1.0, 20 * sum(map(b.text.count, ".,;:!?")) / n), (i + 1) / len(page), 1 / (i + 1), 1 / (len(page) - i)))
    return Features(*(np.array(x, np.int64) for x in (path, path_n, words, words_n)), np.array(measures, np.float32).reshape(-1, MEASURES))


def _means(values: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    out = np.zeros((len(counts), values.shape[1]), np.float32)
    full = np.flatnonzero(counts)
    if len(full):
        starts = np.cumsum(counts[full]) - counts[full]
        out[full] = np.add.reduceat(values[ids], starts) / counts[full, None]
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Embeddings, an LSTM for each direction, and a logistic output for each block."""

    def __init__(self, seed: int = 3):
        r = np.random.default_rng(seed)
        n = lambda *shape, s=0.2: r.normal(0, s, shape).astype(np.float32)
        self.weights = {"path": n(PATHS, PATH_SIZE, s=0.5), "words": n(WORDS, WORD_SIZE, s=0.1), "out": n(2 * HIDDEN + INPUT), "out_bias": np.zeros(1, np.float32)}
        for d in "fb":
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN : 2 * HIDDEN] = 1
            self.weights |= {f"x{d}": n(INPUT, 4 * HIDDEN), f"h{d}": n(HIDDEN, 4 * HIDDEN), f"bias{d}": bias}

    def inputs(self, f: Features) -> np.ndarray:
        return np.concatenate([_means(self.weights["path"], f.path, f.path_n), _means(self.weights["words"], f.words, f.words_n), f.measures], 1)

    def _states(self, x: np.ndarray, mask: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """Hidden states of one direction for inputs [step, page, input]; a masked step keeps the state."""
        steps, n, _ = x.shape
        order = range(steps) if d == "f" else range(steps - 1, -1, -1)
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        ahead = x @ self.weights[f"x{d}"] + self.weights[f"bias{d}"]
        out, kept = np.zeros((steps, n, HIDDEN), np.float32), [None] * steps
        for t in order:
            z = ahead[t] + h @ self.weights[f"h{d}"]
            i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            c_new = f * c + i * g
            deep = np.tanh(c_new)
            kept[t] = (h, c, i, f, o, g, deep)
            h, c = np.where(m, o * deep, h), np.where(m, c_new, c)
            out[t] = h
        return out, kept

    def _lay(self, x: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        steps = int(lengths.max())
        page = np.repeat(np.arange(len(lengths)), lengths)
        step = np.arange(len(x)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        laid = np.zeros((steps, len(lengths), x.shape[1]), np.float32)
        laid[step, page] = x
        return laid, np.arange(steps)[:, None] < lengths

    def probabilities(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """For every block of every page. Pages of like lengths are read side by side; the result doesn't depend on it."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
        while order:
            some, order = order[:64], order[64:]
            lengths = np.array([len(pages[i]) for i in some])
            x = self.inputs(features([pages[i] for i in some]))
            laid, mask = self._lay(x, lengths)
            states = np.concatenate([self._states(laid, mask, "f")[0], self._states(laid, mask, "b")[0], laid], 2)
            p = _sigmoid(states @ self.weights["out"] + self.weights["out_bias"])
            for k, i in enumerate(some):
                out[i] = p[: lengths[k], k]
        return out

    def fit(self, pages: list[tuple[list[Block], list[int]]], epochs: int = 6, seed: int = 3) -> None:
        r = np.random.default_rng(seed)
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.weights.items()}
        step = 0
        for _ in range(epochs):
            order = sorted(r.permutation(len(pages)).tolist(), key=lambda i: len(pages[i][0]) // 8)
            batches = [order[a : a + 24] for a in range(0, len(order), 24)]
            for k in r.permutation(len(batches)):
                step += 1
                for name, g in self._gradients([pages[i] for i in batches[k]]).items():
                    m, v = moments[name]
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    self.weights[name] -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)

    def _gradients(self, pages: list[tuple[list[Block], list[int]]]) -> dict[str, np.ndarray]:
        f = features([p for p, _ in pages])
        lengths = np.array([len(p) for p, _ in pages])
        laid, mask = self._lay(self.inputs(f), lengths)
        y = self._lay(np.concatenate([l for _, l in pages])[:, None].astype(np.float32), lengths)[0][:, :, 0]
        forward, kept_f = self._states(laid, mask, "f")
        backward, kept_b = self._states(laid, mask, "b")
        states = np.concatenate([forward, backward, laid], 2)
        error = np.where(mask, _sigmoid(states @ self.weights["out"] + self.weights["out_bias"]) - y, 0).astype(np.float32) / mask.sum()
        grads = {"out": np.einsum("tn,tnk->k", error, states), "out_bias": error.sum(keepdims=True)[0]}
        back = error[:, :, None] * self.weights["out"]
        dx = back[:, :, 2 * HIDDEN :].copy()
        for d, kept, dh_all, order in (("f", kept_f, back[:, :, :HIDDEN], range(len(laid) - 1, -1, -1)), ("b", kept_b, back[:, :, HIDDEN : 2 * HIDDEN], range(len(laid)))):
            wx, wh = self.weights[f"x{d}"], self.weights[f"h{d}"]
            gx, gh, gb = np.zeros_like(wx), np.zeros_like(wh), np.zeros(4 * HIDDEN, np.float32)
            dh = np.zeros((len(lengths), HIDDEN), np.float32)
            dc = np.zeros_like(dh)
            for t in order:
                h, c, i, fg, o, g, deep = kept[t]
                m = mask[t][:, None]
                dh = dh + dh_all[t]
                own_h, own_c = np.where(m, dh, 0), np.where(m, dc, 0)
                own_c = own_c + own_h * o * (1 - deep * deep)
                dz = np.concatenate([own_c * g * i * (1 - i), own_c * c * fg * (1 - fg), own_h * deep * o * (1 - o), own_c * i * (1 - g * g)], 1)
                gx += laid[t].T @ dz
                gh += h.T @ dz
                gb += dz.sum(0)
                dx[t] += dz @ wx.T
                dh = np.where(m, dz @ wh.T, dh)
                dc = np.where(m, own_c * fg, dc)
            grads |= {f"x{d}": gx, f"h{d}": gh, f"bias{d}": gb}
        page = np.repeat(np.arange(len(lengths)), lengths)
        flat = dx[np.arange(len(page)) - np.repeat(np.cumsum(lengths) - lengths, lengths), page]
        for name, ids, counts, part in (("path", f.path, f.path_n, flat[:, :PATH_SIZE]), ("words", f.words, f.words_n, flat[:, PATH_SIZE : PATH_SIZE + WORD_SIZE])):
            grads[name] = np.zeros_like(self.weights[name])
            np.add.at(grads[name], ids, np.repeat(part / np.maximum(counts, 1)[:, None], counts, axis=0))
        return grads


# --- what it learns from --------------------------------------------------------------------------------------------

#: Markup of parts in the pages made for training: (opening, closing) by kind.
_MAIN = [("<article>", "</article>"), ("<main>", "</main>"), ("<main><article class='post'>", "</article></main>"), ("<div id='content'>", "</div>"), ("<div class='article-body'>", "</div>"), ("<section class='story'>", "</section>"), ("<div class='entry-content'>", "</div>"), ("<div class='post-text main'>", "</div>"), ("<div role='main'>", "</div>")]
_MENU = [("<nav>", "</nav>"), ("<div class='menu'>", "</div>"), ("<div id='navigation'>", "</div>"), ("<div class='breadcrumb'>", "</div>"), ("<div role='navigation'>", "</div>")]
_HEAD = [("<header>", "</header>"), ("<div id='header'>", "</div>"), ("<div class='top-bar masthead'>", "</div>")]
_FOOT = [("<footer>", "</footer>"), ("<div class='footer'>", "</div>"), ("<div id='footer' class='copyright'>", "</div>")]
_SIDE = [("<aside>", "</aside>"), ("<div class='sidebar'>", "</div>"), ("<div id='related' class='widget'>", "</div>")]
_NOTE = [("<div class='cookie-notice'>", "</div>"), ("<div class='notice banner'>", "</div>"), ("<div id='consent' role='dialog'>", "</div>"), ("<div class='newsletter popup'>", "</div>")]
_ADS = [("<div class='ad'>", "</div>"), ("<div class='advert'>", "</div>"), ("<div class='ads sponsored'>", "</div>"), ("<section id='promo'>", "</section>")]
_FORM = [("<form>", "</form>"), ("<form class='search'>", "</form>"), ("<div class='subscribe'><form>", "</form></div>")]
_TALK = [("<section id='comments'>", "</section>"), ("<div class='comments'>", "</div>"), ("<ol class='comment-list'>", "</ol>"), ("<div class='replies discussion'>", "</div>")]
_OUTSIDE = frozenset("nav header footer aside form ~ad ~ads ~advert ~sidebar ~comment ~comments ~cookie ~notice ~menu ~banner head title button label role=navigation".split())
_INSIDE = frozenset("article main role=main".split())


def marked(page: list[Block]) -> list[int]:
    """Labels of a page by the names in its markup."""
    return [int(not _OUTSIDE & (names := set(b.path)) and bool(_INSIDE & names)) for b in page]


def laid_out(page: list[Block], other: list[Block], r: np.random.Generator) -> tuple[list[Block], list[int]]:
    """A page of new markup around the texts of ``page``, with those of ``other`` in its side parts, and its labels."""
    inner = [b.text for b, y in zip(page, marked(page), strict=True) if y] or [b.text for b in page]
    start = int(r.integers(0, max(1, len(inner) - 40)))
    inner = inner[start : start + 40]
    side = [b.text for b in other] or inner
    pick = lambda n: [side[int(i)] for i in r.integers(0, len(side), n)]
    few = lambda t, n: " ".join(t.split()[:n])
    kind = lambda kinds: kinds[int(r.integers(len(kinds)))]
    out, labels = [], []

    def part(kinds: list[tuple[str, str]], body: str, label: int) -> str:
        opened, closed = kind(kinds)
        labels.append(label)
        return opened + body + closed

    def write(pieces: list[str], n: int) -> str:
        return "".join(f"<p>{html.escape(few(t, n))}</p>" for t in pieces)

    def menu() -> str:
        return "<ul>" + "".join(f"<li><a href='/x'>{html.escape(few(t, 2))}</a></li>" for t in pick(int(r.integers(2, 8)))) + "</ul>"

    if r.random() < 0.5:
        out.append((part(_HEAD, f"<h2>{html.escape(few(pick(1)[0], 5))}</h2>" + write(pick(int(r.integers(0, 2))), 12), 0), 0))
    if r.random() < 0.8:
        out.append((part(_MENU, menu(), 0), 0))
    for kinds, chance, n in ((_NOTE, 0.4, 30), (_ADS, 0.5, 25), (_FORM, 0.2, 6)):
        if r.random() < chance:
            out.append((part(kinds, write(pick(1), n), 0), 0))
    opened, closed = kind(_MAIN)
    title = f"<h1>{html.escape(few(inner[0], 9))}</h1>" if inner and r.random() < 0.7 else ""
    wrap = kind([("<p>", "</p>"), ("<p><b>", "<br>"), ("<div>", "</div>"), ("<p><span>", "</span></p>"), ("<p><a href='/y'>", "</a></p>")])
    body = [f"{wrap[0] if r.random() < 0.4 else '<p>'}{html.escape(t)}{wrap[1] if r.random() < 0.4 else '</p>'}" for t in inner]
    cut = int(r.integers(0, len(body) + 1))
    out.append((opened + title + "".join(body[:cut]), 1))
    if r.random() < 0.4:
        out.append((part(kind([_ADS, _NOTE, _SIDE, _FORM]) , write(pick(1), 25), 0), 0))
    out.append(("".join(body[cut:]) + closed, 1))
    for kinds, chance, n, m in ((_SIDE, 0.5, 4, 20), (_TALK, 0.5, 6, 60), (_FOOT, 0.8, 2, 20)):
        if r.random() < chance:
            texts = pick(int(r.integers(1, n)))
            out.append((part(kinds, write(texts, m) if r.random() < 0.7 else " &middot; ".join(html.escape(few(t, m)) for t in texts), 0), 0))
    # Parts are marked by a character that no text holds, so that the parser tells which blocks they became.
    made = blocks("<html><body>" + "".join(re.sub(r">([^<]*[^<\s][^<]*)", lambda m, y=y: f">{'' if y else chr(1)}{m[1]}", ">" + s)[1:] for s, y in out) + "</body></html>")
    return [b._replace(text=" ".join(b.text.replace("\x01", " ").split()) or "-") for b in made], [int("\x01" not in b.text) for b in made]


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = 300, made: int = 900, longest: int = 60_000) -> Labeller:
    """A labeller learned from at most ``sample`` pages of at most ``longest`` bytes, those with the smallest hashes, and ``made`` pages laid out from their texts."""
    rows = (
        pages.where((F.octet_length(html_col) <= longest) & (F.octet_length(html_col) > 0))
        .select(F.xxhash64(F.col(id_col)).alias("__h"), F.col(html_col).alias("__page"))
        .orderBy("__h", "__page").limit(sample).collect()
    )
    r = np.random.default_rng(11)
    real = [b for b in (blocks(row["__page"].replace("\x01", " ")) for row in rows) if b]
    learn = [(b[:80], marked(b)[:80]) for b in real if any(marked(b))]
    for _ in range(made if real else 0):
        a, b = r.integers(0, len(real), 2)
        learn.append(laid_out(real[int(a)], real[int(b)], r))
    model = Labeller()
    learn = [x for x in learn if x[0]]
    if learn:
        model.fit(learn)
    return model


def extract(pages: DataFrame, model: Labeller, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Per row the columns of ``keep``, ``text`` (the blocks of the main text in page order, a line each) and ``n_chars``.

    A null or empty page, or one without main text, has an empty text and 0; rows are read apart from each other, and an
    empty table gives an empty result.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)  # under 1 MB, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "__page", 4 << 20):
            cut = [blocks(p) for p in b.column("__page").cast(pa.string()).to_pylist()]
            chosen = shared.value.probabilities(cut)
            texts = ["\n".join(x.text for x, p in zip(page, ps, strict=True) if p >= 0.5) for page, ps in zip(cut, chosen, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[*b.schema.names[:-1], "text", "n_chars"])

    rows = pages.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keep)], F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("__page"))
    schema = "".join(f"__k{i} {pages.schema[k].dataType.simpleString()}, " for i, k in enumerate(keep))
    return rows.mapInArrow(run, f"{schema}text string, n_chars long").toDF(*keep, "text", "n_chars")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, train(pages))
