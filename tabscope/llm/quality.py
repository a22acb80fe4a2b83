"""Quality of whole texts from a convolutional network over their bytes, in numpy.

Learned filters run over every byte of a text. Overlapping chunks cover all of it; each takes the maximum of every
filter, a small dense layer makes it a chunk's log odds, and their mean, maximum and minimum are combined into the one
probability of the document. The network is trained on the driver from a bounded sample of labelled documents; scoring is
one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscope.llm.common import batch, slices, table

WIDTH, FILTERS, HIDDEN = 6, 32, 16
#: A chunk is four blocks of so many bytes; the next one starts with its last block.
BLOCK, BLOCKS, STEP = 128, 4, 3
_PAD, _NEVER = 256, -1e3
#: What the network takes at most to learn from: documents of label 0 and 1, and chunks of each.
SAMPLE = (1500, 3000)
CHUNKS_OF_ONE = 8


def padded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array of symbols, each filled up to whole blocks, and the number of blocks of each."""
    blocks = np.array([-(-(len(t) + WIDTH) // BLOCK) for t in texts], np.int64)
    symbols = np.full(int(blocks.sum()) * BLOCK + WIDTH, _PAD, np.int32)
    for at, text in zip((np.cumsum(blocks) - blocks) * BLOCK, texts, strict=True):
        symbols[at : at + len(text)] = np.frombuffer(text, np.uint8)
    return symbols, blocks


def chunk_rows(blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The blocks of every chunk (the last is repeated where a text has fewer), and the chunks of each text."""
    chunks = 1 + np.maximum(0, -(-(blocks - BLOCKS) // STEP))
    first = np.repeat(np.cumsum(blocks) - blocks, chunks)
    last = np.repeat(np.cumsum(blocks), chunks) - 1
    k = np.arange(chunks.sum()) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    return np.minimum((first + k * STEP)[:, None] + np.arange(BLOCKS), last[:, None]), chunks


class Network:
    """Filters as a table for each of their bytes, a dense layer, and the weights that combine the chunks."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.tables = r.normal(0, 0.25, (WIDTH, _PAD + 1, FILTERS)).astype(np.float32)
        self.tables[:, _PAD] = _NEVER
        self.bias = np.zeros(FILTERS, np.float32)
        self.dense = r.normal(0, 0.3, (FILTERS, HIDDEN)).astype(np.float32)
        self.dense_bias = np.zeros(HIDDEN, np.float32)
        self.out = r.normal(0, 0.3, HIDDEN).astype(np.float32)
        self.out_bias = np.zeros(1, np.float32)
        self.combine = np.zeros(4)
        self.centre, self.scale = np.zeros(3), np.ones(3)
        self.constant: float | None = None
        self._pairs: list[np.ndarray] | None = None

    def pooled(self, symbols: np.ndarray) -> np.ndarray:
        """The maximum of each filter in each block."""
        if self._pairs is None:  # two bytes at once
            self._pairs = [(self.tables[j][:, None] + self.tables[j + 1][None]).reshape(-1, FILTERS) for j in range(0, WIDTH, 2)]
        n = len(symbols) - WIDTH
        pairs = symbols[:-1] * (_PAD + 1) + symbols[1:]
        total = self._pairs[0][pairs[:n]]
        for j in range(1, WIDTH // 2):
            total += self._pairs[j][pairs[2 * j : 2 * j + n]]
        return total.reshape(-1, BLOCK, FILTERS).max(1)

    def chunk_odds(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        symbols, blocks = padded(texts)
        rows, chunks = chunk_rows(blocks)
        top = np.concatenate([self.pooled(symbols[a : a + 1024 * BLOCK + WIDTH]) for a in range(0, len(symbols) - WIDTH, 1024 * BLOCK)])
        features = np.maximum(top[rows].max(1) + self.bias, 0)
        return np.maximum(features @ self.dense + self.dense_bias, 0) @ self.out + self.out_bias, chunks

    def summary(self, texts: list[bytes]) -> np.ndarray:
        odds, chunks = self.chunk_odds(texts)
        starts = np.cumsum(chunks) - chunks
        return np.stack([np.add.reduceat(odds, starts) / chunks, np.maximum.reduceat(odds, starts), np.minimum.reduceat(odds, starts)], 1).astype(float)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.constant is not None or not texts:
            return np.full(len(texts), self.constant or 0.0)
        z = np.column_stack([(self.summary(texts) - self.centre) / self.scale, np.ones(len(texts))]) @ self.combine
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def fit(self, texts: list[bytes], labels: np.ndarray, weights: np.ndarray, epochs: int = 10, steps: int = 500, seed: int = 7) -> None:
        """Learn the filters from the chunks of three quarters of the texts, how to combine them from the rest.

        The chunks are gone through ``epochs`` times, few of them more often, for at least ``steps`` steps.
        """
        r = np.random.default_rng(seed)
        order = r.permutation(len(texts))
        rest = set(order[: len(texts) // 4].tolist())
        if any(len({labels[i] for i in part}) < 2 for part in (rest, set(order.tolist()) - rest)):
            rest = set()
        windows, marks = [], []
        for i, text in enumerate(texts):
            if i in rest:
                continue
            symbols, blocks = padded([text])
            rows = chunk_rows(blocks)[0][:, 0]
            for k in r.permutation(rows)[:CHUNKS_OF_ONE]:
                window = np.full(BLOCK * BLOCKS + WIDTH, _PAD, np.int32)
                part = symbols[k * BLOCK : k * BLOCK + len(window)]
                window[: len(part)] = part
                windows.append(window)
                marks.append(labels[i])
        windows, marks = np.stack(windows), np.array(marks, np.float32)
        balance = np.where(marks > 0, 0.5 / max(marks.mean(), 1e-3), 0.5 / max(1 - marks.mean(), 1e-3)).astype(np.float32)
        names = ("tables", "bias", "dense", "dense_bias", "out", "out_bias")
        moments = {k: (np.zeros_like(getattr(self, k)), np.zeros_like(getattr(self, k))) for k in names}
        step, parts = 0, max(1, len(windows) // 64)
        for _ in range(max(epochs, -(-steps // parts))):
            for at in np.array_split(r.permutation(len(windows)), parts):
                step += 1
                for k, g in self._gradients(windows[at], marks[at], balance[at]).items():
                    m, v = moments[k]
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p = getattr(self, k)
                    p -= 0.004 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)
                self.tables[:, _PAD] = _NEVER
        self._pairs = None
        some = sorted(rest) or range(len(texts))
        x = np.concatenate([self.summary([texts[i] for i in some][a : a + 256]) for a in range(0, len(some), 256)])
        self.centre, self.scale = x.mean(0), x.std(0) + 1e-6
        self.combine = _logistic(np.column_stack([(x - self.centre) / self.scale, np.ones(len(x))]), labels[list(some)], weights[list(some)])

    def _gradients(self, windows: np.ndarray, marks: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
        n = windows.shape[1] - WIDTH
        total = self.tables[0][windows[:, :n]]
        for j in range(1, WIDTH):
            total += self.tables[j][windows[:, j : j + n]]
        where = total.argmax(1)
        top = np.take_along_axis(total, where[:, None], 1)[:, 0] + self.bias
        features = np.maximum(top, 0)
        inner = features @ self.dense + self.dense_bias
        hidden = np.maximum(inner, 0)
        odds = hidden @ self.out + self.out_bias
        error = ((1 / (1 + np.exp(-np.clip(odds, -30, 30))) - marks) * weights / len(marks)).astype(np.float32)
        back = np.outer(error, self.out) * (inner > 0)
        deep = (back @ self.dense.T) * (top > 0)
        tables = np.zeros_like(self.tables)
        rows, filters = np.arange(len(windows))[:, None], np.arange(FILTERS)
        for j in range(WIDTH):
            np.add.at(tables[j], (windows[rows, where + j], filters), deep)
        return {"tables": tables, "bias": deep.sum(0), "dense": features.T @ back, "dense_bias": back.sum(0), "out": hidden.T @ error, "out_bias": error.sum(keepdims=True)}


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    b = np.zeros(x.shape[1])
    keep = ridge * np.eye(len(b))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        move = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + keep, x.T @ (w * (y - p)) - keep @ b)
        b += np.clip(move, -2, 2)
        if abs(move).max() < 1e-6:
            break
    return b


def held_out(id_col: str, of: int) -> F.Column:
    """Whether crc32 of the id as text leaves remainder 0; a null id does not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % of == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: tuple[int, int] = SAMPLE) -> Network:
    """A network from ``docs`` whose id has a label of 0 or 1 in ``labels``; of several labels of an id the larger counts.

    At most ``sample`` documents of label 0 and 1, those with the smallest hashes of their ids, are learned from; a weight
    for each class restores its share among all labels. With labels of one class or none, all scores are their share.
    """
    spark = docs.sparkSession
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).cast("int").alias("__y"))
    counts = {r["__y"]: r["count"] for r in known.groupBy("__y").count().collect()}
    chosen = [known.where(F.col("__y") == y).orderBy(F.xxhash64("__id"), "__id").limit(sample[y]) for y in (0, 1)]
    chosen = spark.createDataFrame(chosen[0].unionAll(chosen[1]).toPandas(), known.schema)  # bounded by ``sample``
    rows = (
        docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("__text"))
        .join(F.broadcast(chosen), "__id")
        .orderBy(F.xxhash64("__id"), "__text")
        .limit(sum(sample))  # ids may occur in many rows
        .collect()
    )
    network = Network()
    y = np.array([r["__y"] for r in rows])
    if len(set(y.tolist())) < 2:
        network.constant = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
        return network
    share = {k: counts[k] / max(1, int((y == k).sum())) for k in (0, 1)}
    weights = np.array([share[k] for k in y.tolist()])
    network.fit([bytes(r["__text"]) for r in rows], y, weights / weights.mean())
    return network


def score(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Per row: the columns of ``keep`` (the id alone by default) and ``score``, the probability of label 1.

    A null text counts as empty and has a score like any other; rows are judged apart from each other, an empty table gives none.
    """
    network._pairs = None
    shared = docs.sparkSession.sparkContext.broadcast(network)  # some hundred KB, whatever the data
    keep = [id_col] if keep is None else keep
    rows = docs.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keep)], F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "__text", 2 << 20):
            scores = shared.value.scores(b.column("__text").to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(scores, pa.float64())], names=[*b.schema.names[:-1], "score"])

    schema = ", ".join(f"__k{i} {docs.schema[k].dataType.simpleString()}" for i, k in enumerate(keep))
    scored = rows.mapInArrow(run, f"{schema + ', ' if schema else ''}score double")
    return scored.toDF(*keep, "score")


#: A document is kept if its score reaches this.
THRESHOLD = 0.3


def filter_quality(docs: DataFrame, network: Network, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, whose score reaches ``threshold``."""
    network._pairs = None
    shared = docs.sparkSession.sparkContext.broadcast(network)

    @F.arrow_udf("double")
    def scores(column: pa.Array) -> pa.Array:
        parts = slices(iter([pa.RecordBatch.from_arrays([column], names=["__text"])]), "__text", 2 << 20)
        return pa.array([s for b in parts for s in shared.value.scores(b.column(0).to_pylist()).tolist()], pa.float64())

    return docs.where(scores(F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))) >= threshold)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    network = train(docs, labels.where(~held_out("doc_id", 5)))
    return score(docs, network).select("doc_id", held_out("doc_id", 5).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
