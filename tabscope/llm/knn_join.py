"""Exact k highest inner products for many queries, as a Voronoi kNN join.

One more component makes all vectors equally long, so the highest inner product is the smallest distance. Queries and data are
grouped by their nearest pivot. A few numbers for each group, its largest distance to the pivot and its smallest ones, bound how
far the k-th neighbour of any query of a group can be. A vector is sent only to the groups within whose bound it may lie, and each
group is solved on its own, its data in chunks of bounded size, from which the k best are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabscope.llm.common import ROW, batch, stored, table

#: Vectors of a chunk.
CHUNK = 100_000


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """The vectors with the component that makes their squares sum to ``longest``."""
    rest = np.maximum(longest - (x.astype(float) ** 2).sum(1), 0)
    return np.concatenate([x, np.sqrt(rest)[:, None]], 1)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x**2).sum(1)[:, None] + (pivots**2).sum(1) - 2 * x @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def _summary(pivots: np.ndarray, longest: float, width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per task and group: the largest distance of a query, and the k + 1 smallest of the data."""
        schema = pa.schema([("group", pa.int32()), ("far", pa.float64()), ("near", pa.list_(pa.float64()))])
        far, near = np.full(len(pivots), -1.0), [np.zeros(0)] * len(pivots)
        for b in batches:
            if not b.num_rows:
                continue
            x, query = _matrix(b.column("x"), width), b.column("query").to_numpy(zero_copy_only=False)
            d = _distances(_lifted(x, longest), pivots)
            own = d.argmin(1)
            for g in np.unique(own).tolist():
                near[g] = np.sort(np.concatenate([near[g], d[own == g, g]]))[: k + 1]
            if query.any():
                q = _distances(np.concatenate([x[query], np.zeros((query.sum(), 1))], 1), pivots)
                np.maximum.at(far, q.argmin(1), q.min(1))
        yield batch(schema, np.arange(len(pivots), dtype=np.int32), far, [n.tolist() for n in near])

    return run


def _bounds(pivots: np.ndarray, far: np.ndarray, near: list[list[float]], k: int) -> np.ndarray:
    """How far from its pivot a vector can be at most to be among the k nearest of some query of a group; -1 without queries.

    Of k + 1 vectors within a distance at most one is the query's own.
    """
    between = _distances(pivots, pivots)
    out = np.full(len(pivots), -1.0)
    for g in np.flatnonzero(far >= 0).tolist():
        reach = np.sort(np.concatenate([far[g] + between[g, j] + np.array(n) for j, n in enumerate(near)]))
        bound = reach[k] if len(reach) > k else np.inf
        out[g] = (bound + far[g]) * (1 + 1e-9) + 1e-6  # roundings of the distances are far smaller
    return out


def _sent(pivots: np.ndarray, longest: float, width: int, bounds: np.ndarray, salts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Data to each group that may need them, in the chunk of their hash; queries to all chunks of their group."""
        for b in batches:
            if not b.num_rows:
                continue
            x, query, salt = _matrix(b.column("x"), width), b.column("query").to_numpy(zero_copy_only=False), b.column("salt").to_numpy()
            row, group = np.nonzero(_distances(_lifted(x, longest), pivots) <= bounds)
            q = np.flatnonzero(query)
            own = _distances(np.concatenate([x[q], np.zeros((len(q), 1))], 1), pivots).argmin(1) if len(q) else q
            rows = np.concatenate([row, np.repeat(q, salts)])
            taken = b.select([ROW, "id", "x"]).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([group, np.repeat(own, salts)]), pa.int32()), pa.array(np.concatenate([salt[row], np.tile(np.arange(salts), len(q))]), pa.int32()), pa.array(np.arange(len(rows)) >= len(row)), *taken.columns],
                names=["group", "salt", "query", ROW, "id", "x"],
            )

    return run


def _solved(width: int, k: int, exact: bool):
    schema = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    kind = float if exact else np.int64  # products of floats are exact below 2^53

    def best(data: tuple, q: pa.Table) -> Iterator[pa.RecordBatch]:
        ids, rows, x = data
        queries, query_rows, names = _matrix(q.column("x"), width).astype(kind), q.column(ROW).to_numpy(), q.column("id").to_numpy()
        for at in range(0, len(queries), 256):
            scores = (queries[at : at + 256] @ x.T).astype(np.int64)
            out: list[list[np.ndarray]] = [[], [], [], []]
            for s, row, name in zip(scores, query_rows[at : at + 256], names[at : at + 256], strict=True):
                other = rows != row
                s = np.where(other, s, np.iinfo(np.int64).min)
                n = min(k, int(other.sum()))
                if not n:
                    continue
                least = np.partition(s, len(s) - n)[len(s) - n]
                over = np.flatnonzero(s > least)
                chosen = np.concatenate([over, np.flatnonzero((s == least) & other)[: n - len(over)]])  # ids ascend
                for column, value in zip(out, (np.full(n, row), np.full(n, name), ids[chosen], s[chosen]), strict=True):
                    column.append(value)
            if out[0]:
                yield batch(schema, *map(np.concatenate, out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best of each chunk for each query; the data of a chunk come before its queries."""
        key, held, data = None, [], None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.table(b)
            keys = np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("group", "salt", "query")], 1)
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for s, e in zip(edges, edges[1:], strict=False):
                part, now = t.slice(s, e - s), tuple(keys[s, :2])
                if now != key:
                    key, held, data = now, [], None
                if not keys[s, 2]:
                    held.append(part)
                    continue
                if data is None and held:
                    d = pa.concat_tables(held).combine_chunks()
                    order = np.argsort(d.column("id").to_numpy(), kind="stable")
                    data = d.column("id").to_numpy()[order], d.column(ROW).to_numpy()[order], _matrix(d.column("x"), width)[order].astype(kind)
                    held = []
                if data is not None:
                    yield from best(data, part)

    return run


def top_inner_products(vectors: DataFrame, query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256, pivots: int = 16) -> DataFrame:
    """For each row of ``vectors`` that ``query`` picks, the ``k`` highest inner products with all other rows, ties to smaller ids.

    ``query_id``, ``rank`` from 1, ``vec_id`` and ``score``; all others where there are fewer than ``k``. Components count as
    ``floor(scale * x)``. Vectors that are null or empty or hold a null or non-finite component, and rows without an id, take no
    part; a shorter vector has zeros at its end; rows of equal id are rows of their own. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    x = F.col(vector_col)
    finite = lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) != float("inf"))
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long"))
    rows = stored(
        vectors.where(x.isNotNull() & (F.size(x) > 0) & F.col(id_col).isNotNull())
        .where(F.forall(x, lambda v: F.coalesce(finite(v), F.lit(False))))
        .select(F.monotonically_increasing_id().alias(ROW), F.col(id_col).cast("long").alias("id"), whole.alias("x"), F.coalesce(query, F.lit(False)).alias("query"))
    )
    norm = F.aggregate("x", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    n, longest, width, queries = rows.agg(F.count("*"), F.max(norm), F.max(F.size("x")), F.count_if("query")).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not queries:
        return spark.createDataFrame([], schema)
    salts = -(-n // CHUNK)
    filled = rows.select(ROW, "id", "query", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x"))).alias("x"), F.pmod(F.xxhash64(ROW), F.lit(salts)).cast("int").alias("salt"))
    chosen = filled.orderBy(F.xxhash64("id"), ROW).limit(pivots).select("x").collect()
    p = np.unique(_lifted(np.array([r["x"] for r in chosen], np.int64), longest), axis=0)
    parts = filled.mapInArrow(_summary(p, longest, width, k), "group int, far double, near array<double>")
    parts = parts.groupBy("group").agg(F.max("far").alias("far"), F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, k + 1).alias("near")).orderBy("group").collect()
    bounds = _bounds(p, np.array([r["far"] for r in parts]), [r["near"] for r in parts], k)
    sent = filled.mapInArrow(_sent(p, longest, width, bounds, salts), f"group int, salt int, query boolean, {ROW} long, id long, x array<bigint>")
    solved = sent.repartition("group", "salt").sortWithinPartitions("group", "salt", "query").mapInArrow(_solved(width, k, longest < 2**52), "query_row long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return solved.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_knn_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_inner_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


OP6_SQL = """
WITH vectors AS (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT q.r, q.vec_id AS query_id, d.vec_id AS vec_id, CAST(list_inner_product(q.x, d.x) AS BIGINT) AS score
  FROM vectors q JOIN vectors d ON q.r <> d.r WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
