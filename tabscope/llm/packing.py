"""Batches of documents of like lengths, with the least padding.

The histogram of all lengths has a row for each distinct one, of which n tokens together hold fewer than the root of 2n.
Dynamic programming over it finds the bucket boundaries for which the padding of all documents is smallest. Inside a bucket, documents are dealt to shards of bounded size by hash and numbered there; as many follow each other in a batch as
the token budget holds at the length of the bucket. A shard ends with at most one batch that is not full.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabscope.llm.common import ROW, slices, stored, table, texts

#: Documents that are numbered in one task.
SHARD = 50_000


def boundaries(tops: list[int], counts: list[int], buckets: int) -> list[int]:
    """The at most ``buckets`` values of the ascending ``tops``, the last among them, that minimise what all are filled up by.

    Each length of ``tops`` occurs ``counts`` times and is filled up to the next boundary.
    """
    if not tops:
        return []
    n = len(tops)
    total = [0, *itertools.accumulate(counts)]
    best = [t * c for t, c in zip(tops, total[1:], strict=True)]
    froms: list[list[int]] = []
    for _ in range(1, min(buckets, n)):
        # The cost of a boundary before j is a line in tops[j]; lines of falling slopes, their lower hull read from left to right.
        after, at, hull, head = best.copy(), [-1] * n, [], 0
        for j in range(1, n):
            slope, level = -total[j], best[j - 1]
            while len(hull) - head > 1:
                (_, m1, b1), (_, m2, b2) = hull[-2:]
                if (level - b1) * (m1 - m2) > (b2 - b1) * (m1 - slope):
                    break
                hull.pop()
            hull.append((j - 1, slope, level))
            x = tops[j]
            while head + 1 < len(hull) and hull[head + 1][1] * x + hull[head + 1][2] <= hull[head][1] * x + hull[head][2]:
                head += 1
            k, slope, level = hull[head]
            if (cost := slope * x + level + x * total[j + 1]) < after[j]:
                after[j], at[j] = cost, k
        best = after
        froms.append(at)
    out, j = [tops[-1]], n - 1
    for at in reversed(froms):
        if at[j] >= 0:
            j = at[j]
            out.append(tops[j])
    return sorted(out)


def word_lengths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and ``n_tokens``, the words of the text (runs of other than white space) and an end. A null text has an end only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "__text"):
            n = [len(t.split()) + 1 for t in b.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(id_col), pa.array(n, pa.int64())], names=[id_col, "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return texts(docs, id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long")


def histogram(lengths: DataFrame) -> list[tuple[int, int]]:
    """(length, number) of each distinct ``n_tokens``, in order."""
    return sorted((r["n_tokens"], r["n"]) for r in lengths.groupBy("n_tokens").agg(F.count("*").alias("n")).collect())


def pack(lengths: DataFrame, id_col: str = "doc_id", budget: int = 16_384, buckets: int = 16) -> DataFrame:
    """Per row of ``lengths`` (id, ``n_tokens``): its ``bucket`` from 0, the ``bucket_length`` it is filled up to, its ``batch`` and ``slot`` there.

    A batch holds at most ``budget`` tokens with its padding; a document that is longer is a batch of its own. Rows with a null
    length are left in no bucket or batch; equal or null ids don't matter; an empty table gives an empty result.
    """
    known = lengths.where("n_tokens IS NOT NULL")
    bins = histogram(known)
    tops = boundaries([t for t, _ in bins], [n for _, n in bins], buckets)
    sizes = [sum(n for t, n in bins if a < t <= b) for a, b in zip([-1, *tops], tops, strict=False)]
    if not tops:
        tops, sizes = [0], [0]
    values = F.array(*map(F.lit, tops))
    each = lambda xs: F.element_at(F.array(*map(F.lit, xs)), F.col("bucket") + 1)
    placed = (
        known.withColumn(ROW, F.monotonically_increasing_id())
        .withColumn("bucket", F.size(F.filter(values, lambda t: t < F.col("n_tokens"))))
        .withColumn("bucket_length", each(tops).cast("long"))
        .withColumn("__shard", F.pmod(F.xxhash64(ROW), each([max(1, -(-n // SHARD)) for n in sizes])).cast("int"))
        .withColumn("__at", F.row_number().over(Window.partitionBy("bucket", "__shard").orderBy(ROW)) - 1)
        .withColumn("__room", each([max(1, budget // max(1, t)) for t in tops]))
    )
    packed = placed.select(
        id_col, "n_tokens", "bucket", "bucket_length",
        F.concat_ws("-", "bucket", "__shard", F.floor(F.col("__at") / F.col("__room"))).alias("batch"),
        (F.col("__at") % F.col("__room")).cast("int").alias("slot"),
    )
    without = lengths.where("n_tokens IS NULL").select(id_col, "n_tokens", F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("long").alias("bucket_length"), F.lit(None).cast("string").alias("batch"), F.lit(None).cast("int").alias("slot"))
    return packed.unionByName(without)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = 16_384, buckets: int = 16) -> DataFrame:
    """``pack`` by the words of every whole text."""
    return pack(stored(word_lengths(docs, id_col, text_col)), id_col, budget, buckets)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
