"""Connected components of a graph of links, by alternating stars on DataFrames."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for every node of the links (a, b) but the roots themselves.

    Each round hangs the neighbours of a node on the smallest of them, first the larger ones, then the smaller ones, and
    is written to the shared folder; rounds grow with the logarithm of the longest path. Nulls and loops are ignored.
    """
    edges = stored(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
    return tuple(r)


def spanning(adjacent: np.ndarray) -> np.ndarray:
    """Pairs (first, other) of nodes of a symmetric matrix of links: each component's first node with every other one of it."""
    left = np.ones(len(adjacent), bool)
    pairs = [np.zeros((0, 2), np.int64)]
    for k in range(len(adjacent)):
        if not left[k]:
            continue
        left[k] = False
        found, ahead = [], adjacent[k] & left
        while ahead.any():
            new = np.flatnonzero(ahead)
            left[new] = False
            found.append(new)
            ahead = adjacent[new].any(0) & left
        if found:
            others = np.concatenate(found)
            pairs.append(np.stack([np.full(len(others), k), others], 1))
    return np.concatenate(pairs)
