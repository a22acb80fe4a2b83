"""Near-duplicate documents by SimHash: fingerprints of 64 bits, linked where few of them differ.

Two fingerprints that differ in at most 4 bits have at least 4 of their 8 bytes in common, each at its position. The inverted
index holds a fingerprint under bytes at three positions together. There are 20 such triples, chosen so that any four
positions hold one of them, so two fingerprints with four bytes in common meet in at least one posting list. There
the bytes that each pair shares are tallied, pairs that reach the guaranteed minimum are kept, and their bits are counted.

Equal fingerprints are one entry. A long posting list is dealt into blocks by a checksum, and a block emits no pairs, only a
star of links for each connected group that it finds. Once these links have become components, only lists whose entries still
belong to several components are looked at again: those outside the largest component against all others, block by block.
So no link between different components is lost, and rows grow with the entries of a list, not with their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscope.llm.common import slices, stored, table, texts
from tabscope.llm.components import components, spanning

BYTES, SEED = 8, 42
#: Entries of a posting list that are held together in a task, about.
BLOCK = 1024
_LANES = np.uint64(0x0101010101010101)


def fingerprints(found: list[bytes], size: int = 4) -> np.ndarray:
    """A 64-bit fingerprint for each text: bits set in over half of the hashes of its shingles; 0 without words.

    A shingle is ``size`` words joined by a space, or all words of a shorter text, A-Z made lower case, repeats included.
    """
    hashes: list[int] = []
    counts = np.zeros(len(found), np.int64)
    for k, text in enumerate(found):
        words = text.lower().split()
        if not words:
            continue
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = [0, *(ends[:-1] + 1).tolist()]
        n = min(size, len(words))
        counts[k] = len(words) - n + 1
        hashes += [xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts, ends[n - 1 :].tolist(), strict=False)]
    out = np.zeros(len(found), np.uint64)
    filled = np.flatnonzero(counts)
    if not len(filled):
        return out
    h, n = np.array(hashes, np.uint64), counts[filled]
    # Byte counters hold up to 255, so the hashes of a text are added up in parts of so many.
    parts = -(-n // 255)
    begins = np.cumsum(n) - n
    first = np.cumsum(parts) - parts
    at = np.repeat(begins, parts) + 255 * (np.arange(parts.sum()) - np.repeat(first, parts))
    for bit in range(8):
        lanes = np.add.reduceat((h >> np.uint64(bit)) & _LANES, at)
        totals = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        for byte in range(8):
            out[filled] |= (2 * totals[:, byte] > n).astype(np.uint64) << np.uint64(8 * byte + bit)
    return out


def triples(positions: int = BYTES) -> list[tuple[int, int, int]]:
    """Triples of positions such that any four positions hold one of them.

    Positions are dealt into three classes in a ring; triples lie in one class, or two of them in a class and one in the next.
    """
    kind = [k * 3 // positions for k in range(positions)]
    wanted = []
    for t in combinations(range(positions), 3):
        c = sorted(kind[k] for k in t)
        if c[0] == c[2] or any(c.count(x) == 2 and (x + 1) % 3 in c for x in set(c)):
            wanted.append(t)
    return wanted


def _posting_keys(fingerprint: Column) -> Column:
    def byte(k: int) -> Column:
        return F.shiftrightunsigned(fingerprint, 8 * k).bitwiseAND(F.lit(255))

    return F.array(*[F.lit(i << 24) + byte(a) * 65536 + byte(b) * 256 + byte(c) for i, (a, b, c) in enumerate(triples())])


def _near(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Which pairs share the bytes that so few differing bits guarantee, and differ in no more bits."""
    apart = np.ascontiguousarray(a ^ b).view(np.uint64)  # of signed numbers, bits of the absolute value would be counted
    tally = (apart.view(np.uint8).reshape(*apart.shape, BYTES) == 0).sum(-1, dtype=np.uint8)
    near = tally >= BYTES - most
    near[near] = np.bitwise_count(apart[near]) <= most
    return near


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups of rows sorted by ``keys``, with the bounds of the groups in each."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        t = pa.Table.from_batches(held).combine_chunks()
        k = np.stack([t.column(c).to_numpy() for c in keys], 1)
        edges = np.concatenate([[0], np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1])
        if len(edges) > 1:
            yield t.slice(0, int(edges[-1])), edges
        held = t.slice(int(edges[-1])).to_batches()
    if held:
        t = pa.Table.from_batches(held).combine_chunks()
        k = np.stack([t.column(c).to_numpy() for c in keys], 1)
        yield t, np.concatenate([[0], np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1, [len(k)]])


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _linked(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Stars of links between the entries of each block of a posting list."""
        for t, edges in _grouped(batches, ["key", "block"]):
            entry = t.column("fp").to_numpy()
            n = np.diff(edges)
            out: list[np.ndarray] = []
            for size in np.unique(n[n > 1]).tolist():
                at = edges[:-1][n == size][:, None] + np.arange(size)
                if size <= 8:  # many small groups at once; pairs in a row, which keep what connects
                    x, y = np.triu_indices(size, 1)
                    near = _near(entry[at[:, x]], entry[at[:, y]], most)
                    g, p = np.nonzero(near)
                    out.append(np.stack([entry[at[g, x[p]]], entry[at[g, y[p]]]], 1))
                    continue
                for group in entry[at]:
                    adjacent = np.concatenate([_near(group[k : k + 256, None], group[None], most) for k in range(0, size, 256)])
                    out.append(group[spanning(adjacent)])
            found = np.concatenate([np.zeros((0, 2), np.int64), *out])
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], schema=_LINKS)

    return run


def _crossed(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links between components, from entries outside a list's largest component and others of the list: one row per joined pair."""
        for t, edges in _grouped(batches, ["key", "i", "j"]):
            entry, root, minor = (t.column(c).to_numpy(zero_copy_only=False) for c in ("fp", "root", "minor"))
            for x, y in zip(edges.tolist(), edges[1:].tolist(), strict=False):
                roots, number = np.unique(root[x:y], return_inverse=True)
                probe = minor[x:y]
                a, b = np.flatnonzero(probe), np.flatnonzero(~probe)
                adjacent = np.zeros((len(roots), len(roots)), bool)
                for k in range(0, len(a), 256):
                    p, q = np.nonzero(_near(entry[x:y][a[k : k + 256]][:, None], entry[x:y][b][None], most))
                    adjacent[number[a[k + p]], number[b[q]]] = True
                found = roots[spanning(adjacent | adjacent.T)]
                if len(found):
                    yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], schema=_LINKS)

    return run


def _features(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "__text", 4 << 20):
            found = fingerprints(b.column("__text").to_pylist(), size).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("__id"), pa.array(found)], names=["__id", "fp"])

    return run


def fingerprint_components(entries: DataFrame, most: int = 4) -> DataFrame:
    """``fp, root`` for the distinct fingerprints ``fp`` of ``entries`` that are linked with another: ``root`` is one of their component."""
    if not 0 <= most <= 4:
        raise ValueError("posting lists meet all pairs that differ in up to 4 bits")
    keyed = entries.select("fp", F.explode(_posting_keys(F.col("fp"))).alias("key"))
    lists = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    met = stored(keyed.join(lists, "key"))
    at = F.pmod(F.xxhash64("fp", "key"), F.col("blocks")).cast("int")
    dealt = met.select("key", "fp", at.alias("block")).repartition("key", "block").sortWithinPartitions("key", "block")
    first = stored(components(dealt.mapInArrow(_linked(most), "a long, b long")).select(F.col("node").alias("fp"), "root"))

    own = met.where("blocks > 1").join(first, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    placed = stored(own)
    mixed = (
        placed.groupBy("key", "root").agg(F.count("*").alias("n"))
        .groupBy("key").agg(F.sum("n").alias("n"), F.count("*").alias("roots"), F.max(F.struct("n", "root")).alias("major"))
        .where("roots > 1")
        .select("key", F.col("major.root").alias("major"), F.ceil((F.col("n") - F.col("major.n")) / BLOCK).cast("int").alias("minors"))
    )
    held = stored(placed.join(mixed, "key").withColumn("at", F.xxhash64("fp", F.lit(1))))
    if held.isEmpty():
        return first
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    row = ["key", "fp", "root"]
    probes = held.where("root != major").select(*row, F.lit(True).alias("minor"), F.pmod("at", "minors").cast("int").alias("i"), every("blocks").alias("j"))
    others = held.select(*row, F.lit(False).alias("minor"), every("minors").alias("i"), F.pmod("at", "blocks").cast("int").alias("j"))
    more = probes.unionByName(others).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_crossed(most), "a long, b long")
    links = first.select(F.col("fp").alias("a"), F.col("root").alias("b")).unionByName(more)
    return components(links).select(F.col("node").alias("fp"), "root")


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, most: int = 4) -> DataFrame:
    """Per row of ``docs``: id, ``fingerprint`` as 16 hexadecimal digits, and ``component_id``.

    Documents are linked whose fingerprints differ in at most ``most`` bits (0 to 4); ``component_id`` is the smallest id among all
    that a document is linked with, directly or through others, itself included. Null and empty texts have no words
    and fingerprint zero, and are linked like any other. Rows of equal or null ids are documents of their own; a component of
    null ids alone has none. An empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = texts(docs, id_col, text_col).select(F.col(id_col).alias("__id"), "__text")
    features = stored(rows.mapInArrow(_features(size), f"__id {kind}, fp long"))
    classes = stored(features.groupBy("fp").agg(F.min("__id").alias("least")))
    roots = classes.join(fingerprint_components(classes.select("fp"), most), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    placed = stored(roots)
    least = stored(placed.groupBy("root").agg(F.min("least").alias("component_id")))
    named = stored(placed.select("fp", "root").join(least, "root").select("fp", "component_id"))
    text = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return features.join(named, "fp").select(F.col("__id").alias(id_col), text.alias("fingerprint"), "component_id")


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"))
