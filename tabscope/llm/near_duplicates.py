"""Near-duplicate documents: MinHash bands find candidates, odd sketches weigh them, full shingle sets decide.

Documents of equal shingle sets are one class and only its representative is compared. Candidates share a band of
MinHash samples. The samples are also folded into an odd sketch, a bitmap of parities: the population count of the XOR of
two sketches estimates how many samples differ, precisely where similarity is high, so most candidates fall without their
sets being read. What is left is decided on the full sets.

No bucket is compared pair by pair. First every member is held against one leader of each of its buckets, and
linked documents become components. Then only buckets that still hold several components are looked at. Their members outside
the bucket's largest component are held against all its members, in blocks of bounded size: sketches choose the members that may have
a link into another component, their sets join them in the block, and a block emits only links that join components
not joined there before. So each link between two components is found, whatever the size of a bucket, and no
row stands for a pair before it is confirmed.

A pair of similarity s shares no band with probability (1 - s^4)^32: 5e-8 at 0.8. A sketch rejects such a pair less often still.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscope.llm.common import ROW, batch, slices, stored, table, texts
from tabscope.llm.components import components

BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
#: Bits of an odd sketch, and the most that may differ: 128 samples of sets of similarity 0.55 differ in 76 on average.
BITS, MOST = 256, 76
#: Rows of a bucket or component that are held together in a task at most.
BLOCK = 1024
_KEPT = 300_000

_random = np.random.default_rng(20240229)
_A = (_random.integers(0, 1 << 32, SAMPLES, dtype=np.uint32) | np.uint32(1))[:, None]
_B = _random.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)[:, None]
_C = _random.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)
_K1, _K2, _K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


class _Hashes(dict):
    """Hashes of words, kept for as many as there is room for."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < _KEPT:
            self[word] = value
        return value


_hashes = _Hashes()


def shingles(text: bytes, size: int = 2) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text: ``size`` words each, or all of them where there are fewer.

    Words are runs of other bytes than white space, A-Z made lower case.
    """
    found = text.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found))
    n = min(size, len(h))
    code = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        code = (code + h[k : len(h) - n + 1 + k]) * _K1
        code ^= code >> np.uint64(29)
    code *= _K2
    code ^= code >> np.uint64(32)
    return np.unique(code)


def samples(sets: list[np.ndarray]) -> np.ndarray:
    """The MinHash samples of sets that aren't empty."""
    out = np.empty((len(sets), SAMPLES), np.uint32)
    for k, s in enumerate(sets):
        low, best = s.astype(np.uint32), None
        for at in range(0, len(low), 4096):
            part = (_A * low[at : at + 4096] + _B).min(1)
            best = part if best is None else np.minimum(best, part)
        out[k] = best
    return out


def bands(sampled: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band, other for equal samples of other bands."""
    key = np.full((len(sampled), BANDS), 0, np.uint64) + np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        key = (key + sampled[:, k::ROWS]) * _K1
        key ^= key >> np.uint64(31)
    key = key * _K3
    return (key ^ (key >> np.uint64(33))).view(np.int64)


def odd_sketches(sampled: np.ndarray) -> np.ndarray:
    """Parity bitmaps of the samples, as four 64-bit words each."""
    bit = ((sampled ^ _C) * np.uint32(0x85EBCA6B)) >> np.uint32(24)
    flat = np.bincount((np.arange(len(sampled))[:, None] * BITS + bit).ravel(), minlength=len(sampled) * BITS) & 1
    return np.packbits(flat.reshape(-1, BITS).astype(np.uint8), axis=1).view(np.int64)


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which each sketch of a differs from each of b."""
    return np.bitwise_count((a[:, None] ^ b[None]).view(np.uint64)).sum(2)  # of signed numbers it counts the absolute value


def similar(common: np.ndarray, a: int, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * common >= percent * (a + b - common)


_SKETCH = [f"__s{k}" for k in range(BITS // 64)]


def _features(id_col: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "__text", 2 << 20):
            sets = [shingles(t, size) for t in b.column("__text").to_pylist()]
            full = [k for k, s in enumerate(sets) if len(s)]
            digests = np.zeros((len(sets), 2), np.int64)
            keys, sketch = np.zeros((len(sets), BANDS), np.int64), np.zeros((len(sets), BITS // 64), np.int64)
            if full:
                digests[full] = [np.frombuffer(xxhash.xxh3_128_digest(sets[k].tobytes()), np.int64) for k in full]
                sampled = samples([sets[k] for k in full])
                keys[full], sketch[full] = bands(sampled), odd_sketches(sampled)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * BANDS, pa.int32()), pa.array(keys.ravel()))
            columns = {ROW: b.column(ROW), id_col: b.column(id_col), "__th": b.column("__th"), "n_shingles": pa.array(map(len, sets), pa.int64()), "__h0": pa.array(digests[:, 0]), "__h1": pa.array(digests[:, 1]), "__bands": lists}
            columns |= {name: pa.array(sketch[:, k]) for k, name in enumerate(_SKETCH)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "__text"):
            sets = pa.array([shingles(t, size).tobytes() for t in b.column("__text").to_pylist()], pa.binary())
            names = ["node", *_SKETCH]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), sets], names=[*names, "set"])

    return run


def _few_bits(a: list[Column], b: list[Column]) -> Column:
    return sum((F.bit_count(x.bitwiseXOR(y)) for x, y in zip(a, b, strict=True)), F.lit(0)) <= MOST


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str], most: int = 64 << 20) -> Iterator[pa.RecordBatch]:
    """Whole groups of rows sorted by ``keys``, one after the other; a group is of bounded size."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        t = pa.Table.from_batches(held).combine_chunks()
        k = np.stack([t.column(c).to_numpy() for c in keys], 1)
        cuts = np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1
        edges = [0, *cuts.tolist()]
        for x, y in zip(edges, edges[1:], strict=False):
            yield t.slice(x, y - x)
        held = t.slice(edges[-1]).to_batches()
    if held:
        yield pa.Table.from_batches(held)


_CLOSE = "key long, i int, j int, node long, root long, minor boolean"


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one block of a bucket: the nodes whose sketch is close to one of another component on the other side."""
    names = [x.split()[0] for x in _CLOSE.split(", ")]
    for g in _groups(batches, ["key", "i", "j"]):
        minor = g.column("minor").to_numpy(zero_copy_only=False)
        root = g.column("root").to_numpy()
        sketch = np.stack([g.column(c).to_numpy() for c in _SKETCH], 1)
        a, b = np.flatnonzero(minor), np.flatnonzero(~minor)
        hit = np.zeros(len(minor), bool)
        for at in range(0, len(a), 256):
            some = a[at : at + 256]
            near = (differing(sketch[some], sketch[b]) <= MOST) & (root[some][:, None] != root[b][None])
            hit[some] = near.any(1)
            hit[b] |= near.any(0)
        if hit.any():
            yield from g.select(names).filter(pa.array(hit)).combine_chunks().to_batches()


def _joining(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of one block of a bucket: links between roots, on full sets, each of which joins two components for the first time there."""
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for g in _groups(batches, ["key", "i", "j"]):
            minor = g.column("minor").to_numpy(zero_copy_only=False)
            root = g.column("root").to_numpy()
            label = root.copy()
            sets = [np.frombuffer(s, np.uint64) for s in g.column("set").to_pylist()]
            sizes = np.array([len(s) for s in sets])
            sketch = np.stack([g.column(c).to_numpy() for c in _SKETCH], 1)
            others = np.flatnonzero(~minor)
            links = []
            for p in np.flatnonzero(minor).tolist():
                own = sets[p]
                n = sizes[others]
                near = others[(differing(sketch[p : p + 1], sketch[others])[0] <= MOST) & (100 * np.minimum(n, len(own)) >= percent * np.maximum(n, len(own))) & (label[others] != label[p])]
                if not len(near):
                    continue
                some, n = np.concatenate([sets[k] for k in near]), sizes[near]
                common = np.add.reduceat(own[np.minimum(np.searchsorted(own, some), len(own) - 1)] == some, np.cumsum(n) - n, dtype=np.int64)
                for k in near[similar(common, len(own), n, percent)].tolist():
                    if label[k] != label[p]:
                        links.append((int(root[p]), int(root[k])))
                        label[label == label[k]] = label[p]
            if links:
                yield batch(schema, *map(list, zip(*links, strict=True)))

    return run


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of one block of a group: the links between its probes and its other nodes, on full sets."""
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for g in _groups(batches, ["group", "block"]):
            probe = g.column("probe").to_numpy(zero_copy_only=False)
            node = g.column("node").to_numpy()
            sets = [np.frombuffer(s, np.uint64) for s in g.column("set").to_pylist()]
            targets = np.flatnonzero(~probe)
            if not len(targets):
                continue
            sizes = np.array([len(sets[k]) for k in targets])
            sketch = np.stack([g.column(c).to_numpy() for c in _SKETCH], 1)
            for p in np.flatnonzero(probe).tolist():
                own = sets[p]
                near = np.flatnonzero((differing(sketch[p : p + 1], sketch[targets])[0] <= MOST) & (100 * np.minimum(sizes, len(own)) >= percent * np.maximum(sizes, len(own))))
                if not len(near):
                    continue
                some = np.concatenate([sets[k] for k in targets[near]])
                starts = np.cumsum(sizes[near]) - sizes[near]
                common = np.add.reduceat(own[np.minimum(np.searchsorted(own, some), len(own) - 1)] == some, starts, dtype=np.int64)
                hit = targets[near[similar(common, len(own), sizes[near], percent)]]
                if len(hit):
                    yield batch(schema, [int(node[p])] * len(hit), node[hit])

    return run


def _verified(wanted: DataFrame, targets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the probes of a group (group, node) and its targets (group, node), in blocks of targets."""
    blocks = targets.groupBy("group").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    out = targets.join(blocks, "group").select("group", F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block"), "node", F.lit(False).alias("probe"))
    many = wanted.join(blocks, "group").select("group", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "node", F.lit(True).alias("probe"))
    return (
        out.unionByName(many).join(sets, "node")
        .repartition("group", "block").sortWithinPartitions("group", "block")
        .select("group", "block", "node", "probe", "set", *_SKETCH)
        .mapInArrow(_linked(percent), "a long, b long")
    )


def _may_join(placed: DataFrame, sketches: DataFrame) -> DataFrame:
    """Rows of ``placed`` (key, node, root) that may have a link into another component, by blocks (i, j) of their bucket.

    Members outside the largest component of a bucket are the ``minor`` side of its blocks, all members are the other side.
    """
    mixed = (
        placed.groupBy("key", "root").agg(F.count("*").alias("n"))
        .groupBy("key").agg(F.sum("n").alias("n"), F.count("*").alias("roots"), F.max(F.struct("n", "root")).alias("major"))
        .where("roots > 1")
        .select("key", F.col("major.root").alias("major"), F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"), F.ceil((F.col("n") - F.col("major.n")) / BLOCK).cast("int").alias("minors"))
    )
    held = stored(placed.join(mixed, "key").join(sketches, "node"))
    at = lambda n: F.pmod(F.xxhash64("node", F.lit(1)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = ["key", "node", "root", *_SKETCH]
    one = held.where("root != major").select(*own, F.lit(True).alias("minor"), at("minors").alias("i"), every("blocks").alias("j"))
    two = held.select(*own, F.lit(False).alias("minor"), every("minors").alias("i"), at("blocks").alias("j"))
    return one.unionByName(two).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_close, _CLOSE)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with all columns, of each group of ``near_duplicates`` the document of the smallest id alone.

    Rows of equal id and text are one document and stay once; a document without an id stays if no other is linked with it.
    """
    others = [c for c in docs.columns if c != id_col]
    text_hash = F.xxhash64(F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")))
    once = docs.groupBy(F.col(id_col).alias("__id"), text_hash.alias("__th")).agg(*[F.first(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(others)])
    found = near_duplicates(docs, id_col, text_col, size, percent, text_hash=True).where(F.col(id_col).eqNullSafe(F.col("component_id")))
    kept = found.groupBy("component_id", "root").agg(F.min("__th").alias("th")).select(F.col("component_id").alias("id"), "th")
    rows = once.join(kept.distinct(), once["__id"].eqNullSafe(kept["id"]) & (once["__th"] == kept["th"]), "left_semi")
    return rows.toDF(id_col, "__th", *others).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80, text_hash: bool = False) -> DataFrame:
    """Per row of ``docs``: id, ``n_shingles`` and ``component_id``, the smallest id among all documents it is linked with, directly or through others.

    Two documents are linked if their sets of ``size``-word shingles have at least ``percent`` of their union in common.
    Null and empty texts have no shingles and are linked with nothing: their component is their own id. Rows with equal or
    null ids are documents of their own; a component of null ids alone has none. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = texts(docs, id_col, text_col).withColumn("__th", F.xxhash64("__text"))
    kind = docs.schema[id_col].dataType.simpleString()
    features = stored(rows.mapInArrow(_features(id_col, size), f"{ROW} long, `{id_col}` {kind}, __th long, n_shingles long, __h0 long, __h1 long, __bands array<bigint>, " + ", ".join(f"{s} long" for s in _SKETCH)))
    classes = stored(
        features.where("n_shingles > 0").groupBy("__h0", "__h1")
        .agg(F.min(F.struct(ROW, F.col(id_col).alias("id"), "__th")).alias("first"), *[F.first(c).alias(c) for c in ("__bands", *_SKETCH)])
        .select("__h0", "__h1", F.col(f"first.{ROW}").alias("node"), "first.id", "first.__th", "__bands", *_SKETCH)
    )
    sketches = classes.select("node", *_SKETCH)
    keyed = classes.select("node", F.explode("__bands").alias("key"))
    leaders = keyed.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("n")).where("n > 1")
    members = stored(keyed.join(leaders.select("key", "leader"), "key"))

    needed = members.select("node").distinct().join(classes.select("node", "id", "__th", *_SKETCH), "node")
    source = rows.select(F.col(id_col).alias("__id"), "__th", "__text")
    found = source.join(needed, (source["__th"] == needed["__th"]) & source["__id"].eqNullSafe(needed["id"]))
    sets = stored(found.select("node", *_SKETCH, "__text").mapInArrow(_sets(size), "node long, " + "".join(f"{s} long, " for s in _SKETCH) + "set binary"))

    one = members.where("node != leader").select("leader", "node").distinct().join(sketches, "node")
    two = sketches.select(F.col("node").alias("leader"), *[F.col(s).alias(f"{s}l") for s in _SKETCH])
    pairs = stored(one.join(two, "leader").where(_few_bits([F.col(s) for s in _SKETCH], [F.col(f"{s}l") for s in _SKETCH])).select(F.col("leader").alias("group"), "node"))
    first = components(_verified(pairs.select("group", F.col("group").alias("node")).distinct(), pairs, sets, percent))

    placed = stored(members.select("key", "node").join(first, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root")))
    close = stored(_may_join(placed, sketches))
    held = close.join(sets, "node").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    more = held.select("key", "i", "j", "node", "root", "minor", "set", *_SKETCH).mapInArrow(_joining(percent), "a long, b long")

    final = components(first.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
    nodes = classes.select("__h0", "__h1", "node").join(final, "node", "left").select("__h0", "__h1", F.coalesce("root", "node").alias("root"))
    marked = features.select(ROW, id_col, "__th", "n_shingles", "__h0", "__h1").join(nodes, ["__h0", "__h1"], "left")
    # A row without shingles is alone, also where another has the digest that stands for none.
    marked = stored(marked.select(F.col(id_col), "__th", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("root")).otherwise(F.col(ROW)).alias("root")))
    least = stored(marked.groupBy("root").agg(F.min(id_col).alias("component_id")))
    return marked.join(least, "root").select(id_col, "n_shingles", "component_id", *(["root", "__th"] if text_hash else []))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


OP8_SQL = """
WITH RECURSIVE cut AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) = 1 THEN ws[1] ELSE ws[k] || ' ' || ws[k + 1] END AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 1) + 1)) AS k FROM cut WHERE len(ws) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM (SELECT x.doc_id AS p, y.doc_id AS q, count(*) AS c FROM shingles x JOIN shingles y USING (s) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN sizes a ON a.doc_id = p JOIN sizes b ON b.doc_id = q
  WHERE 100 * c >= 80 * (a.n + b.n - c)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
), least AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""
