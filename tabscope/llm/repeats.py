"""Passages that occur more than once in a corpus, to the byte, from longest-previous-factor arrays.

A passage is ``length`` bytes. Each is assigned to an anchor, the gram inside it with the smallest hash, so equal passages
meet at equal anchors, wherever they are. Passages that follow each other with one anchor are a segment. Only anchors that
occur again are kept; equal segments are combined to one class with a count; and the distinct segments of an anchor are put
side by side into one array, whose suffix order and longest previous (and next) factors tell which of their passages
recur. An anchor with very many distinct segments is not put into one array: its passages get longer anchors, so that they
fall apart into smaller groups, and so on up to anchors as long as a passage, of which all segments are equal. So a task
holds a bounded number of segments, however often a passage occurs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscope.llm.common import batch, slices, stored, table
from tabscope.llm.near_duplicates import _groups
from tabscope.llm.suffix_arrays import factors, passage_order

#: Distinct segments of an anchor that are put into one array at most, and the symbols of an array.
SEGMENTS, SYMBOLS = 1024, 1 << 20
#: Positions that are hashed at once; a longer text is cut into overlapping pieces.
_PIECE, _POSITION = 1 << 18, np.uint64((1 << 20) - 1)
_TABLE = np.random.default_rng(5).integers(0, 1 << 64, 256, dtype=np.uint64)
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def gram_lengths(length: int) -> list[int]:
    """Bytes of an anchor, and of those that take its place where it is too common.

    First the largest power of two up to a third of a passage; then what leaves it a quarter of the room in a passage, up to
    the whole passage.
    """
    grams = [1 << max(0, (length // 3).bit_length() - 1)]
    while grams[-1] < length:
        room = (length - grams[-1] + 1) // 4
        grams.append(length - room + 1 if room >= 4 else length)
    return grams


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    h, n = _TABLE[data], 1
    while n < gram:
        step = min(n, gram - n)
        h = h[:-step] * _K1 + h[step:]
        h ^= h >> np.uint64(29)
        n += step
    return h * _K2


def anchors(data: np.ndarray, valid: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The segments of a piece: first passage, number of passages, and hash of the anchor. ``valid`` says where passages start."""
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    h = _gram_hashes(data, gram)
    least = (h & ~_POSITION) | np.arange(len(h), dtype=np.uint64)  # of equal hashes the first
    width, n = length - gram + 1, 1
    while 2 * n <= width:
        least = np.minimum(least[:-n], least[n:])
        n *= 2
    if n < width:
        least = np.minimum(least[: len(least) - (width - n)], least[width - n :])
    starts = np.flatnonzero(valid[: len(least)])
    at = (least[starts] & _POSITION).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)])) if len(at) else np.zeros(0, np.int64)
    return starts[new], np.diff(np.append(new, len(at))), h[at[new]]


def _pieces(lengths: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(first text, behind the last, from, to): whole texts up to a piece's size together, a longer one in parts that overlap."""
    k = 0
    while k < len(lengths):
        if lengths[k] > _PIECE:
            for a in range(0, int(lengths[k]) - length + 1, _PIECE - length + 1):
                yield k, k + 1, a, min(a + _PIECE, int(lengths[k]))
            k += 1
            continue
        total, first = 0, k
        while k < len(lengths) and lengths[k] <= _PIECE and total + lengths[k] <= _PIECE:
            total += int(lengths[k])
            k += 1
        yield first, k, 0, total


def segments(found: list[bytes], length: int, gram: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per piece: text, first passage in it, number of passages and anchor of every segment."""
    gram = gram or gram_lengths(length)[0]
    lengths = np.array([len(t) for t in found], np.int64)
    for first, last, a, b in _pieces(lengths, length):
        own = lengths[first:last] if last - first > 1 or a == 0 and b == lengths[first] else np.array([b - a])
        data = np.frombuffer(found[first][a:b] if last - first == 1 else b"".join(found[first:last]), np.uint8)
        begin = np.cumsum(own) - own
        which = np.repeat(np.arange(len(own)), own)
        valid = np.arange(len(data)) - begin[which] + length <= own[which]
        start, n, key = anchors(data, valid, length, gram)
        yield first + which[start], start - begin[which[start]] + a, n, key


def _counted(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.int64()), ("n", pa.int64())])
        for b in slices(batches, "__text"):
            keys = [key for _, _, _, key in segments(b.column("__text").to_pylist(), length)]
            if keys:
                key, n = np.unique(np.concatenate(keys), return_counts=True)
                yield batch(schema, key.view(np.int64), n)

    return run


_SEGMENT = pa.schema([("order", pa.int64()), ("th", pa.int64()), ("start", pa.int64()), ("n", pa.int32()), ("key", pa.int64()), ("same", pa.int64())])


def _listed(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "__text"):
            found, order, th = b.column("__text").to_pylist(), b.column("order").to_numpy(), b.column("th").to_numpy()
            for text, start, n, key in segments(found, length):
                same = [xxhash.xxh3_64_intdigest(found[t][s:e]) for t, s, e in zip(text.tolist(), start.tolist(), (start + n + length - 1).tolist(), strict=True)]
                yield batch(_SEGMENT, order[text], th[text], start, n.astype(np.int32), key.view(np.int64), np.array(same, np.uint64).view(np.int64))

    return run


_CLASS = [("key", pa.int64()), ("same", pa.int64()), ("order", pa.int64()), ("th", pa.int64()), ("start", pa.int64()), ("n", pa.int32())]
_CLASS_SQL = "key long, same long, order long, th long, start long, n int"


def _cut_out(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bytes of the wanted segments of each text."""
        schema = pa.schema([*_CLASS, ("bytes", pa.binary())])
        for b in slices(batches, "__text"):
            out = []
            for order, th, t, wanted in zip(*(b.column(c).to_pylist() for c in ("order", "th", "__text", "wanted")), strict=True):
                out += [(w["key"], w["same"], order, th, w["start"], w["n"], t[w["start"] : w["start"] + w["n"] + length - 1]) for w in wanted]
            for at in range(0, len(out), 20_000):
                yield batch(schema, *map(list, zip(*out[at : at + 20_000], strict=True)))

    return run


_MATCH = pa.schema([("key", pa.int64()), ("same", pa.int64()), ("a", pa.int32()), ("b", pa.int32()), ("earlier", pa.bool_())])


def _factored(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Passages of the segments of an anchor that recur in another segment of it, as ranges within a segment."""
        held: list[pa.Table] = []
        size = 0
        for g in _groups(batches, ["key"]):
            by = [g.column(c).to_numpy() for c in ("start", "th", "order")]
            at = np.lexsort(by)
            at = at[np.concatenate([[True], np.any([c[at][1:] != c[at][:-1] for c in by], axis=0)])]  # once, if its row is repeated
            held.append(g.take(at))
            size += held[-1].column("bytes").nbytes
            if size >= SYMBOLS:
                yield from _matches(pa.concat_tables(held), length)
                held, size = [], 0
        if held:
            yield from _matches(pa.concat_tables(held), length)

    return run


def _matches(t: pa.Table, length: int) -> Iterator[pa.RecordBatch]:
    parts, n = t.column("bytes").to_pylist(), t.column("n").to_numpy()
    symbols = np.frombuffer(b"".join(p + b"\0" for p in parts), np.uint8).astype(np.int64) + 1
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    symbols[ends] = 0  # no passage reaches beyond it
    starts = ends - np.array([len(p) for p in parts])
    passage = np.zeros(len(symbols) + 1, np.int8)
    np.add.at(passage, starts, 1)
    np.add.at(passage, starts + n, -1)
    order, shared = passage_order(symbols, np.flatnonzero(np.cumsum(passage[:-1]) > 0), length)
    # Segments of different anchors hold no equal passages, so no match leaves its anchor.
    earlier = factors(order, shared) >= length
    anywhere = earlier | (factors(order, shared, earlier=False) >= length)
    for hit, flag in ((earlier, True), (anywhere, False)):
        a, b = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))).reshape(-1, 2).T
        if len(a):
            k = np.searchsorted(starts, a, side="right") - 1
            yield batch(_MATCH, t.column("key").to_numpy()[k], t.column("same").to_numpy()[k], (a - starts[k]).astype(np.int32), (b - starts[k]).astype(np.int32), [flag] * len(a))


_PART_SQL = "key long, same long, order long, th long, start long, at int, n int, key2 long, same2 long, bytes binary"


def _parted(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Segments cut up by longer anchors."""
        schema = pa.schema([*_CLASS[:-1], ("at", pa.int32()), ("n", pa.int32()), ("key2", pa.int64()), ("same2", pa.int64()), ("bytes", pa.binary())])
        for b in slices(batches, "bytes", 1 << 20):
            found = b.column("bytes").to_pylist()
            own = {c: b.column(c).to_numpy() for c in ("key", "same", "order", "th", "start")}
            for text, at, n, key in segments(found, length, gram):
                parts = [found[t][x : x + k + length - 1] for t, x, k in zip(text.tolist(), at.tolist(), n.tolist(), strict=True)]
                same = np.array([xxhash.xxh3_64_intdigest(p) for p in parts], np.uint64).view(np.int64)
                yield batch(schema, *(own[c][text] for c in ("key", "same", "order", "th")), own["start"][text] + at, at.astype(np.int32), n.astype(np.int32), key.view(np.int64), same, parts)

    return run


def _own() -> Column:
    return F.struct("order", "th", "start")


def _ranges(first: Column, m: Column, n: Column) -> Column:
    """What a segment of a class of ``m`` equal ones makes repeat: everything, and for all but the first also what was before."""
    whole = lambda earlier: F.struct(F.lit(0).alias("a"), n.alias("b"), F.lit(earlier).alias("earlier"))
    return F.concat(F.when(m > 1, F.array(whole(False))).otherwise(F.array()), F.when((m > 1) & (_own() != first), F.array(whole(True))).otherwise(F.array()))


def _matched(cut: DataFrame, length: int, grams: list[int]) -> DataFrame:
    """Passages that recur in another segment of the anchor (key, same, a, b, earlier), of the distinct segments of each anchor."""
    counts = cut.groupBy("key").agg(F.count("*").alias("c"))
    few = cut.join(counts.where((F.col("c") > 1) & (F.col("c") <= SEGMENTS)).select("key"), "key")
    matches = few.select("key", "same", "order", "th", "start", "n", "bytes").repartition("key").sortWithinPartitions("key").mapInArrow(_factored(length), "key long, same long, a int, b int, earlier boolean")
    many = cut.join(counts.where(F.col("c") > SEGMENTS).select("key"), "key")
    if not grams or many.isEmpty():
        return matches
    parts = many.select("key", "same", "order", "th", "start", "bytes").mapInArrow(_parted(length, grams[0]), _PART_SQL)
    parts = stored(parts)
    again = parts.groupBy("key2").agg(F.count("*").alias("c")).where("c > 1").select("key2")
    parts = parts.join(again, "key2")
    classes = parts.groupBy("key2", "same2").agg(F.min(_own()).alias("first"), F.count("*").alias("m"), F.first("n").alias("n"), F.first("bytes").alias("bytes"))
    classes = stored(classes)
    inner = _matched(classes.select(F.col("key2").alias("key"), F.col("same2").alias("same"), "first.order", "first.th", "first.start", "n", "bytes"), length, grams[1:])
    inner = inner.groupBy(F.col("key").alias("key2"), F.col("same").alias("same2")).agg(F.collect_list(F.struct("a", "b", "earlier")).alias("ranges"))
    found = classes.select("key2", "same2", "first", "m").join(inner, ["key2", "same2"], "left").where("m > 1 OR ranges IS NOT NULL")
    here = parts.select("key", "same", "order", "th", "start", "at", "n", "key2", "same2").join(found, ["key2", "same2"])
    ranges = F.concat(_ranges(F.col("first"), F.col("m"), F.col("n")), F.coalesce("ranges", F.array()))
    apart = here.select("key", "same", "at", F.explode(ranges).alias("r")).select("key", "same", (F.col("at") + F.col("r.a")).alias("a"), (F.col("at") + F.col("r.b")).alias("b"), "r.earlier")
    return matches.unionByName(apart)


def _rows(docs: DataFrame, id_col: str, text_col: str, keep: list[str]) -> DataFrame:
    """Texts with what identifies them in every scan: the id as a number (of another type: its hash) and a hash of the text."""
    number = F.col(id_col).cast("long") if docs.schema[id_col].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint") else F.xxhash64(id_col)
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    return docs.select(
        *[F.col(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(keep)],
        F.coalesce(number, F.lit(-(1 << 63))).alias("order"), F.xxhash64(text).alias("th"), text.alias("__text"),
    )


def find_repeats(rows: DataFrame, length: int) -> DataFrame:
    """Per text of ``rows`` that holds any: ``spans``, ranges of starts of passages (a, b, earlier).

    With ``earlier`` false, the passages that also start anywhere else; with it true, those that also start before, in an
    earlier document or further ahead in the same one.
    """
    texts_ = rows.select("order", "th", "__text")
    again = rows.select("__text").mapInArrow(_counted(length), "key long, n long").groupBy("key").agg(F.sum("n").alias("c")).where("c > 1").select("key")
    kept = stored(texts_.mapInArrow(_listed(length), "order long, th long, start long, n int, key long, same long").join(again, "key"))
    classes = kept.groupBy("key", "same").agg(F.min(F.struct("order", "th", "start")).alias("first"), F.count("*").alias("m"), F.min("n").alias("n"))
    classes = stored(classes)
    several = classes.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")

    wanted = (
        classes.join(several, "key")
        .groupBy(F.col("first.order").alias("order"), F.col("first.th").alias("th"))
        .agg(F.collect_list(F.struct("key", "same", "first.start", "n")).alias("wanted"))
    )
    cut = stored(texts_.join(wanted, ["order", "th"]).select("order", "th", "__text", "wanted").mapInArrow(_cut_out(length), f"{_CLASS_SQL}, bytes binary"))
    matches = _matched(cut, length, gram_lengths(length)[1:])

    ranges = matches.groupBy("key", "same").agg(F.collect_list(F.struct("a", "b", "earlier")).alias("ranges"))  # at most one for each passage
    found = classes.join(ranges, ["key", "same"], "left").where("m > 1 OR ranges IS NOT NULL").select("key", "same", "m", "first", "ranges")
    spans = F.concat(_ranges(F.col("first"), F.col("m"), F.col("n")), F.coalesce("ranges", F.array()))
    placed = kept.join(found, ["key", "same"]).select("order", "th", F.transform(spans, lambda r: F.struct((r["a"] + F.col("start")).alias("a"), (r["b"] + F.col("start")).alias("b"), r["earlier"].alias("earlier"))).alias("spans"))
    return placed.groupBy("order", "th").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def covered(spans: pa.Array, length: int, earlier: bool) -> Iterator[list[tuple[int, int]]]:
    """Per row, the maximal runs of bytes that the passages cover."""
    spans = spans.combine_chunks() if isinstance(spans, pa.ChunkedArray) else spans
    sizes = pc.fill_null(pc.list_value_length(spans), 0).to_numpy().astype(np.int64)
    flat = spans.flatten()
    a, b = flat.field("a").to_numpy(zero_copy_only=False), flat.field("b").to_numpy(zero_copy_only=False) + length - 1
    mine = flat.field("earlier").to_numpy(zero_copy_only=False) == earlier
    row = np.repeat(np.arange(len(sizes)), sizes)[mine]
    order = np.lexsort([a[mine], row])
    row, a, b = row[order], a[mine][order], b[mine][order]
    edges = np.searchsorted(row, np.arange(len(sizes) + 1))
    for s, e in zip(edges.tolist(), edges[1:].tolist(), strict=False):
        if s == e:
            yield []
            continue
        reach = np.maximum.accumulate(b[s:e])
        first = np.flatnonzero(np.concatenate([[True], a[s + 1 : e] > reach[:-1]]))
        yield list(zip(a[s:e][first].tolist(), reach[np.append(first[1:] - 1, e - s - 1)].tolist(), strict=True))


def _removed(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for a, b in runs:
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]])


def _whole_characters(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs, less the parts of characters at their ends."""
    out = []
    for a, b in runs:
        while a < b and text[a] & 0xC0 == 0x80:
            a += 1
        while a < b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        out.append((a, b))
    return out


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, earlier: bool = False) -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal runs) and ``kept_sha256`` of what is left of the UTF-8 bytes.

    Removed is every byte of a passage of ``length`` bytes that also starts anywhere else in the corpus, or, with
    ``earlier``, before. Null texts are empty and lose nothing, as do texts shorter than a passage. Rows of equal id and
    text are copies of each other, but count as one document where the first copy stays. An empty table gives none.
    """
    rows = _rows(docs, id_col, text_col, [id_col])
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "__text"):
            removed, n, digests = [], [], []
            for text, runs in zip(b.column("__text").to_pylist(), covered(b.column("spans"), length, earlier), strict=True):
                removed.append(sum(y - x for x, y in runs))
                n.append(len(runs))
                digests.append(hashlib.sha256(_removed(text, runs)).hexdigest())
            size = pa.array([len(t) for t in b.column("__text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("__k0"), size, pa.array(removed, pa.int64()), pa.array(n, pa.int64()), pa.array(digests, pa.string())], names=["__k0", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    joined = rows.join(find_repeats(rows, length), ["order", "th"], "left").select("__k0", "__text", "spans")
    return joined.mapInArrow(run, f"__k0 {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string").withColumnRenamed("__k0", id_col)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200) -> DataFrame:
    """``docs`` with all columns, where every passage of ``length`` bytes stays at its first place only.

    The first place is that of the smallest id. Removed runs are cut back to whole characters. Texts that lose nothing, nulls
    among them, stay as they are; rows stay in number.
    """
    keep = [c for c in docs.columns if c != text_col]
    rows = _rows(docs, id_col, text_col, [*keep, text_col])
    last = f"__k{len(keep)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "__text"):
            out = []
            for text, runs, was in zip(b.column("__text").to_pylist(), covered(b.column("spans"), length, True), b.column("__null").to_pylist(), strict=True):
                runs = _whole_characters(text, runs)
                out.append(None if was else _removed(text, runs).decode())
            names = [n for n in b.schema.names if n not in ("__text", "spans", "__null")]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(out, pa.string())], names=[*names, last])

    plain = rows.withColumn("__null", F.col(last).isNull()).drop(last)
    joined = plain.join(find_repeats(rows, length), ["order", "th"], "left").drop("order", "th")
    kinds = "".join(f"__k{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep))
    cleaned = joined.mapInArrow(run, f"{kinds}{last} string").toDF(*keep, text_col)
    return cleaned.select(*[F.col(f"`{c}`") for c in docs.columns])


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(table(spark, sf_dir, "documents"))
