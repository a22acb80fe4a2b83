"""Phrases of words that stand together more often than apart, by SETM: relations of occurrences, joined, counted and cut.

An occurrence is a chunk of documents, a position there and the number of a frequent phrase. The occurrences of one length are
persisted in order of position, a chunk in a row, where every break between pieces takes a position of its own. They are
merge-joined with themselves on the next position, which extends phrases by a word; the resulting groups are counted, first
in the chunk and then over all chunks; and only occurrences of frequent groups are kept before the next length.

Groups are dealt over parts by a checksum. A chunk sends each part its groups there, sorted, with their counts, however
frequent they are; the part adds up, and sends back to each chunk which of its groups are frequent. So no task holds more
than a chunk or a part, and a phrase that is everywhere is no more than one entry for each chunk.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabscope.llm.common import slices, stored, table

#: Bytes of text in a chunk, or one document.
CHUNK = 16 << 20
#: Parts of a language whose leading phrases are found apart, before those of all parts.
PARTS = 256
#: Groups to count in a part, for each shuffle partition so many parts, and entries of a part at most on average.
SPREAD, ENTRIES = 4, 2_000_000
_UNKNOWN = "und"
#: Lower-cases A-Z, and turns what ends a piece into a full stop, which no word holds.
_FOLD = bytes(46 if b in b".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))


class _Numbers(dict):
    """Numbers of words in their order of appearance; 0 is the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        self[word] = value = len(self)
        return value


def tokens(text: bytes) -> list[bytes]:
    """The words of a text, and a full stop wherever a piece ends."""
    return text.translate(_FOLD).replace(b".", b" . ").split()


def compact(codes: np.ndarray) -> np.ndarray:
    """The numbers without zeros after zeros, which changes nothing about what is adjacent."""
    if not len(codes):
        return codes
    keep = codes > 0
    keep[1:] |= codes[:-1] > 0
    return codes[keep]


def adjacent(codes: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Joins the occurrences of known phrases with those at the next position.

    ``codes`` has the phrase at each position, ``known`` the places of frequent ones. Returns the places in ``known`` of
    both phrases of each group, how often each occurs, and the number of the group, from 1, at each position.
    """
    number = np.zeros(int(codes.max(initial=0)) + 1, np.int64)
    number[known] = np.arange(1, len(known) + 1)
    at = number[codes]
    both = np.flatnonzero((at[:-1] > 0) & (at[1:] > 0))
    width = len(known) + 1
    groups, inverse, counts = np.unique(at[both] * width + at[both + 1], return_inverse=True, return_counts=True)
    out = np.zeros(max(len(at) - 1, 0), np.int32)
    out[both] = inverse.astype(np.int32) + 1
    return groups // width - 1, groups % width - 1, counts, compact(out)


def pack(first: np.ndarray, *more: np.ndarray) -> bytes:
    """Columns of integers, the first in ascending order, as compressed bytes: those of one significance next to each other."""
    columns = [np.diff(first, prepend=first.dtype.type(0)), *more]
    return zstandard.compress(b"".join(np.ascontiguousarray(c.astype(np.int64).view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns), 1)


def unpack(data: bytes, columns: int) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(columns, 8, -1)
    first, *more = (np.ascontiguousarray(p.T).view(np.int64).ravel() for p in planes)
    return [np.cumsum(first), *more]


def _pack_codes(codes: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(codes.astype(np.int32).view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _unpack_codes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1).T).view(np.int32).ravel()


def _ordered(part: np.ndarray, parts: int, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of groups by part, where each part begins, and the codes (from 1) of the groups in that order."""
    order = np.argsort(part, kind="stable")
    number = np.zeros(len(part) + 1, np.int32)
    number[order + 1] = np.arange(1, len(part) + 1)
    return order, np.searchsorted(part[order], np.arange(parts + 1)), number[codes]


_RELATION = "chunk long, lang string, part int, base int, words binary, groups binary, n long, codes binary"
_FIELDS = pa.schema([("chunk", pa.int64()), ("lang", pa.string()), ("part", pa.int32()), ("base", pa.int32()), ("words", pa.binary()), ("groups", pa.binary()), ("n", pa.int64()), ("codes", pa.binary())])


def _words(most: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each chunk and language: a row with its occurrences, and one for its words in each part."""
        chunk = TaskContext.get().partitionId() << 32
        for b in slices(batches, "__text", most):
            found: dict[str, tuple[_Numbers, list[np.ndarray]]] = {}
            for lang, text in zip(b.column("__lang").to_pylist(), b.column("__text"), strict=True):
                numbers, codes = found.setdefault(lang, (_Numbers({b".": 0}), []))
                cut = tokens(text.as_py())
                codes.append(np.fromiter(map(numbers.__getitem__, cut), np.int32, len(cut)))
                codes.append(np.zeros(1, np.int32))
            for lang, (numbers, every) in found.items():
                codes = np.concatenate(every)
                counts = np.bincount(codes, minlength=len(numbers))[1:]
                words = list(numbers)[1:]
                seed = zlib.crc32(lang.encode())
                part = np.fromiter((zlib.crc32(w, seed) % parts for w in words), np.int64, len(words))
                order, begins, codes = _ordered(part, parts, compact(codes))
                rows = [(chunk, lang, -1, 0, None, None, int(counts.sum()), _pack_codes(codes))]
                for p, (x, y) in enumerate(zip(begins.tolist(), begins[1:].tolist(), strict=False)):
                    if x < y:
                        rows.append((chunk, lang, p, x, zstandard.compress(b"\n".join([words[k] for k in order[x:y].tolist()]), 1), _pack_codes(counts[order[x:y]]), None, None))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _FIELDS, strict=True)], schema=_FIELDS)
                chunk += 1

    return run


_COUNTED = "chunk long, known binary, id long, lang string, a long, b long, word binary, f long"
_COUNTS = pa.schema([("chunk", pa.int64()), ("known", pa.binary()), ("id", pa.int64()), ("lang", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("word", pa.binary()), ("f", pa.int64())])


def _answer(part: int, least: int, total: np.ndarray, entries: list[tuple[int, int, np.ndarray]], described: dict[str, list]) -> pa.Table:
    """The frequent groups of a part, numbered, and for each chunk the places of those it has. entries: chunk, first place, groups."""
    frequent = np.flatnonzero(total >= least)
    ids = np.full(len(total), -1, np.int64)
    ids[frequent] = (part << 40) + np.arange(len(frequent))
    rows = [(None, None, int(ids[g]), *[described[c][g] if c in described else None for c in ("lang", "a", "b", "word")], int(total[g])) for g in frequent.tolist()]
    for chunk, base, groups in entries:
        own = ids[groups]
        places = np.flatnonzero(own >= 0)
        if len(places):
            rows.append((chunk, pack(base + places, own[places]), *[None] * 6))
    return pa.table([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_COUNTS)], schema=_COUNTS)


def _counted_words(least: int):
    def run(part: pa.Table) -> pa.Table:
        numbers, entries, words = {}, [], []
        for chunk, lang, base, text, n in zip(*[part.column(c).to_pylist() for c in ("chunk", "lang", "base", "words", "groups")], strict=True):
            own = zstandard.decompress(text).split(b"\n")
            entries.append((chunk, base, np.fromiter((numbers.setdefault((lang, w), len(numbers)) for w in own), np.int64, len(own))))
            words.append(_unpack_codes(n))
        total = np.bincount(np.concatenate([g for *_, g in entries]), np.concatenate(words).astype(np.float64), len(numbers)).astype(np.int64)
        langs, found = zip(*numbers, strict=True)
        return _answer(part.column("part")[0].as_py(), least, total, entries, {"lang": langs, "word": found})

    return run


def _counted_pairs(least: int):
    def run(part: pa.Table) -> pa.Table:
        chunks, bases = (part.column(c).to_pylist() for c in ("chunk", "base"))
        each = [unpack(g, 3) for g in part.column("groups").to_pylist()]
        a, b, n = (np.concatenate(c) for c in zip(*each, strict=True))
        (ua, ia), (ub, ib) = (np.unique(x, return_inverse=True) for x in (a, b))
        pairs, number = np.unique(ia * len(ub) + ib, return_inverse=True)
        total = np.zeros(len(pairs), np.int64)
        np.add.at(total, number, n)
        ends = np.cumsum([len(x[0]) for x in each])
        entries = list(zip(chunks, bases, np.split(number, ends[:-1]), strict=True))
        return _answer(part.column("part")[0].as_py(), least, total, entries, {"a": ua[pairs // len(ub)].tolist(), "b": ub[pairs % len(ub)].tolist()})

    return run


def _extended(parts: int):
    def run(occurrences: pa.Table, answers: pa.Table) -> pa.Table:
        """The occurrences of a chunk, one word longer: a row with them, and one for its groups in each part."""
        chunk = occurrences.column("of")[0].as_py()
        known = [unpack(x, 2) for x in answers.column("known").to_pylist()]
        places, ids = (np.concatenate([np.zeros(0, np.int64), *c]) for c in (zip(*known, strict=True) if known else ([], [])))
        order = np.argsort(ids)  # groups then come in the order of their ids
        a, b, n, codes = adjacent(_unpack_codes(occurrences.column("codes")[0].as_py()), places[order] + 1)
        a, b = ids[order][a], ids[order][b]
        mixed = (a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
        part = ((mixed >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)
        by, begins, codes = _ordered(part, parts, codes)
        rows = [(chunk, None, -1, 0, None, None, None, _pack_codes(codes))]
        for p, (x, y) in enumerate(zip(begins.tolist(), begins[1:].tolist(), strict=False)):
            if x < y:
                rows.append((chunk, None, p, x, None, pack(*(c[by[x:y]] for c in (a, b, n))), None, None))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _FIELDS, strict=True)], schema=_FIELDS)

    return run


def _exact(column: Column, digits: int = 18) -> Column:
    return column.cast(f"decimal({digits},0)")


def phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 100, longest: int = 5, percent: int = 100, top: int | None = 2000) -> DataFrame:
    """Per language, the ``top`` phrases of 2 to ``longest`` words that occur ``least`` times: the highest scores first.

    A text is cut into pieces at ``.,;:!?`` and line ends, a piece into words at spaces and tabs; A-Z become lower case. ``n`` counts the
    words of the language, ``a`` the occurrences of the phrase within pieces, overlaps included. Cut after a word, the phrase has a first
    part with ``l`` occurrences and a rest with ``r``; ``score`` is the least of floor(1000 a n / (l r)) over its cuts, and ties go to the
    earlier cut. A phrase inside a longer one of at least ``percent`` of its occurrences is left out. Columns: ``lang, rank, phrase, a,
    l, r, n, score``; ties of the score go to larger ``a``, then to the smaller phrase in byte order. All counts are exact.

    A null language is ``und``, a null or empty text has no words, repeated rows count each, an empty table gives an empty result.
    """
    if least < 1 or longest < 2:
        raise ValueError("phrases have two words and occur once at least")
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(_UNKNOWN)).alias("__lang"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("__text"))
    parts = SPREAD * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    relation = stored(rows.mapInArrow(_words(CHUNK, parts), _RELATION))
    totals = stored(relation.where("part < 0").groupBy("lang").agg(F.sum("n").alias("n")))
    parts = max(parts, -(-(totals.agg(F.sum("n")).first()[0] or 0) // ENTRIES))
    counted = stored(relation.where("part >= 0").groupBy("part").applyInArrow(_counted_words(least), _COUNTED))
    none, word = F.array().cast("array<bigint>"), F.col("word").cast("string")
    known = counted.where("id IS NOT NULL").select("id", "lang", "f", word.alias("phrase"), word.alias("last"), none.alias("before"), none.alias("after"))
    found = []
    for _ in range(2, longest + 1):
        occurrences = relation.where("part < 0").select(F.col("chunk").alias("of"), "codes")
        answers = counted.where("id IS NULL").select("chunk", "known")
        relation = stored(occurrences.groupBy("of").cogroup(answers.groupBy("chunk")).applyInArrow(_extended(parts), _RELATION))
        counted = stored(relation.where("part >= 0").groupBy("part").applyInArrow(_counted_pairs(least), _COUNTED))
        first = known.select(F.col("id").alias("a"), "lang", F.col("phrase").alias("head"), F.concat("before", F.array("f")).alias("before"))
        rest = known.select(F.col("id").alias("b"), "last", F.concat("after", F.array("f")).alias("after"))
        pairs = counted.where("id IS NOT NULL").select("id", "a", "b", "f")
        known = stored(
            pairs.join(first, "a").join(rest, "b").select("id", "a", "b", "lang", "f", F.concat_ws(" ", "head", "last").alias("phrase"), "last", "before", "after")
        )
        found.append(known)

    kept = []
    for level, longer in zip(found, [*found[1:], None], strict=True):
        if longer is not None:
            holding = longer.select(F.col("a").alias("id"), F.col("f").alias("more")).unionByName(longer.select(F.col("b").alias("id"), F.col("f").alias("more")))
            level = level.join(holding.groupBy("id").agg(F.max("more").alias("more")), "id", "left").where(f"more IS NULL OR 100 * more < {percent} * f")
        kept.append(level.select("lang", "phrase", F.col("f").alias("a"), "before", "after"))
    cuts = F.transform(
        F.sequence(F.lit(1), F.size("before")),
        lambda k: F.struct(k.alias("k"), F.element_at("before", k).alias("l"), F.element_at("after", F.size("after") + 1 - k).alias("r")),
    )
    whole = reduce(DataFrame.unionByName, kept).join(totals, "lang").withColumn("cut", F.explode(cuts)).select("lang", "phrase", "a", "n", "cut.k", "cut.l", "cut.r")
    # Decimals of up to 38 digits hold the products, and their integral quotient is exact.
    product, parts = _exact(1000 * F.col("a")) * _exact(F.col("n")), _exact(F.col("l")) * _exact(F.col("r"))
    scored = whole.withColumns({"product": product, "parts": parts}).selectExpr("lang", "phrase", "a", "n", "named_struct('score', product div parts, 'k', k, 'l', l, 'r', r) AS cut")
    least_cut = scored.groupBy("lang", "phrase", "a", "n").agg(F.min("cut").alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    if top is not None:  # first within parts of a language, so that none is ordered whole in one task
        part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
        least_cut = least_cut.withColumn("part", part).withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("place") <= top)
    ranked = least_cut.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases(table(spark, sf_dir, "documents"))


OP13_SQL = """
WITH pieces AS (
  SELECT lang, list_filter(regexp_split_to_array(p, '[\\x20\\x09]+'), lambda w: w <> '') AS ws
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents)
), totals AS (
  SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM pieces GROUP BY lang
), places AS (
  SELECT lang, ws, size, unnest(range(1, CAST(len(ws) - size + 2 AS BIGINT))) AS place
  FROM pieces, (SELECT unnest(range(1, 6)) AS size) WHERE len(ws) >= size
), counted AS (
  SELECT lang, size, phrase, count(*) AS f
  FROM (SELECT lang, size, array_to_string(list_slice(ws, place, place + size - 1), ' ') AS phrase FROM places)
  GROUP BY lang, size, phrase HAVING count(*) >= 100
), cuts AS (
  SELECT lang, size, phrase, f AS a, unnest(range(1, size)) AS cut, string_split(phrase, ' ') AS ws FROM counted WHERE size > 1
), parts AS (
  SELECT cuts.lang, cuts.size, cuts.phrase, cuts.a, cuts.cut, x.f AS l, y.f AS r, totals.n,
         (CAST(1000 AS HUGEINT) * cuts.a * totals.n) // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM cuts JOIN totals ON totals.lang = cuts.lang
  JOIN counted x ON x.lang = cuts.lang AND x.size = cuts.cut AND x.phrase = array_to_string(list_slice(cuts.ws, 1, cuts.cut), ' ')
  JOIN counted y ON y.lang = cuts.lang AND y.size = cuts.size - cuts.cut AND y.phrase = array_to_string(list_slice(cuts.ws, cuts.cut + 1, cuts.size), ' ')
), lowest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM parts) WHERE place = 1
), shorter AS (
  SELECT lang, ws, f, z, unnest(range(1, CAST(size - z + 2 AS BIGINT))) AS s
  FROM (SELECT lang, string_split(phrase, ' ') AS ws, f, size, unnest(range(2, size)) AS z FROM counted WHERE size > 2)
), held AS (
  SELECT lang, array_to_string(list_slice(ws, s, s + z - 1), ' ') AS phrase, max(f) AS f FROM shorter GROUP BY 1, 2
), ranked AS (
  SELECT lowest.lang, row_number() OVER (PARTITION BY lowest.lang ORDER BY score DESC, a DESC, encode(lowest.phrase)) AS rank,
         lowest.phrase, a, l, r, n, CAST(score AS BIGINT) AS score
  FROM lowest LEFT JOIN held ON held.lang = lowest.lang AND held.phrase = lowest.phrase
  WHERE held.f IS NULL OR 100 * held.f < 100 * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
