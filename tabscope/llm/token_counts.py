"""Token counts of documents under a sentencepiece model, without token ids.

A pre-token is a run of spaces with what follows it up to the next space or line end. No piece of the model reaches
beyond one (checked on the vocabulary), so pieces are counted once per distinct pre-token of the corpus and summed by
document frequencies. The most frequent pre-tokens, whose number is a parameter, are broadcast with their counts; all
others are joined by a shuffle, where none of them can be hot.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscope.llm.common import ROW, batch, slices, stored, table, texts

_SPACE = "▁"
_PRE_TOKEN = re.compile(f"[ {_SPACE}]+[^ {_SPACE}\n]*|[^ {_SPACE}\n]+|\n")
#: Pre-tokens that a task counts before it passes them on.
_HELD = 1_000_000


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text, spaces written as such, with the leading space that the model puts before a text."""
    return _PRE_TOKEN.findall((" " + text).replace(_SPACE, " ")) if text else []


@lru_cache(maxsize=2)
def load_model(path: str):
    """The model, if pre-tokens are independent under it."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if "\n" in piece or _SPACE in piece.lstrip(_SPACE):
            raise ValueError(f"piece {piece!r} reaches beyond a pre-token; this model needs whole texts")
    if model.encode("a\n  b") != model.encode("a") + model.encode("\n")[1:] + model.encode(" b"):
        raise ValueError("the model changes white space; it needs whole texts")
    return model


def count_pieces(model, pre: list[str]) -> list[int]:
    """Pieces of each pre-token. One that has no leading space is counted after a line end, which is a piece of its own."""
    lengths = model.encode([p[1:] if p[0] == " " and len(p) > 1 else "\n" + p for p in pre], num_threads=1)
    return [1 if p == " " else len(x) - 2 * (p[0] != " ") for p, x in zip(pre, lengths, strict=True)]


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", frequent: int = 200_000) -> DataFrame:
    """Per row of ``docs``: id, ``n_bytes`` (UTF-8) and ``n_tokens`` of the whole text.

    A null or empty text has 0 of both; rows with equal or null ids are counted apart; an empty table gives an empty
    result; other columns play no part. ``frequent`` bounds the broadcast (pre-tokens of at most 32 characters).
    """
    spark = docs.sparkSession
    rows = texts(docs, id_col, text_col)
    pieces = stored(
        rows.select("__text")
        .mapInArrow(_frequencies, "pre string, n long")
        .groupBy("pre").agg(F.sum("n").alias("n"))
        .mapInArrow(_counter(model_path), "pre string, n long, pieces long")
    )
    known = _most_frequent(pieces, frequent).toPandas()
    known = spark.sparkContext.broadcast(dict(zip(known["pre"], known["pieces"].tolist(), strict=True)))
    parts = rows.mapInArrow(_parts(known, id_col), f"{ROW} long, `{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_bytes long, n_tokens long, pre string, n long")
    return (
        parts.join(pieces.select("pre", "pieces"), "pre", "left")
        .groupBy(ROW)
        .agg(
            F.first(id_col, ignorenulls=True).alias(id_col),
            F.sum("n_bytes").alias("n_bytes"),
            F.sum(F.col("n_tokens") + F.coalesce(F.col("n") * F.col("pieces"), F.lit(0))).alias("n_tokens"),
        )
        .drop(ROW)
    )


def _most_frequent(pieces: DataFrame, most: int) -> DataFrame:
    """At most ``most`` pre-tokens, no rarer than any other of up to 32 characters, from a histogram of the frequencies."""
    short = pieces.where(F.length("pre") <= 32)
    level = F.floor(F.log2("n") * 8).cast("int")  # a row for each eighth of a power of two
    levels = short.groupBy(level.alias("level")).count().collect()
    left, least = most, None
    for r in sorted(levels, key=lambda r: -r["level"]):
        left -= r["count"]
        if left < 0:
            break
        least = r["level"]
    return short.where(F.lit(False) if least is None else level >= least).select("pre", "pieces")


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, held = pa.schema([("pre", pa.string()), ("n", pa.int64())]), Counter()
    for b in slices(batches, "__text"):
        for text in b.column(0).cast(pa.string()).to_pylist():
            held.update(pre_tokens(text))
        if len(held) > _HELD:
            yield batch(schema, list(held), list(held.values()))
            held = Counter()
    if held:
        yield batch(schema, list(held), list(held.values()))


def _counter(model_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_model(model_path)
        for b in batches:
            pre = b.column("pre").to_pylist()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(count_pieces(model, pre), pa.int64())], names=["pre", "n", "pieces"])

    return run


def _parts(known, id_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per row its size and the tokens of its frequent pre-tokens, and a row for each other pre-token of it."""
        get = known.value.get
        for b in slices(batches, "__text"):
            schema = pa.schema([(ROW, pa.int64()), (id_col, b.schema.field(id_col).type), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("pre", pa.string()), ("n", pa.int64())])
            at, sums, rare, counts = [], [], [], []
            ids = b.column(ROW).to_pylist()
            for i, text in enumerate(b.column("__text").cast(pa.string()).to_pylist()):
                pre = pre_tokens(text)
                found = list(map(get, pre))
                if None in found:
                    others = Counter(p for p, n in zip(pre, found, strict=True) if n is None)
                    at += [i] * len(others)
                    rare += others
                    counts += others.values()
                    found = filter(None, found)
                sums.append(sum(found))
            size = pc.binary_length(b.column("__text")).cast(pa.int64())
            none = pa.nulls(b.num_rows, pa.int64())
            # No pre-token is longer than a line end and starts with one: these keys meet nothing and no other row.
            yield batch(schema, b.column(ROW), b.column(id_col), size, sums, [f"\n{i}" for i in ids], none)
            if at:
                zero = pa.array([0] * len(at), pa.int64())
                yield batch(schema, b.column(ROW).take(pa.array(at)), pa.nulls(len(at), b.schema.field(id_col).type), zero, zero, rare, counts)

    return run


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)
