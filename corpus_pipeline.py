"""A training corpus from the documents table: what is poor, copied, repeated or part of a benchmark goes, the rest is packed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscope.llm.common import stored, table
from tabscope.llm.decontaminate import remove_passages
from tabscope.llm.near_duplicates import keep_one
from tabscope.llm.packing import pack_documents
from tabscope.llm.quality import THRESHOLD, filter_quality, held_out, train
from tabscope.llm.repeats import remove_repeats


def _measured(docs: DataFrame) -> DataFrame:
    """``docs`` with lengths that fit their texts, where the table has them."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score, from a network trained on the labelled ones, reaches the threshold."""
    network = train(docs, table(spark, sf_dir, "labels").where(~held_out("doc_id", 5)))
    return filter_quality(docs, network, THRESHOLD)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by five-word shingles of similarity 0.8 or more."""
    return keep_one(docs, size=5, percent=80)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; a passage of 200 bytes that occurs several times stays where it occurs first."""
    return _measured(remove_repeats(docs))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which passages of the benchmark make up less than a twentieth, without those of 13 words and more."""
    return _measured(remove_passages(docs, table(spark, sf_dir, "benchmark"), drop=True))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's bucket of lengths and its batch there."""
    return pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good),
    ("near-duplicates", distinct),
    ("repeated passages", unrepeated),
    ("benchmark decontamination", decontaminated),
    ("packing", packed),
]

#: Trained scores decide the first stage, which SQL can't express; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs)
    return docs
