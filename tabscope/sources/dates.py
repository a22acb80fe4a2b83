"""Detection and conversion of date columns stored as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscope.functions.arithmetic import rounded
from tabscope.functions.cells import date_facts
from tabscope.functions.columns import col, family_of, name_at, require_frame
from tabscope.functions.dates import (
    AUTO_DETECTED,
    DATE_FORMATS,
    MIN_RATIO,
    NAME_BONUS,
    DateFormat,
    choose_format,
    parse_date,
)
from tabscope.functions.names import looks_like_date

_SCHEMA = "column string, format string, parsed_as string, confidence double"


def _of_family(df: DataFrame, family: str) -> list[str]:
    return [f.name for f in df.schema.fields if family_of(f.dataType) == family]


def detect_date_columns(df: DataFrame) -> DataFrame:
    """Columns holding dates: ``column, format, parsed_as, confidence``.

    Native date and time columns are reported as ``datetime64``. Text columns
    are scored against eight formats; the best must fit at least 80 % of the
    non-null cells. When two formats fit equally well the column is
    ``auto-detected`` and ``parsed_as`` names the preferred one.
    """
    require_frame(df)
    native, texts = _of_family(df, "datetime"), _of_family(df, "text")
    found = df.sparkSession.createDataFrame([(c, "datetime64", None, 1.0) for c in native], _SCHEMA)
    if not texts:
        return found
    labels = F.array(*[F.lit(f.label) for f in DATE_FORMATS])
    named = F.col("column").isin([c for c in texts if looks_like_date(c)])
    scored = (
        date_facts(df, [col(c) for c in texts])
        .where(F.col("n") > 0)
        .withColumn("choice", choose_format(F.col("hits"), F.col("n")))
        .where(F.col("choice.ratio") >= MIN_RATIO)
        .withColumn("column", name_at(texts))
        .withColumn("label", F.element_at(labels, F.col("choice.at") + 1))
        .select(
            "column",
            F.when(F.col("choice.tied"), AUTO_DETECTED).otherwise(F.col("label")).alias("format"),
            F.col("label").alias("parsed_as"),
            rounded(F.least(F.lit(1.0), F.col("choice.ratio") + F.when(named, NAME_BONUS).otherwise(0.0)), 3).alias(
                "confidence"
            ),
        )
    )
    return found.unionByName(scored) if native else scored


def as_timestamp(text: Column, fmt: DateFormat) -> Column:
    """The parsed date as a timestamp without time zone, NULL for other cells."""
    return parse_date(text, fmt).cast(T.TimestampNTZType())


def convert_date_columns(df: DataFrame, detected: DataFrame | None = None) -> DataFrame:
    """The table with its text date columns as timestamps; cells that do not fit become NULL.

    Runs the detection job (the schema of the result depends on it) unless the
    result of ``detect_date_columns`` is passed in.
    """
    require_frame(df)
    texts = _of_family(df, "text")
    if not texts:
        return df
    found = detect_date_columns(df) if detected is None else detected
    chosen = {r["column"]: r["parsed_as"] for r in found.collect()}
    formats = {f.label: f for f in DATE_FORMATS}
    return df.select(
        *[
            as_timestamp(col(c), formats[chosen[c]]).alias(c) if c in texts and c in chosen else col(c)
            for c in df.columns
        ]
    )


def date_columns(df: DataFrame) -> list[str]:
    """Names of the columns that hold dates, in schema order."""
    found = {r["column"] for r in detect_date_columns(df).select("column").collect()}
    return [c for c in df.columns if c in found]
