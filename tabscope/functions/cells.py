"""What the cells of text columns look like: numbers, booleans, dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.functions.columns import WHITESPACE, stacked
from tabscope.functions.dates import DATE_FORMATS, DATE_SHAPE

# Cells read as missing: fixed values.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Cells read as booleans: fixed values.
TRUE_TOKENS = ("True", "TRUE", "true")
FALSE_TOKENS = ("False", "FALSE", "false")

_INTEGER = r"^[+-]?[0-9]+$"
_NUMBER = r"(?i)^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?$|^[+-]?inf(inity)?$"


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def without_na(text: Column) -> Column:
    """The cell, or NULL when it is one of the missing-value tokens."""
    return F.when(~text.isin(*NA_TOKENS), text)


def as_integer(text: Column) -> Column:
    return F.when(trimmed(text).rlike(_INTEGER), trimmed(text).try_cast("bigint"))


def as_number(text: Column) -> Column:
    return F.when(trimmed(text).rlike(_NUMBER), trimmed(text).try_cast("double"))


def as_boolean(text: Column) -> Column:
    return F.when(text.isin(*TRUE_TOKENS), True).when(text.isin(*FALSE_TOKENS), False)


READINGS = {"bigint": as_integer, "double": as_number, "boolean": as_boolean}


def date_facts(df: DataFrame, texts: Sequence[Column]) -> DataFrame:
    """``position, n, hits``: filled cells, and cells that fit each date format.

    Cells shaped like a date are counted per distinct text first: there are few
    different dates, so the formats are tried on a small table and only that
    table is shuffled.
    """
    cells = stacked(df, texts, "text").select("position", "text", trimmed(F.col("text")).alias("t"))
    counted = _by_date(cells, [F.count("text").alias("n")])
    return counted.groupBy("position").agg(F.sum("n").alias("n"), _hits())


def cell_facts(df: DataFrame, texts: Sequence[Column]) -> DataFrame:
    """``position, n, hits`` and the cells readable as ``bigint, double, boolean``."""
    t = F.col("t")
    # Up to 18 digits always fit a bigint.
    integer = t.rlike(_INTEGER) & ((F.length(t) <= 18) | t.try_cast("bigint").isNotNull())
    cells = (
        stacked(df, texts, "text")
        .select("position", "text", trimmed(F.col("text")).alias("t"))
        .select("position", "text", "t", integer.alias("integer"))
    )
    counted = _by_date(
        cells,
        [
            F.count("text").alias("n"),
            F.count_if("integer").alias("bigint"),
            F.count_if(F.col("integer") | t.rlike(_NUMBER)).alias("double"),
            F.count_if(F.col("text").isin(*TRUE_TOKENS, *FALSE_TOKENS)).alias("boolean"),
        ],
    )
    return counted.groupBy("position").agg(
        F.sum("n").alias("n"), *[F.sum(kind).alias(kind) for kind in READINGS], _hits()
    )


def _by_date(cells: DataFrame, counts: list[Column]) -> DataFrame:
    date = F.when(F.col("t").rlike(DATE_SHAPE), F.col("t"))
    return cells.groupBy("position", date.alias("date")).agg(*counts)


def _hits() -> Column:
    """Cells per date format, in format order."""
    fits = [
        F.when(F.col("date").rlike(f.shape) & F.try_to_date("date", f.pattern).isNotNull(), F.col("n"))
        for f in DATE_FORMATS
    ]
    zero = F.lit(0).cast("bigint")
    return F.array(*[F.coalesce(F.sum(fit), zero) for fit in fits]).alias("hits")


def narrowest_type() -> Column:
    """The narrowest type that reads every filled cell; double when there is none."""
    n = F.col("n")
    return (
        F.when(n == 0, "double")
        .when(F.col("bigint") == n, "bigint")
        .when(F.col("double") == n, "double")
        .when(F.col("boolean") == n, "boolean")
        .otherwise("string")
    )
