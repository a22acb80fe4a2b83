"""Outliers by the interquartile range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabscope.errors import AnalysisError
from tabscope.functions.arithmetic import rounded
from tabscope.functions.columns import long_numbers, name_at
from tabscope.operators.statistics import column_quantiles, numeric_targets

# Default fence multiplier and examples returned.
DEFAULT_MULTIPLIER = 1.5
MAX_EXAMPLES = 5

_WHY = "it has no quartiles"


def _fences(df: DataFrame, names: Sequence[str], multiplier: float) -> DataFrame:
    """``position, lower, upper, median`` per column; one row per column, so always small."""
    q = F.col("q")
    reach = F.lit(float(multiplier)) * (q[2] - q[0])
    fences = column_quantiles(df, names).where(F.col("n") > 0)
    return fences.select("position", (q[0] - reach).alias("lower"), (q[2] + reach).alias("upper"), q[1].alias("median"))


def _fenced(df: DataFrame, names: Sequence[str], multiplier: float) -> DataFrame:
    """Every value next to the fences of its column."""
    values = long_numbers(df, names).where(F.col("value").isNotNull())
    return values.join(F.broadcast(_fences(df, names, multiplier)), "position")


def _outside():
    return (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))


def _checked(df: DataFrame, column: str | None, multiplier: float | None) -> tuple[list[str], float]:
    k = DEFAULT_MULTIPLIER if multiplier is None else multiplier
    if k <= 0:
        raise AnalysisError("bad_multiplier", "The fence multiplier has to be above 0.")
    return numeric_targets(df, column, _WHY), k


def outlier_analysis(
    df: DataFrame,
    column: str | None = None,
    multiplier: float | None = None,
    max_columns: int | None = None,
    strict: bool = False,
) -> DataFrame:
    """Values outside ``[q25 - k·IQR, q75 + k·IQR]``, one row per column.

    Columns: column, observations, outlier_count, outlier_percentage,
    lower_bound, upper_bound, is_constant; the most affected columns first.
    A constant column has no outliers and no bounds; a column without any value
    is left out (``strict`` raises when none is left).
    """
    names, k = _checked(df, column, multiplier)
    constant = F.col("smallest") == F.col("largest")
    counted = (
        _fenced(df, names, k)
        .groupBy("position")
        .agg(
            F.count("value").alias("observations"),
            F.count_if(_outside()).alias("outside"),
            F.min("value").alias("smallest"),
            F.max("value").alias("largest"),
            F.max("lower").alias("lower"),
            F.max("upper").alias("upper"),
        )
        .withColumn("outlier_count", F.when(constant, F.lit(0)).otherwise(F.col("outside")).cast("bigint"))
        .select(
            "position",
            name_at(names).alias("column"),
            "observations",
            "outlier_count",
            rounded(100 * F.col("outlier_count") / F.col("observations"), 2).alias("outlier_percentage"),
            F.when(~constant, rounded("lower", 2)).alias("lower_bound"),
            F.when(~constant, rounded("upper", 2)).alias("upper_bound"),
            constant.alias("is_constant"),
        )
    )
    if strict and counted.isEmpty():
        raise AnalysisError("no_values", "All numeric columns are empty.")
    ranked = counted.orderBy(F.col("outlier_percentage").desc(), "position").drop("position")
    return ranked if max_columns is None else ranked.limit(max_columns)


def outlier_examples(
    df: DataFrame,
    column: str | None = None,
    multiplier: float | None = None,
    max_examples: int = MAX_EXAMPLES,
) -> DataFrame:
    """The outliers farthest from the median: ``column, rank, value``, 2 decimals.

    The rank limit is applied within every task before the rows are exchanged.
    """
    names, k = _checked(df, column, multiplier)
    farthest = Window.partitionBy("position").orderBy(
        F.abs(F.col("value") - F.col("median")).desc(), F.col("value")
    )
    return (
        _fenced(df, names, k)
        .where(_outside())
        .withColumn("rank", F.row_number().over(farthest))
        .where(F.col("rank") <= max_examples)
        .select(name_at(names).alias("column"), "rank", rounded("value", 2).alias("value"))
    )
