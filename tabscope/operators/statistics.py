"""Descriptive statistics of numeric columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.errors import AnalysisError
from tabscope.functions.arithmetic import rounded
from tabscope.functions.columns import (
    long_numbers,
    name_at,
    number,
    numeric_columns,
    require_column,
    require_frame,
    require_numeric,
    rows_from_wide,
)
from tabscope.operators.quantiles import quantiles

# Columns aggregated together; keeps the generated code of one aggregate small.
# Each chunk reads other columns, so more chunks do not read more data.
_CHUNK = 8

STATISTICS_COLUMNS = (
    "column", "count", "mean", "median", "std", "min", "max", "q25", "q75", "iqr",
    "skewness", "coefficient_of_variation",
)


def _moments(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``position, n, mean, std, min, max, g1`` of the named columns."""
    how = {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "g1": F.skewness}
    parts = []
    for at in range(0, len(names), _CHUNK):
        chunk = list(enumerate(names[at : at + _CHUNK], start=at))
        wide = df.agg(*[f(number(df, c)).alias(f"{k}{i}") for i, c in chunk for k, f in how.items()])
        rows = [
            F.struct(F.lit(i).alias("position"), *[F.col(f"{k}{i}").alias(k) for k in how]) for i, _ in chunk
        ]
        parts.append(rows_from_wide(wide, rows))
    return reduce(DataFrame.unionByName, parts)


def column_quantiles(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Exact quartiles per column: ``position, n, q`` with q = [q25, median, q75]."""
    return quantiles(long_numbers(df, names), ["position"], "value", [0.25, 0.5, 0.75], few_groups=True)


def _adjusted_skewness(g1: Column, n: Column) -> Column:
    """The bias-adjusted skewness from the plain one."""
    n = n.cast("double")
    return F.when(n >= 3, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def numeric_targets(df: DataFrame, column: str | None, why: str) -> list[str]:
    """The named column after its checks, or all numeric columns."""
    require_frame(df)
    if column is not None:
        require_column(df, column)
        require_numeric(df, column, why)
        return [column]
    names = numeric_columns(df)
    if not names:
        raise AnalysisError("no_numeric", "The table has no column of numbers.", df.columns)
    return names


def statistics(df: DataFrame, column: str | None = None, strict: bool = False) -> DataFrame:
    """One row of statistics for the named column or for every numeric column.

    Columns without any value are left out (``strict`` raises for a named one).
    Values are rounded to 2 decimals, the coefficient of variation to 4; the
    interquartile range and the coefficient come from the rounded parts.
    """
    names = numeric_targets(df, column, "it has no statistics")
    q, n = F.col("q"), F.col("n")
    skew = F.coalesce(rounded(_adjusted_skewness(F.col("g1"), n), 2), F.lit(0.0))
    spread = F.col("std")
    result = (
        _moments(df, names)
        .where(n > 0)
        .join(F.broadcast(column_quantiles(df, names).select("position", "q")), "position")
        .select(
            name_at(names).alias("column"),
            n.alias("count"),
            rounded("mean", 2).alias("mean"),
            rounded(q[1], 2).alias("median"),
            F.coalesce(rounded("std", 2), F.lit(0.0)).alias("std"),
            rounded("min", 2).alias("min"),
            rounded("max", 2).alias("max"),
            rounded(q[0], 2).alias("q25"),
            rounded(q[2], 2).alias("q75"),
            skew.alias("skew"),
        )
        .select(
            "column", "count", "mean", "median", "std", "min", "max", "q25", "q75",
            rounded(F.col("q75") - F.col("q25"), 2).alias("iqr"),
            F.when(spread > 0, F.col("skew")).otherwise(0.0).alias("skewness"),
            F.when((F.col("mean") != 0) & (spread > 0), rounded(spread / F.abs("mean"), 4)).alias(
                "coefficient_of_variation"
            ),
        )
    )
    if strict and column is not None and result.isEmpty():
        raise AnalysisError("no_values", f"'{column}' is empty.")
    return result
