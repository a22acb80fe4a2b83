"""Pearson correlation between numeric columns."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.errors import AnalysisError
from tabscope.functions.arithmetic import rounded
from tabscope.functions.columns import (
    name_at,
    number,
    numeric_columns,
    require_column,
    require_frame,
    require_numeric,
    rows_from_wide,
)

# Below this share of its own size a sum of squares is rounding noise.
_NO_SPREAD = 1e-13

_SUMS = "i int, j int, n double, x double, y double, xy double, xx double, yy double"


def _finite(df: DataFrame, name: str) -> Column:
    """The column as a double, cells without a finite value as NULL."""
    value = number(df, name)
    return F.when(F.abs(value) < float("inf"), value)


def _centered(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The columns minus their means; constant columns and infinite cells as NULL."""
    numbers = [_finite(df, c) for c in names]
    varies = [F.min(v) != F.max(v) for v in numbers]
    means = df.agg(F.array(*[F.when(some, F.avg(v)) for some, v in zip(varies, numbers)]).alias("m")).scalar()
    wide = df.select(*[v.alias(f"c{i}") for i, v in enumerate(numbers)], means.alias("m"))
    return wide.select(*[(F.col(f"c{i}") - F.col("m")[i]).alias(f"c{i}") for i in range(len(names))])


def _pair_sums(centered: DataFrame, left: list[int], right: list[int]) -> DataFrame:
    """Sums over the rows where both columns of a pair are present, per pair.

    A task reduces its rows to one set of sums by matrix products, whatever the
    number of rows; the sums of all tasks are then added per pair.
    """

    # Nested, so that it travels with the task and the executors need no package.
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            values = batch.to_numpy(dtype=float, na_value=np.nan)
            filled = (~np.isnan(values)).astype(float)
            values = np.where(filled > 0, values, 0.0)
            f, g, x, y = filled[:, left], filled[:, right], values[:, left], values[:, right]
            sums = np.stack([f.T @ g, x.T @ g, f.T @ y, x.T @ y, (x * x).T @ g, f.T @ (y * y)])
            total = sums if total is None else total + sums
        if total is not None:
            i, j = np.meshgrid(left, right, indexing="ij")
            wanted = (i < j) if len(left) > 1 else (i != j)
            columns = [i[wanted], j[wanted], *[s[wanted] for s in total]]
            yield pd.DataFrame(dict(zip(["i", "j", "n", "x", "y", "xy", "xx", "yy"], columns)))

    names = ("n", "x", "y", "xy", "xx", "yy")
    return centered.mapInPandas(partial, _SUMS).groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in names])


def _pearson() -> Column:
    """Correlation from the sums; NULL when a column is constant over the shared rows."""
    n, x, y = F.col("n"), F.col("x"), F.col("y")
    xx, yy = F.col("xx") - F.try_divide(x * x, n), F.col("yy") - F.try_divide(y * y, n)
    r = (F.col("xy") - F.try_divide(x * y, n)) / F.sqrt(xx * yy)
    spread = (xx > _NO_SPREAD * F.col("xx")) & (yy > _NO_SPREAD * F.col("yy"))
    bounded = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))
    return F.when(spread & ~F.isnan(xx * yy), bounded)


def _columns(df: DataFrame, column: str | None, columns: Sequence[str] | None) -> list[str]:
    require_frame(df)
    numeric = numeric_columns(df)
    if column is not None:
        require_column(df, column)
        if column not in numeric:
            raise AnalysisError(
                "not_numeric", f"'{column}' holds no numbers to correlate.", numeric
            )
    if columns is None:
        return numeric
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise AnalysisError("unknown_column", f"The table has no {missing}.", df.columns)
    other = [c for c in columns if c not in numeric]
    if other:
        raise AnalysisError("not_numeric", f"Only numbers can be correlated, unlike {other}.", numeric)
    chosen = list(dict.fromkeys(columns))
    return chosen if column is None or column in chosen else [*chosen, column]


def correlations(
    df: DataFrame, column: str | None = None, columns: Sequence[str] | None = None, strict: bool = False
) -> DataFrame:
    """All correlations: ``pair, column_1, column_2, r`` (unrounded, pairs without r left out).

    With ``column`` only its pairs, and it is always ``column_1``. Constant
    columns have no correlation. ``strict`` raises when fewer than two columns
    vary or the named column is constant.
    """
    names = _columns(df, column, columns)
    if len(names) < 2:
        raise AnalysisError(
            "too_few_columns",
            f"A correlation needs two columns of numbers; there are {len(names)}.",
        )
    if strict:
        constant = [r["column"] for r in constant_columns(df, names).collect()]
        if len(names) - len(constant) < 2:
            raise AnalysisError(
                "too_few_columns",
                f"A correlation needs two columns that vary; there are {len(names) - len(constant)}.",
            )
        if column in constant:
            raise AnalysisError("constant", f"'{column}' has the same value everywhere.")
    left = list(range(len(names))) if column is None else [names.index(column)]
    sums = _pair_sums(_centered(df, names), left, list(range(len(names))))
    return sums.select(
        (F.col("i") * len(names) + F.col("j")).alias("pair"),
        name_at(names, "i").alias("column_1"),
        name_at(names, "j").alias("column_2"),
        _pearson().alias("r"),
    ).where(F.col("r").isNotNull())


def correlation_analysis(
    df: DataFrame,
    column: str | None = None,
    columns: Sequence[str] | None = None,
    top_n: int | None = None,
    strict: bool = False,
) -> DataFrame:
    """The strongest correlations by absolute value: ``column_1, column_2, correlation``.

    With ``column`` its correlations with every other numeric column, otherwise
    all pairs; ``columns`` restricts the columns looked at and ``top_n`` the pairs
    returned. Cells that are infinite count as missing. Rounded to 3 decimals
    after ordering.
    """
    ranked = correlations(df, column, columns, strict).orderBy(F.abs("r").desc(), "pair")
    if top_n is not None:
        ranked = ranked.limit(top_n)
    return ranked.select("column_1", "column_2", rounded("r", 3).alias("correlation"))


def correlation_extremes(
    df: DataFrame, column: str | None = None, columns: Sequence[str] | None = None, strict: bool = False
) -> DataFrame:
    """The strongest positive and negative correlation over all pairs, one row per ``kind``."""
    found = correlations(df, column, columns, strict)
    pair, r, at = F.struct("column_1", "column_2", "r"), F.col("r"), F.col("pair")
    one = found.agg(
        F.min_by(pair, F.when(r > 0, F.struct(-r, at))).alias("strongest_positive"),
        F.min_by(pair, F.when(r < 0, F.struct(r, at))).alias("strongest_negative"),
    )
    kinds = ("strongest_positive", "strongest_negative")
    rows = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("p")) for k in kinds])
    return (
        one.select(F.inline(rows))
        .where(F.col("p").isNotNull())
        .select("kind", "p.column_1", "p.column_2", rounded("p.r", 3).alias("correlation"))
    )


def constant_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Numeric columns with at most one distinct value, which correlations leave out: ``column``."""
    names = list(columns) if columns is not None else numeric_columns(df)
    for name in names:
        require_numeric(df, name, "its variance cannot be checked")
    if not names:
        return df.sparkSession.createDataFrame([], "column string")
    wide = df.agg(
        *[F.equal_null(F.min(_finite(df, c)), F.max(_finite(df, c))).alias(f"c{i}") for i, c in enumerate(names)]
    )
    rows = [
        F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("constant")) for i, c in enumerate(names)
    ]
    return rows_from_wide(wide, rows).where("constant").select("column")
