"""Group-by: one key, one value, one aggregate, with ranking and comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscope.functions.arithmetic import percent_change, percent_difference, rounded
from tabscope.functions.columns import (
    is_datetime,
    present,
    require_choice,
    require_column,
    require_frame,
    require_rows,
)
from tabscope.functions.filters import where_values
from tabscope.operators.aggregates import aggregate, check_aggregate, value_for
from tabscope.operators.quantiles import bucket_of


def _order(top_n: int | None, sort_order: str | None) -> list[Column]:
    if top_n is not None and sort_order == "asc":
        return [F.col("value").asc_nulls_last(), F.col("group").asc()]
    return [F.col("value").desc_nulls_last(), F.col("group").asc()]


def groupby_analysis(
    df: DataFrame,
    group_column: str,
    value_column: str,
    agg_function: str = "mean",
    filter_values: Sequence | None = None,
    top_n: int | None = None,
    sort_order: str | None = None,
    max_groups: int | None = None,
    strict: bool = False,
) -> DataFrame:
    """Aggregate ``value_column`` per ``group_column``: ``group, value``.

    Rows without a group are left out; values are rounded to 2 decimals. All
    groups are returned, with ``top_n`` the N highest (``sort_order="asc"``:
    lowest) values, with ``max_groups`` at most that many, the highest. NULL values come last, ties keep group order. Datetime groups
    without ``top_n`` come in chronological order. ``strict`` raises when the
    filter leaves no row (one extra job).
    """
    require_frame(df)
    require_column(df, group_column)
    check_aggregate(df, value_column, agg_function)
    if sort_order is not None:
        require_choice("Sort order", sort_order, ("asc", "desc"))
    rows = where_values(df, group_column, filter_values)
    if strict and filter_values:
        require_rows(rows, f"The filter on '{group_column}' leaves nothing.")
    keyed = rows.select(
        present(df, group_column).alias("group"), value_for(df, value_column, agg_function).alias("value")
    ).where(F.col("group").isNotNull())
    grouped = aggregate(keyed, ["group"], agg_function).select("group", rounded("value", 2).alias("value"))
    if top_n is not None:
        return grouped.orderBy(*_order(top_n, sort_order)).limit(top_n)
    if max_groups is not None:
        grouped = grouped.orderBy(*_order(None, None)).limit(max_groups)
    return grouped.orderBy("group") if is_datetime(df, group_column) else grouped


def best_and_worst_group(
    df: DataFrame,
    group_column: str,
    value_column: str,
    agg_function: str = "mean",
    filter_values: Sequence | None = None,
    strict: bool = False,
) -> DataFrame:
    """The best and the worst of all groups, in one row. The first group in order wins a tie."""
    return extremes_of(groupby_analysis(df, group_column, value_column, agg_function, filter_values, strict=strict))


def extremes_of(grouped: DataFrame) -> DataFrame:
    """The best and the worst of ``group, value`` rows."""
    best = F.struct(-F.col("value"), F.col("group"))
    worst = F.struct(F.col("value"), F.col("group"))
    return grouped.where(F.col("value").isNotNull()).agg(
        F.min_by("group", best).alias("best_group"),
        F.max("value").alias("best_value"),
        F.min_by("group", worst).alias("worst_group"),
        F.min("value").alias("worst_value"),
    )


def group_ranking(
    df: DataFrame, group_column: str, value_column: str, agg_function: str = "mean", **options
) -> DataFrame:
    """The returned groups ranked by value, highest first: ``rank, group, value``.

    Takes the options of ``groupby_analysis``.
    """
    return ranking_of(groupby_analysis(df, group_column, value_column, agg_function, **options))


def ranking_of(grouped: DataFrame) -> DataFrame:
    """``rank, group, value`` of ``group, value`` rows, however many.

    Groups are numbered within buckets of like values and moved up by the number
    of groups in higher buckets, of which there is a bounded number. Only groups
    of nearly equal values are ordered together.
    """
    valued = grouped.where(F.col("value").isNotNull()).withColumn("_b", bucket_of("value", 64))
    within = Window.partitionBy("_b").orderBy(*_order(None, None))
    higher = Window.orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ahead = valued.groupBy("_b").agg(F.count("*").alias("_n")).select("_b", F.coalesce(F.sum("_n").over(higher), F.lit(0)).alias("_ahead"))
    return (
        valued.withColumn("_at", F.row_number().over(within))
        .join(ahead, "_b")
        .select((F.col("_ahead") + F.col("_at")).cast("int").alias("rank"), "group", "value")
    )


def compare_two_groups(
    df: DataFrame, group_column: str, value_column: str, agg_function: str = "mean", **options
) -> DataFrame:
    """Absolute and relative difference, when exactly two groups hold a value.

    Takes the options of ``groupby_analysis``; the result has one row, or none
    when there are not exactly two groups. The percentage difference is relative
    to the mean of both values, the percentage change to the first group.
    """
    grouped = groupby_analysis(df, group_column, value_column, agg_function, **options)
    return comparison_of(grouped, options.get("top_n") is not None, options.get("sort_order"))


def comparison_of(grouped: DataFrame, by_value: bool = False, sort_order: str | None = None) -> DataFrame:
    """The difference of two ``group, value`` rows, in order of the groups or of the values."""
    if not by_value:
        order = F.struct(F.col("group"))
    elif sort_order == "asc":
        order = F.struct(F.col("value"), F.col("group"))
    else:
        order = F.struct(-F.col("value"), F.col("group"))
    pair = F.struct("group", "value")
    both = (
        grouped.where(F.col("value").isNotNull())
        .agg(F.count("*").alias("n"), F.min_by(pair, order).alias("a"), F.max_by(pair, order).alias("b"))
        .where(F.col("n") == 2)
    )
    v1, v2 = F.col("a.value"), F.col("b.value")
    gap = rounded(F.abs(v2 - v1), 2)
    return both.select(
        F.col("a.group").alias("group_1"),
        v1.alias("value_1"),
        F.col("b.group").alias("group_2"),
        v2.alias("value_2"),
        gap.alias("absolute_difference"),
        percent_difference(gap, v1, v2).alias("percentage_difference"),
        percent_change(v1, v2).alias("percentage_change"),
    )
