"""Values over calendar periods, with extremes, overall change and trend."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabscope.errors import AnalysisError
from tabscope.functions.arithmetic import percent_change, rounded
from tabscope.functions.columns import (
    col,
    drop_missing,
    present,
    require_choice,
    require_column,
    require_datetime,
    require_frame,
    require_rows,
)
from tabscope.functions.filters import where_dates, where_values
from tabscope.functions.periods import PERIODS, period_label, period_start
from tabscope.operators.aggregates import aggregate, check_aggregate, value_for


def check_series(
    df: DataFrame, date_column: str, value_column: str, period: str, agg_function: str, group_column: str | None
) -> None:
    require_frame(df)
    require_column(df, date_column)
    require_datetime(df, date_column)
    check_aggregate(df, value_column, agg_function)
    require_choice("Time period", period, PERIODS)
    if group_column is not None:
        require_column(df, group_column)


def bucketed(
    rows: DataFrame, date_column: str, value_column: str, period: str, agg_function: str, by: str | None = None
) -> DataFrame:
    """Unrounded aggregate per period (and group), unordered: ``period_start[, group], value``.

    There are at most 40,000 quarters and years in the range of a timestamp, so
    those need not be counted before per-period results are broadcast.
    """
    keys, columns = ["period_start"], [period_start(col(date_column), period).alias("period_start")]
    if by is not None:
        keys.append("group")
        columns.append(present(rows, by).alias("group"))
    bounded = by is None and period in ("quarter", "year")
    keyed = rows.select(*columns, value_for(rows, value_column, agg_function).alias("value"))
    if by is not None:
        keyed = keyed.where(F.col("group").isNotNull())
    return aggregate(keyed, keys, agg_function, few_groups=bounded or None)


def time_analysis(
    df: DataFrame,
    date_column: str,
    value_column: str,
    period: str = "month",
    agg_function: str = "mean",
    year: int | None = None,
    start_date: str | None = None,
    end_date: str | None = None,
    group_column: str | None = None,
    filter_values: Sequence | None = None,
    max_groups: int | None = None,
    strict: bool = False,
) -> DataFrame:
    """A value per calendar period, in order: ``period_start, period, value``.

    Rows without a date or value are dropped first, results are rounded to 2
    decimals. With ``group_column`` there is one row per period and group (a
    ``group`` column is added, rows without a group are dropped, and
    ``filter_values`` restricts the groups). With ``max_groups`` more groups than
    that raise, at the price of one job over that column. ``strict`` raises when
    no row is left.
    """
    check_series(df, date_column, value_column, period, agg_function, group_column)
    rows = where_dates(drop_missing(df, [date_column, value_column]), date_column, year, start_date, end_date)
    rows = where_values(rows, group_column, filter_values)
    if strict:
        require_rows(rows, "The filters leave nothing.")
    if group_column is not None and max_groups is not None:
        seen = rows.select(present(rows, group_column).alias("g")).where("g IS NOT NULL").distinct()
        if seen.limit(max_groups + 1).count() > max_groups:
            raise AnalysisError(
                "too_many_groups",
                f"There are over {max_groups} groups in '{group_column}'; name some in filter_values.",
            )
    series = bucketed(rows, date_column, value_column, period, agg_function, group_column)
    group = [] if group_column is None else ["group"]
    return series.select(
        "period_start",
        period_label(F.col("period_start"), period).alias("period"),
        *group,
        rounded("value", 2).alias("value"),
    ).orderBy("period_start", *group)


def pivot_series(series: DataFrame, groups: Sequence) -> DataFrame:
    """A grouped time series with one column per listed group."""
    wide = series.groupBy("period_start", "period").pivot("group", list(groups)).agg(F.first("value"))
    return wide.orderBy("period_start")


def series_summary(
    df: DataFrame,
    date_column: str,
    value_column: str,
    period: str = "month",
    agg_function: str = "mean",
    year: int | None = None,
    start_date: str | None = None,
    end_date: str | None = None,
    strict: bool = False,
) -> DataFrame:
    """Best and worst period, change from first to last period, and trend, in one row.

    Computed on the rounded values of ``time_analysis``; the earliest period wins
    a tie. Trends: insufficient_data, stable, strictly_increasing,
    strictly_decreasing, increasing, decreasing, fluctuating.
    """
    check_series(df, date_column, value_column, period, agg_function, None)
    rows = where_dates(drop_missing(df, [date_column, value_column]), date_column, year, start_date, end_date)
    if strict:
        require_rows(rows, "The filters leave nothing.")
    series = bucketed(rows, date_column, value_column, period, agg_function).select(
        "period_start", rounded("value", 2).alias("value")
    )
    start, value = F.col("period_start"), F.col("value")
    in_order = Window.orderBy("period_start")
    facts = (
        series.where(value.isNotNull())
        .withColumn("next", F.lead("value").over(in_order))
        .agg(
            F.min_by(start, F.struct(-value, start)).alias("best"),
            F.max(value).alias("best_value"),
            F.min_by(start, F.struct(value, start)).alias("worst"),
            F.min(value).alias("worst_value"),
            F.count("*").alias("total_periods"),
            F.min_by(value, start).alias("first"),
            F.max_by(value, start).alias("last"),
            F.bool_and(value < F.col("next")).alias("up"),
            F.bool_and(value > F.col("next")).alias("down"),
        )
    )
    enough = F.col("total_periods") >= 2
    first, last = F.col("first"), F.col("last")
    trend = (
        F.when(~enough, "insufficient_data")
        .when(F.col("best_value") == F.col("worst_value"), "stable")
        .when(F.col("up"), "strictly_increasing")
        .when(F.col("down"), "strictly_decreasing")
        .when(last > first, "increasing")
        .when(last < first, "decreasing")
        .otherwise("fluctuating")
    )
    return facts.select(
        F.when(F.col("best").isNotNull(), period_label(F.col("best"), period)).alias("best_period"),
        "best_value",
        F.when(F.col("worst").isNotNull(), period_label(F.col("worst"), period)).alias("worst_period"),
        "worst_value",
        "total_periods",
        trend.alias("trend_direction"),
        F.when(enough, rounded(last - first, 2)).alias("overall_change"),
        F.when(enough, percent_change(first, last)).alias("overall_percentage_change"),
    )
