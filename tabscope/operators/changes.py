"""Change from one period to the next, and between two years."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscope.errors import AnalysisError
from tabscope.functions.arithmetic import percent_change, percent_difference, rounded
from tabscope.functions.columns import col, drop_missing, require_rows
from tabscope.functions.filters import in_year, where_values
from tabscope.functions.periods import period_label
from tabscope.operators.aggregates import aggregate, value_for
from tabscope.operators.timeseries import bucketed, check_series

CHANGE_COLUMNS = (
    "previous_period",
    "current_period",
    "previous_value",
    "current_value",
    "absolute_change",
    "percentage_change",
)


def _scoped(
    df: DataFrame,
    date_column: str,
    value_column: str,
    period: str,
    agg_function: str,
    group_column: str | None,
    filter_values: Sequence | None,
    strict: bool,
) -> DataFrame:
    check_series(df, date_column, value_column, period, agg_function, group_column)
    rows = where_values(drop_missing(df, [date_column, value_column]), group_column, filter_values)
    if strict:
        require_rows(rows, "The filters leave nothing.")
    return rows


def _all_changes(
    df: DataFrame,
    date_column: str,
    value_column: str,
    period: str | None,
    agg_function: str | None,
    group_column: str | None,
    filter_values: Sequence | None,
    strict: bool,
) -> DataFrame:
    period, agg_function = period or "month", agg_function or "sum"
    rows = _scoped(df, date_column, value_column, period, agg_function, group_column, filter_values, strict)
    series = bucketed(rows, date_column, value_column, period, agg_function).where(F.col("value").isNotNull())
    in_order = Window.orderBy("period_start")
    previous, current = F.col("before"), F.col("value")
    return (
        series.withColumns(
            {"before": F.lag("value").over(in_order), "before_start": F.lag("period_start").over(in_order)}
        )
        .where(F.col("before_start").isNotNull())
        .select(
            "period_start",
            period_label(F.col("before_start"), period).alias("previous_period"),
            period_label(F.col("period_start"), period).alias("current_period"),
            rounded(previous, 2).alias("previous_value"),
            rounded(current, 2).alias("current_value"),
            rounded(current - previous, 2).alias("absolute_change"),
            percent_change(previous, current).alias("percentage_change"),
        )
    )


def percentage_change(
    df: DataFrame,
    date_column: str,
    value_column: str,
    period: str | None = "month",
    agg_function: str | None = "sum",
    year_1: int | None = None,
    year_2: int | None = None,
    group_column: str | None = None,
    filter_values: Sequence | None = None,
    max_changes: int | None = None,
    strict: bool = False,
) -> DataFrame:
    """Change between neighbouring periods that exist (gaps are not filled).

    Columns: previous and current period, their values, the absolute and the
    percentage change (NULL on a zero base), in order; with ``max_changes`` only
    the latest. ``filter_values`` restricts the rows by
    ``group_column``; there is no result per group. ``strict`` raises when fewer
    than two periods hold data. With ``year_1`` and ``year_2`` the two years are
    compared instead, see ``compare_years``.
    """
    if year_1 is not None or year_2 is not None:
        return compare_years(
            df, date_column, value_column, year_1, year_2, agg_function, group_column, filter_values, strict
        )
    changes = _all_changes(
        df, date_column, value_column, period, agg_function, group_column, filter_values, strict
    )
    if strict and changes.isEmpty():
        raise AnalysisError("too_few_periods", "A comparison needs two periods with data; there are fewer.")
    if max_changes is not None:
        changes = changes.orderBy(F.col("period_start").desc()).limit(max_changes)
    return changes.orderBy("period_start").select(*CHANGE_COLUMNS)


def change_highlights(
    df: DataFrame,
    date_column: str,
    value_column: str,
    period: str | None = "month",
    agg_function: str | None = "sum",
    group_column: str | None = None,
    filter_values: Sequence | None = None,
    strict: bool = False,
) -> DataFrame:
    """The latest change and the largest increase and decrease by percentage.

    One row per ``kind`` over the full range; the earliest change wins a tie.
    """
    changes = _all_changes(
        df, date_column, value_column, period, agg_function, group_column, filter_values, strict
    )
    change, pct, at = F.struct(*CHANGE_COLUMNS), F.col("percentage_change"), F.col("period_start")
    known = pct.isNotNull()
    picks: dict[str, Column] = {
        "latest_change": F.max_by(change, at),
        "largest_increase": F.min_by(change, F.when(known, F.struct(-pct, at))),
        "largest_decrease": F.min_by(change, F.when(known, F.struct(pct, at))),
    }
    one = changes.agg(*[c.alias(k) for k, c in picks.items()])
    rows = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("change")) for k in picks])
    return one.select(F.inline(rows)).where(F.col("change").isNotNull()).select("kind", "change.*")


def overall_change(
    df: DataFrame,
    date_column: str,
    value_column: str,
    period: str | None = "month",
    agg_function: str | None = "sum",
    group_column: str | None = None,
    filter_values: Sequence | None = None,
    strict: bool = False,
) -> DataFrame:
    """Change from the first to the last period, from rounded values, in one row."""
    changes = _all_changes(
        df, date_column, value_column, period, agg_function, group_column, filter_values, strict
    )
    ends = changes.agg(
        F.count("*").alias("total_periods_compared"),
        F.min_by("previous_value", "period_start").alias("first_value"),
        F.max_by("current_value", "period_start").alias("last_value"),
    ).where(F.col("total_periods_compared") > 0)
    first, last = F.col("first_value"), F.col("last_value")
    return ends.select(
        "*",
        rounded(last - first, 2).alias("overall_change"),
        percent_change(first, last).alias("overall_percentage_change"),
    )


def compare_years(
    df: DataFrame,
    date_column: str,
    value_column: str,
    year_1: int | None,
    year_2: int | None,
    agg_function: str | None = "sum",
    group_column: str | None = None,
    filter_values: Sequence | None = None,
    strict: bool = False,
) -> DataFrame:
    """One calendar year against another, in one row.

    The result is empty when either year has no data (``strict``: raises). Both
    years are range conditions on the date column, so other years are not read
    from a table partitioned or sorted by date.
    """
    agg_function = agg_function or "sum"
    if year_1 is None or year_2 is None:
        raise AnalysisError("two_years", "Two years are compared; one is missing.")
    rows = _scoped(df, date_column, value_column, "year", agg_function, group_column, filter_values, strict)
    first, second = in_year(rows, date_column, year_1), in_year(rows, date_column, year_2)
    if strict:
        for year, condition in ((year_1, first), (year_2, second)):
            require_rows(rows.where(condition), f"The table is empty in {year}.")
    keyed = rows.where(first | second).select(
        F.year(col(date_column)).alias("year"), value_for(rows, value_column, agg_function).alias("value")
    )
    per_year = aggregate(keyed, ["year"], agg_function, few_groups=True)
    v1, v2 = F.col("v1"), F.col("v2")
    gap = rounded(v2 - v1, 2)
    return (
        per_year.agg(
            F.max(F.when(F.col("year") == year_1, F.col("value"))).alias("v1"),
            F.max(F.when(F.col("year") == year_2, F.col("value"))).alias("v2"),
            F.max((F.col("year") == year_1).cast("int")).alias("has_1"),
            F.max((F.col("year") == year_2).cast("int")).alias("has_2"),
        )
        .where((F.col("has_1") == 1) & (F.col("has_2") == 1))
        .select(
            F.lit(str(year_1)).alias("previous_period"),
            F.lit(str(year_2)).alias("current_period"),
            rounded(v1, 2).alias("previous_value"),
            rounded(v2, 2).alias("current_value"),
            gap.alias("absolute_change"),
            percent_change(v1, v2).alias("percentage_change"),
            percent_difference(F.abs(gap), v1, v2).alias("percentage_difference"),
            F.when(v2 > v1, "increased").when(v2 < v1, "decreased").otherwise("unchanged").alias(
                "comparison_summary"
            ),
        )
    )
