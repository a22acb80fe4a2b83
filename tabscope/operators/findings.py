"""Noteworthy results of the operators, collected in one table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.functions.columns import numeric_columns, require_frame
from tabscope.operators.changes import change_highlights, overall_change
from tabscope.operators.correlation import correlation_extremes
from tabscope.operators.groupby import comparison_of, extremes_of, groupby_analysis, ranking_of
from tabscope.operators.missing import missing_values
from tabscope.operators.outliers import outlier_analysis
from tabscope.operators.statistics import statistics
from tabscope.operators.timeseries import series_summary

# Thresholds.
NOTABLE_SKEWNESS = 1.0
NOTABLE_VARIATION = 1.0
FEW_OBSERVATIONS = 3


def _row(operator: str, subject: Column, finding: Column | str, value: Column, detail: Column | None = None):
    return F.struct(
        F.lit(operator).alias("operator"),
        subject.cast("string").alias("subject"),
        (F.lit(finding) if isinstance(finding, str) else finding).alias("finding"),
        value.cast("double").alias("value"),
        (F.lit(None) if detail is None else detail).cast("string").alias("detail"),
    )


def _rows(df: DataFrame, *rows: Column) -> DataFrame:
    """The given rows per input row; a NULL row is left out."""
    return df.select(F.explode(F.array_compact(F.array(*rows))).alias("f")).select("f.*")


def _top(df: DataFrame, leading: int | None, *order: Column) -> DataFrame:
    return df if leading is None else df.orderBy(*order).limit(leading)


def statistics_findings(result: DataFrame) -> DataFrame:
    """Skewed, highly variable and thinly filled columns, from ``statistics``."""
    subject, skew, cv = F.col("column"), F.col("skewness"), F.col("coefficient_of_variation")
    return _rows(
        result,
        F.when(skew > NOTABLE_SKEWNESS, _row("statistics", subject, "right skewed", skew)),
        F.when(skew < -NOTABLE_SKEWNESS, _row("statistics", subject, "left skewed", skew)),
        F.when(cv > NOTABLE_VARIATION, _row("statistics", subject, "high variability", cv)),
        F.when(F.col("count") < FEW_OBSERVATIONS, _row("statistics", subject, "limited data", F.col("count"))),
    )


def missing_findings(result: DataFrame, leading: int | None = None) -> DataFrame:
    """The most affected columns, from ``missing_values``."""
    top = _top(result, leading, F.col("missing_percentage").desc(), F.col("column"))
    return _rows(
        top,
        _row("missing_values", F.col("column"), "most affected", F.col("missing_percentage"), F.col("missing_count")),
    )


def outlier_findings(result: DataFrame, leading: int | None = None) -> DataFrame:
    """The columns with the most outliers, from ``outlier_analysis``."""
    top = _top(result.where(F.col("outlier_count") > 0), leading, F.col("outlier_count").desc(), F.col("column"))
    return _rows(
        top,
        _row("outlier_analysis", F.col("column"), "outliers", F.col("outlier_count"), F.col("outlier_percentage")),
    )


def correlation_findings(result: DataFrame) -> DataFrame:
    """The strongest positive and negative pair, from ``correlation_extremes``."""
    pair = F.concat_ws(" & ", "column_1", "column_2")
    kind = F.regexp_replace("kind", "_", " ")
    return _rows(result, _row("correlation_analysis", pair, kind, F.col("correlation")))


def series_findings(result: DataFrame, subject: str) -> DataFrame:
    """Trend, extremes and overall change, from ``series_summary``."""
    on, known = F.lit(subject), F.col("total_periods") >= 2
    return _rows(
        result,
        F.when(
            known, _row("time_analysis", on, "trend direction", F.lit(None), F.col("trend_direction"))
        ),
        F.when(
            F.col("best_period").isNotNull(),
            _row("time_analysis", on, "best period", F.col("best_value"), F.col("best_period")),
        ),
        F.when(
            F.col("worst_period") != F.col("best_period"),
            _row("time_analysis", on, "worst period", F.col("worst_value"), F.col("worst_period")),
        ),
        F.when(
            known,
            _row(
                "time_analysis", on, "overall change", F.col("overall_change"), F.col("overall_percentage_change")
            ),
        ),
        F.when(
            F.col("total_periods") < FEW_OBSERVATIONS,
            _row("time_analysis", on, "limited data", F.col("total_periods")),
        ),
    )


def change_findings(highlights: DataFrame, overall: DataFrame, subject: str) -> DataFrame:
    """Largest increase and decrease and the overall change between periods."""
    on = F.lit(subject)
    kind = F.regexp_replace("kind", "_", " ")
    largest = highlights.where(F.col("kind") != "latest_change")
    return _rows(
        largest, _row("percentage_change", on, kind, F.col("percentage_change"), F.col("current_period"))
    ).unionByName(
        _rows(
            overall,
            _row(
                "percentage_change", on, "overall change across all periods", F.col("overall_change"),
                F.col("overall_percentage_change"),
            ),
        )
    )


def group_findings(
    extremes: DataFrame, ranking: DataFrame, comparison: DataFrame, subject: str, leading: int | None = None
) -> DataFrame:
    """Best and worst group, leading ranking and the difference of two groups."""
    on = F.lit(subject)
    best = _rows(
        extremes,
        F.when(
            F.col("best_group").isNotNull(),
            _row("groupby_analysis", on, "best group", F.col("best_value"), F.col("best_group")),
        ),
        F.when(
            F.col("worst_group") != F.col("best_group"),
            _row("groupby_analysis", on, "worst group", F.col("worst_value"), F.col("worst_group")),
        ),
    )
    leading = _rows(
        ranking if leading is None else ranking.where(F.col("rank") <= leading),
        _row(
            "groupby_analysis", on, F.concat(F.lit("rank "), F.col("rank").cast("string")), F.col("value"),
            F.col("group"),
        ),
    )
    two = _rows(
        comparison,
        _row(
            "groupby_analysis", on, "absolute difference", F.col("absolute_difference"),
            F.concat_ws(" vs ", F.col("group_1").cast("string"), F.col("group_2").cast("string")),
        ),
    )
    return best.unionByName(leading).unionByName(two)


def findings(
    df: DataFrame,
    date_column: str | None = None,
    value_column: str | None = None,
    group_column: str | None = None,
    period: str = "month",
    agg_function: str = "mean",
    leading: int | None = None,
) -> DataFrame:
    """Noteworthy results for one table: ``operator, subject, finding, value, detail``.

    Missing values always; statistics, outliers and correlations when there are
    numeric columns; trend and changes of ``value_column`` with a
    ``date_column``; group comparison with a ``group_column``. With ``leading``
    only so many columns with gaps or outliers and ranked groups.
    """
    require_frame(df)
    parts = [missing_findings(missing_values(df), leading)]
    numeric = numeric_columns(df)
    if numeric:
        parts += [statistics_findings(statistics(df)), outlier_findings(outlier_analysis(df), leading)]
    if len(numeric) > 1:
        parts.append(correlation_findings(correlation_extremes(df)))
    if date_column and value_column:
        parts += [
            series_findings(series_summary(df, date_column, value_column, period, agg_function), value_column),
            change_findings(
                change_highlights(df, date_column, value_column, period),
                overall_change(df, date_column, value_column, period),
                value_column,
            ),
        ]
    if group_column and value_column:
        groups = groupby_analysis(df, group_column, value_column, agg_function)
        parts.append(
            group_findings(extremes_of(groups), ranking_of(groups), comparison_of(groups), value_column, leading)
        )
    return reduce(DataFrame.unionByName, parts)
