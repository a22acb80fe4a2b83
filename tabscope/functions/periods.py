"""Calendar buckets and their labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabscope.errors import AnalysisError

PERIODS = ("day", "week", "month", "quarter", "year")


def period_start(when: Column, period: str) -> Column:
    """Start of the period containing ``when``, as a timestamp without time zone.

    Weeks start on Monday. Going through the calendar date keeps the result
    independent of the session time zone for zone-free input.
    """
    if period not in PERIODS:
        raise AnalysisError("unsupported", f"'{period}' is no period.", PERIODS)
    day = when.cast("date")
    return (day if period == "day" else F.trunc(day, period)).cast("timestamp_ntz")


def period_label(start: Column, period: str) -> Column:
    """Text of a period start: 2024-03-15, Week of 2024-03-11, 2024-03, 2024-Q1 or 2024."""
    if period not in PERIODS:
        raise AnalysisError("unsupported", f"'{period}' is no period.", PERIODS)
    day = start.cast("date")
    text = {
        "day": F.date_format(day, "yyyy-MM-dd"),
        "week": F.concat(F.lit("Week of "), F.date_format(day, "yyyy-MM-dd")),
        "month": F.date_format(day, "yyyy-MM"),
        "quarter": F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string")),
        "year": F.date_format(day, "yyyy"),
    }[period]
    return F.coalesce(text, F.lit("Unknown"))


def add_period_column(df, date_column: str, period: str, name: str = "period_start"):
    """The table with one more column: the start of the row's period."""
    from tabscope.functions.columns import col

    return df.withColumn(name, period_start(col(date_column), period))
