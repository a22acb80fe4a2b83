"""Row filters: by value, by calendar year and by date range.

The predicates compare the bare column with literals, so that they reach the
``PushedFilters`` of a columnar scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from decimal import Decimal, InvalidOperation

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscope.errors import AnalysisError
from tabscope.functions.columns import col, family_of, is_float, is_integer, type_of


def _numbers(values: Sequence[str], parse) -> list:
    out = []
    for v in values:
        try:
            out.append(parse(v))
        except (ValueError, InvalidOperation):
            continue
    return out


def _canonical_int(text: str) -> int:
    value = int(text)
    if str(value) != text:
        raise ValueError(text)
    return value


def matches(df: DataFrame, name: str, values: Sequence) -> Column:
    """Whether the column equals one of ``values``, compared by their string forms.

    ``20`` and ``"20"`` select the same rows; floating-point columns compare by
    number and date columns by the point in time.
    """
    data_type, c = type_of(df, name), col(name)
    texts = [str(v) for v in values]
    if is_integer(data_type):
        return c.isin(_numbers(texts, _canonical_int))
    if is_float(data_type):
        return c.isin([float(v) for v in _numbers(texts, float) if v == v])
    if isinstance(data_type, T.DecimalType):
        return c.isin(_numbers(texts, Decimal))
    if family_of(data_type) == "boolean":
        return c.isin([t == "True" for t in texts if t in ("True", "False")])
    if family_of(data_type) == "datetime":
        stamps = [F.lit(str(pd.Timestamp(t))).cast(data_type) for t in texts if _parses(t)]
        return c.isin(stamps) if stamps else F.lit(False)
    return c.cast("string").isin(texts)


def _parses(text: str) -> bool:
    try:
        return not pd.isna(pd.Timestamp(text))
    except ValueError:
        return False


def where_values(df: DataFrame, name: str | None, values: Sequence | None) -> DataFrame:
    """Keep rows whose column matches ``values``; no values means no restriction."""
    return df.where(matches(df, name, values)) if name is not None and values else df


def _start_of_year(year: int, data_type: T.DataType) -> Column:
    return F.lit(f"{year:04d}-01-01").cast(data_type)


def in_year(df: DataFrame, name: str, year: int) -> Column:
    """The calendar year as a half-open range, which a scan can use for pruning."""
    data_type = type_of(df, name)
    return (col(name) >= _start_of_year(year, data_type)) & (col(name) < _start_of_year(year + 1, data_type))


def _bound(which: str, text: str | dt.date) -> pd.Timestamp:
    try:
        stamp = pd.to_datetime(text)
    except (ValueError, TypeError):
        stamp = pd.NaT
    if pd.isna(stamp):
        raise AnalysisError("bad_date", f"'{text}' is no date for {which}; write it as 2024-12-31.")
    return stamp.tz_localize(None) if stamp.tzinfo else stamp


def where_dates(
    df: DataFrame,
    name: str,
    year: int | None = None,
    start_date: str | dt.date | None = None,
    end_date: str | dt.date | None = None,
) -> DataFrame:
    """Restrict to a year and to ``[start_date, end_date]``.

    An ``end_date`` without a time means midnight, so later times of that day
    are outside the range.
    """
    data_type, c = type_of(df, name), col(name)
    if year is not None:
        df = df.where(in_year(df, name, year))
    if start_date is not None:
        start = _bound("start_date", start_date)
        first = F.lit(str(start)).cast(data_type)
        # A date is midnight, which lies before a bound later that day.
        later = isinstance(data_type, T.DateType) and start != start.normalize()
        df = df.where(c > first if later else c >= first)
    if end_date is not None:
        df = df.where(c <= F.lit(str(_bound("end_date", end_date))).cast(data_type))
    return df
