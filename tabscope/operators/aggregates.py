"""Aggregates of one value per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscope.functions.columns import col, is_integer, number, present, require_choice, require_column, require_numeric, type_of
from tabscope.operators.quantiles import has_few_groups, quantiles

AGGREGATES = ("mean", "sum", "count", "min", "max", "median", "std")


def check_aggregate(df: DataFrame, value_column: str, agg_function: str) -> None:
    """The value column exists, the aggregate is known and applicable to it."""
    require_column(df, value_column)
    require_choice("Aggregation function", agg_function, AGGREGATES)
    if agg_function != "count":
        require_numeric(df, value_column, f"there is no {agg_function} of it")


def aggregate(
    keyed: DataFrame,
    keys: Sequence[str],
    agg_function: str,
    few_groups: bool | None = None,
) -> DataFrame:
    """Aggregate the column ``value`` of ``keyed`` per group: ``keys, rows, value``.

    ``value`` comes from ``value_for``: integers and decimals are added up and
    compared as such, and only the result becomes a double. Every aggregate but the
    median combines partially before the shuffle; the median goes through
    ``quantiles``. ``rows`` is the number of non-null values.
    """
    if agg_function == "median":
        if few_groups is None:
            few_groups = has_few_groups(keyed, keys)
        result = quantiles(keyed, keys, "value", [0.5], few_groups)
        return result.select(*keys, F.col("n").alias("rows"), F.col("q")[0].alias("value"))
    v = F.col("value")
    how = {
        "mean": F.avg(v),
        "sum": F.coalesce(F.sum(v).cast("double"), F.lit(0.0)),
        "count": F.count(v).cast("double"),
        "min": F.min(v).cast("double"),
        "max": F.max(v).cast("double"),
        "std": F.stddev_samp(v),
    }[agg_function]
    return keyed.groupBy(*keys).agg(F.count(v).alias("rows"), how.alias("value"))


def value_for(df: DataFrame, value_column: str, agg_function: str):
    """The column to hand to ``aggregate`` under the name ``value``."""
    if agg_function == "count":
        return present(df, value_column)
    kind = type_of(df, value_column)
    if agg_function in ("sum", "min", "max") and isinstance(kind, T.DecimalType):
        return col(value_column)
    if agg_function in ("sum", "min", "max") and is_integer(kind):
        return col(value_column).cast("decimal(19,0)")  # a sum that can't overflow
    return number(df, value_column)
