"""Missing values per column and in total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.functions.arithmetic import rounded
from tabscope.functions.columns import present, require_frame, rows_from_wide


def _counted(df: DataFrame) -> DataFrame:
    """One row: ``n`` rows and the non-missing values ``c0, c1, …`` of each column."""
    values = [F.count(present(df, name)).alias(f"c{i}") for i, name in enumerate(df.columns)]
    return df.agg(F.count(F.lit(1)).alias("n"), *values)


def missing_counts(df: DataFrame) -> DataFrame:
    """Rows and missing values of every column: ``column, row_count, missing_count``."""
    rows = [
        F.struct(F.lit(name).alias("column"), F.col("n").alias("row_count"), (F.col("n") - F.col(f"c{i}")).alias("missing_count"))
        for i, name in enumerate(df.columns)
    ]
    return rows_from_wide(_counted(df), rows)


def missing_values(df: DataFrame) -> DataFrame:
    """Columns with missing values: ``column, missing_count, missing_percentage``.

    NULL and NaN both count as missing. One scan, one aggregate.
    """
    require_frame(df)
    if not df.columns:
        return df.sparkSession.createDataFrame(
            [], "column string, missing_count bigint, missing_percentage double"
        )
    return (
        missing_counts(df)
        .where(F.col("missing_count") > 0)
        .select(
            "column",
            "missing_count",
            rounded(F.col("missing_count") / F.col("row_count") * 100, 2).alias("missing_percentage"),
        )
    )


def missing_totals(df: DataFrame) -> DataFrame:
    """``total_rows, total_missing_values, has_missing_values`` of a table, in one row."""
    require_frame(df)
    missing = F.lit(0).cast("bigint")
    for i in range(len(df.columns)):
        missing = missing + F.col("n") - F.col(f"c{i}")
    return _counted(df).select(
        F.col("n").alias("total_rows"),
        missing.alias("total_missing_values"),
        (missing > 0).alias("has_missing_values"),
    )
