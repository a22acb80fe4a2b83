"""What the columns of a table are: type, completeness, cardinality, role."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscope.functions.arithmetic import rounded
from tabscope.functions.columns import col, family_of, is_float, present, require_frame, stacked
from tabscope.functions.names import looks_like_identifier
from tabscope.operators.missing import missing_counts
from tabscope.sources.dates import detect_date_columns

# Sample values per column, most distinct values of a group column.
MAX_SAMPLES = 5
MAX_GROUP_VALUES = 50

# Longer texts are compared by the SHA-256 of the whole text, so that counting
# distinct documents does not move the documents.
_LONG_TEXT = 256

_SCHEMA = (
    "position int, column string, dtype string, semantic_type string, row_count bigint, null_count bigint, "
    "null_percentage double, unique_count bigint, uniqueness_ratio double, is_constant boolean, "
    "is_all_null boolean, identifier_status string, is_candidate_group boolean, date_format string, "
    "date_confidence double"
)


def comparable_text(df: DataFrame, name: str) -> Column:
    """A text that is equal exactly when the values are equal, NULL when missing."""
    value = present(df, name)
    if is_float(df.schema[name].dataType):
        return (value + F.lit(0.0)).cast("string")  # -0.0 counts as 0.0
    text = value.cast("string")
    if family_of(df.schema[name].dataType) in ("text", "other"):
        whole = F.concat(F.lit("#"), F.sha2(text.cast("binary"), 256))
        return F.when(F.length(text) > _LONG_TEXT, whole).otherwise(F.concat(F.lit("="), text))
    return text


_WHOLE = ("tinyint", "smallint", "int", "bigint", "date")


def _distinct_counts(df: DataFrame) -> DataFrame:
    """``position, unique_count``, exact: one shuffle of what is different.

    Whole numbers and dates are bits of words of 64, which are combined before
    the shuffle: dense ids move a word for every 64 of them, sparse ones a word
    each. Other values move as distinct (column, value) pairs.
    """
    kinds = [f.dataType.simpleString() for f in df.schema.fields]
    whole = [i for i, kind in enumerate(kinds) if kind in _WHOLE]
    other = [i for i, kind in enumerate(kinds) if kind not in _WHOLE]
    counts = []
    if whole:
        numbers = [F.unix_date(col(df.columns[i])) if kinds[i] == "date" else col(df.columns[i]) for i in whole]
        counts.append(
            _stacked_at(df, whole, [n.cast("bigint") for n in numbers])
            .groupBy("position", F.shiftright("value", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(value & 63 AS int))")).alias("bits"))
            .groupBy("position")
            .agg(F.sum(F.bit_count("bits")).alias("unique_count"))
        )
    if other:
        counts.append(
            _stacked_at(df, other, [comparable_text(df, df.columns[i]) for i in other])
            .distinct()
            .groupBy("position")
            .agg(F.count("*").alias("unique_count"))
        )
    return reduce(DataFrame.unionByName, counts)


def _stacked_at(df: DataFrame, places: list[int], cells: list[Column]) -> DataFrame:
    """``position, value`` of the cells that hold one, positions being the given places."""
    rows = stacked(df, cells).where(F.col("value").isNotNull())
    return rows.withColumn("position", F.element_at(F.array(*[F.lit(i) for i in places]), F.col("position") + 1))


def _approximate_counts(df: DataFrame) -> DataFrame:
    """The same from one sketch per column, without any shuffle of values."""
    wide = df.agg(*[F.approx_count_distinct(comparable_text(df, c)).alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows = [F.struct(F.lit(i).alias("position"), F.col(f"c{i}").alias("unique_count")) for i in range(len(df.columns))]
    return wide.select(F.inline(F.array(*rows)))


def _by_column(values: dict[str, object], column: Column, default: Column) -> Column:
    """A schema fact looked up by column name."""
    if not values:
        return default
    entries = [x for k, v in values.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.try_element_at(F.create_map(*entries), column), default)


def dataset_info(df: DataFrame, approx: bool = False) -> DataFrame:
    """One row per column: type, missing values, distinct values and role.

    ``semantic_type`` is datetime (also for text recognised as dates), boolean,
    numeric or categorical. ``identifier_status`` is detected for (nearly)
    unique columns with an identifier-like name, possible for unique text or
    integer columns. ``is_candidate_group`` marks categorical and boolean
    columns with 2 to 50 values that are not detected identifiers. An empty
    table gives no rows. ``approx`` estimates the distinct counts.
    """
    require_frame(df)
    if not df.columns:
        return df.sparkSession.createDataFrame([], _SCHEMA)
    fields = df.schema.fields
    position = {f.name: i for i, f in enumerate(fields)}
    kinds = {
        f.name: {"other": "categorical", "text": "categorical"}.get(family_of(f.dataType), family_of(f.dataType))
        for f in fields
    }
    id_names = [f.name for f in fields if looks_like_identifier(f.name)]
    floats = [f.name for f in fields if is_float(f.dataType)]

    column = F.col("column")
    distinct = _approximate_counts(df) if approx else _distinct_counts(df)
    dates = detect_date_columns(df).select(
        "column", F.col("format").alias("date_format"), F.col("confidence").alias("date_confidence")
    )
    # Every side has one row per column of the table.
    base = (
        missing_counts(df)
        .where(F.col("row_count") > 0)
        .withColumn("position", _by_column(position, column, F.lit(-1)))
        .join(F.broadcast(distinct), "position", "left")
        .join(F.broadcast(dates), "column", "left")
        .withColumn("unique_count", F.coalesce("unique_count", F.lit(0)).cast("bigint"))
    )
    rows, nulls, unique = F.col("row_count"), F.col("null_count"), F.col("unique_count")
    valid = F.col("row_count") - F.col("null_count")
    ratio, kind = F.col("uniqueness_ratio"), F.col("semantic_type")
    named = column.isin(id_names)
    shaped = base.withColumnRenamed("missing_count", "null_count").withColumns(
        {
            "dtype": _by_column({f.name: f.dataType.simpleString() for f in fields}, column, F.lit("")),
            "semantic_type": F.when(F.col("date_format").isNotNull(), "datetime").otherwise(
                _by_column(kinds, column, F.lit("categorical"))
            ),
            "null_percentage": rounded(100 * nulls / rows, 2),
            "uniqueness_ratio": F.coalesce(rounded(F.try_divide(unique, valid), 3), F.lit(0.0)),
            "is_all_null": nulls == rows,
            "is_constant": unique == 1,
        }
    )
    status = (
        F.when(named & (valid >= 5) & (ratio == 1.0), "detected")
        .when(named & (valid >= 10) & (ratio >= 0.95), "detected")
        .when(
            (valid >= 10)
            & (ratio == 1.0)
            & kind.isin("categorical", "numeric")
            & ~column.isin(floats)
            & ~F.col("is_constant"),
            "possible",
        )
    )
    groupable = (
        kind.isin("categorical", "boolean")
        & (unique > 1)
        & (unique <= MAX_GROUP_VALUES)
        & ~F.equal_null(F.col("identifier_status"), F.lit("detected"))
    )
    return (
        shaped.withColumn("identifier_status", status)
        .withColumn("is_candidate_group", groupable)
        .select(*[name.split()[0] for name in _SCHEMA.split(", ")])
        .orderBy("position")
    )


def potential_identifiers(df: DataFrame, approx: bool = False) -> DataFrame:
    """Columns that look like identifiers: ``column, status, uniqueness_ratio, unique_count``."""
    return (
        dataset_info(df, approx)
        .where(F.col("identifier_status").isNotNull())
        .select("column", F.col("identifier_status").alias("status"), "uniqueness_ratio", "unique_count")
    )


def candidate_group_columns(df: DataFrame, approx: bool = False) -> DataFrame:
    """Columns suited for grouping: ``column, unique_count``."""
    return dataset_info(df, approx).where("is_candidate_group").select("column", "unique_count")


def sample_values(df: DataFrame, columns: Sequence[str] | None = None, samples: int = MAX_SAMPLES) -> DataFrame:
    """The smallest distinct values of text and boolean columns: ``column, rank, value``.

    Text columns that hold dates are left out unless they are named.

    Every task keeps only ``samples`` values per column; the final selection
    sees that many values per task and column.
    """
    require_frame(df)
    names = list(columns) if columns is not None else [
        f.name for f in df.schema.fields if family_of(f.dataType) in ("text", "boolean", "other")
    ]
    spark = df.sparkSession
    if not names:
        return spark.createDataFrame([], "column string, rank int, value string")
    texts = df.select(*[col(c).cast("string").alias(f"c{i}") for i, c in enumerate(names)])

    def smallest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[str, list[str]] = {name: [] for name in names}
        for batch in batches:
            for name, label in zip(names, batch.columns):
                fresh = set(batch[label].dropna().unique()).union(kept[name])
                # UTF-8 order, the order in which Spark compares strings.
                kept[name] = sorted(fresh, key=lambda v: v.encode())[:samples]
        yield pd.DataFrame([(n, v) for n, values in kept.items() for v in values], columns=["column", "value"])

    partial = texts.mapInPandas(smallest, "column string, value string").distinct()
    in_order = Window.partitionBy("column").orderBy("value")
    ranked = partial.withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= samples)
    if columns is None:
        ranked = ranked.join(F.broadcast(detect_date_columns(df).select("column")), "column", "left_anti")
    return ranked.select("column", "rank", "value")
