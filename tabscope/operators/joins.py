"""Guarded equi joins of two tables on one key per side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscope.errors import AnalysisError
from tabscope.functions.columns import join_family_of, present, require_column, require_frame, type_of

JOIN_KINDS = ("inner", "left", "right", "outer")

# A key is hot if it has so many rows at least, and more than an even share of a
# shuffle partition; so there are fewer hot keys than partitions.
HOT_ROWS = 1_000_000


def _check_keys(left: DataFrame, right: DataFrame, left_on: str, right_on: str) -> None:
    require_frame(left)
    require_frame(right)
    require_column(left, left_on, "left dataset")
    require_column(right, right_on, "right dataset")
    kinds = [join_family_of(type_of(df, key)) for df, key in ((left, left_on), (right, right_on))]
    if kinds[0] != kinds[1]:
        raise AnalysisError(
            "incompatible_types",
            f"'{left_on}' ({type_of(left, left_on).simpleString()}) and '{right_on}' "
            f"({type_of(right, right_on).simpleString()}) are of unlike kinds; cast one first.",
        )


def key_counts(left: DataFrame, right: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """How often every key occurs on each side: ``key, in_left, in_right``.

    One shuffle of partially combined counts; missing keys form one group.
    """
    _check_keys(left, right, left_on, right_on)
    one, none = F.lit(1), F.lit(0)
    sides = left.select(present(left, left_on).alias("key"), one.alias("l"), none.alias("r")).unionAll(
        right.select(present(right, right_on).alias("key"), none.alias("l"), one.alias("r"))
    )
    return sides.groupBy("key").agg(F.sum("l").alias("in_left"), F.sum("r").alias("in_right"))


def _total(rows: Column) -> Column:
    """Sum of products that may exceed a bigint; larger totals saturate."""
    total = F.coalesce(F.sum(rows), F.lit(0))
    return F.least(total, F.lit(2**63 - 1)).cast("bigint")


def inspect_join_viability(left: DataFrame, right: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """Cardinality, row counts, missing keys and safety of a join, in one row.

    A side is unique when no key, a missing one included, occurs twice; only
    N:N is unsafe. ``inner_rows`` … ``outer_rows`` are the exact sizes of the
    four possible results, found from the key counts alone.
    """
    return _viability(key_counts(left, right, left_on, right_on)).drop("most_left", "most_right")


def _viability(counts: DataFrame) -> DataFrame:
    """What ``inspect_join_viability`` tells, and the rows of the most frequent key of each side."""
    l, r = F.col("in_left"), F.col("in_right")
    wide = "decimal(18,0)"
    both = l.cast(wide) * r.cast(wide)
    left_only = F.when(r == 0, l).otherwise(0).cast("decimal(38,0)")
    right_only = F.when(l == 0, r).otherwise(0).cast("decimal(38,0)")
    both = both.cast("decimal(38,0)")
    facts = counts.agg(
        F.coalesce(F.sum(l), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum(r), F.lit(0)).alias("right_rows"),
        F.coalesce(F.sum(F.when(F.col("key").isNull(), l)), F.lit(0)).alias("left_missing_keys"),
        F.coalesce(F.sum(F.when(F.col("key").isNull(), r)), F.lit(0)).alias("right_missing_keys"),
        (F.coalesce(F.max(l), F.lit(0)) <= 1).alias("left_unique"),
        (F.coalesce(F.max(r), F.lit(0)) <= 1).alias("right_unique"),
        _total(both).alias("inner_rows"),
        _total(both + left_only).alias("left_join_rows"),
        _total(both + right_only).alias("right_join_rows"),
        _total(both + left_only + right_only).alias("outer_rows"),
        F.coalesce(F.max(l), F.lit(0)).alias("most_left"),
        F.coalesce(F.max(r), F.lit(0)).alias("most_right"),
    )
    lu, ru = F.col("left_unique"), F.col("right_unique")
    return facts.select(
        F.when(lu & ru, "1:1").when(lu, "1:N").when(ru, "N:1").otherwise("N:N").alias("cardinality"),
        "left_rows",
        "right_rows",
        "left_missing_keys",
        "right_missing_keys",
        (lu | ru).alias("safe_to_join"),
        "inner_rows",
        "left_join_rows",
        "right_join_rows",
        "outer_rows",
        "most_left",
        "most_right",
    )


def _hot_keys(counts: DataFrame, side: str, rows: int, most: int) -> DataFrame | None:
    """``hot``: the keys of a side that one task should not hold; None where there are none. Fewer than the shuffle partitions."""
    partitions = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = max(HOT_ROWS, rows // partitions + 1)
    if most < least:
        return None
    keys = counts.where(F.col(f"in_{side}") >= least).select(F.col("key").alias("hot"))
    return counts.sparkSession.createDataFrame(keys.collect(), keys.schema)


def execute_join(
    left: DataFrame,
    right: DataFrame,
    left_on: str,
    right_on: str,
    how: str = "inner",
    max_rows: int | None = None,
    cardinality: str | None = None,
) -> DataFrame:
    """Join two tables on one key; missing keys match each other.

    An equal key name appears once, different key names both stay, other equal
    names get ``_x`` and ``_y``. The key counts of both sides are looked at
    first (one job over both keys): N:N joins are refused, and with ``max_rows``
    larger results before any row is joined. A known ``cardinality`` (1:1, 1:N
    or N:1) saves that job; a key that is not unique as stated then makes the
    join itself fail, with ``many_to_many`` in its message. An outer join that keeps rows of the side with
    unique keys reads both tables twice, so that hot keys can be split. Where the
    counts show hot keys, their rows stay where they are read, and the rows of the
    other side with these keys, one each and so few, are sent to them.
    """
    if how not in JOIN_KINDS:
        raise AnalysisError(
            "bad_join_type", f"'{how}' is no kind of join.", JOIN_KINDS
        )
    if cardinality is not None and max_rows is None:
        _check_keys(left, right, left_on, right_on)
        if cardinality not in ("1:1", "1:N", "N:1"):
            raise AnalysisError("many_to_many", f"A join of cardinality {cardinality} is refused.")
        if cardinality != "N:1":
            left = _with_unique(left, left_on)
        if cardinality != "1:N":
            right = _with_unique(right, right_on)
        return join_tables(left, right, left_on, right_on, how, cardinality)
    counts = key_counts(left, right, left_on, right_on)
    facts = _viability(counts).first()
    if not facts["safe_to_join"]:
        raise AnalysisError("many_to_many", "Both sides repeat keys; such a join is refused.")
    rows = facts["inner_rows" if how == "inner" else "outer_rows" if how == "outer" else f"{how}_join_rows"]
    if max_rows is not None and rows > max_rows:
        raise AnalysisError(
            "too_many_rows",
            f"The join has {rows} rows, more than the {max_rows} asked for.",
        )
    many = "right" if facts["cardinality"] == "1:N" else "left"
    hot = _hot_keys(counts, many, facts[f"{many}_rows"], facts[f"most_{many}"])
    return join_tables(left, right, left_on, right_on, how, facts["cardinality"], hot)


def _with_unique(df: DataFrame, key: str) -> DataFrame:
    """The table, whose rows cannot be read if a key, a missing one included, occurs twice."""
    times = F.count(F.lit(1)).over(Window.partitionBy(present(df, key)))
    said = F.concat(F.lit(f"many_to_many: '{key}' repeats "), F.coalesce(present(df, key).cast("string"), F.lit("the missing key")))
    once = F.when(F.col("__times") > 1, F.raise_error(said).cast("boolean")).otherwise(F.lit(True))
    return df.withColumn("__times", times).where(once).drop("__times")


def join_tables(
    left: DataFrame, right: DataFrame, left_on: str, right_on: str, how: str, cardinality: str, hot: DataFrame | None = None
) -> DataFrame:
    """The join itself, for a known cardinality; ``hot`` keys of the repeating side are joined apart, without a shuffle.

    The side with repeated keys is always the one whose partitions adaptive
    execution may split when a key is hot: the streamed side of an inner, left
    or right join. Unmatched rows of the other side are added by an anti join
    against its distinct keys, which are combined before the shuffle.
    """
    shared = left_on == right_on
    clash = (set(left.columns) & set(right.columns)) - ({left_on} if shared else set())
    l = left.select(
        present(left, left_on).alias("lk"), *[_named(left, c, f"l{i}") for i, c in enumerate(left.columns)]
    )
    r = right.select(
        present(right, right_on).alias("rk"), *[_named(right, c, f"r{i}") for i, c in enumerate(right.columns)]
    )
    many_right = cardinality == "1:N"
    if hot is None:
        joined = _joined(l, r, how, many_right)
    else:
        def split(rows: DataFrame, key: str, kind: str) -> DataFrame:
            return rows.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("hot")), kind)

        joined = _joined(split(l, "lk", "left_anti"), split(r, "rk", "left_anti"), how, many_right)
        warm = (split(l, "lk", "left_semi"), split(r, "rk", "left_semi"))
        many, few = warm[::-1] if many_right else warm
        kept = how == "outer" or how == ("right" if many_right else "left")
        match = F.col("lk").eqNullSafe(F.col("rk"))
        # A hot key occurs on the repeating side, so no row of the other side is left over.
        joined = joined.unionByName(many.join(F.broadcast(few), match, "left" if kept else "inner"), allowMissingColumns=True)

    key_position = right.columns.index(right_on)
    out = []
    for i, c in enumerate(left.columns):
        if shared and c == left_on:
            out.append(F.coalesce(F.col(f"l{i}"), F.col(f"r{key_position}")).alias(c))
        else:
            out.append(F.col(f"l{i}").alias(f"{c}_x" if c in clash else c))
    for i, c in enumerate(right.columns):
        if not (shared and c == right_on):
            out.append(F.col(f"r{i}").alias(f"{c}_y" if c in clash else c))
    return joined.select(*out)


def _joined(l: DataFrame, r: DataFrame, how: str, many_right: bool) -> DataFrame:
    match = F.col("lk").eqNullSafe(F.col("rk"))

    def unmatched(rows: DataFrame, other: DataFrame, key: str) -> DataFrame:
        return rows.join(other.select(key).distinct(), match, "left_anti")

    if how == "inner":
        return l.join(r, match)
    if how == "left":
        if many_right:
            return l.join(r, match).unionByName(unmatched(l, r, "rk"), allowMissingColumns=True)
        return l.join(r, match, "left")
    if how == "right":
        if many_right:
            return l.join(r, match, "right")
        return l.join(r, match).unionByName(unmatched(r, l, "lk"), allowMissingColumns=True)
    if many_right:
        return l.join(r, match, "right").unionByName(unmatched(l, r, "rk"), allowMissingColumns=True)
    return l.join(r, match, "left").unionByName(unmatched(r, l, "lk"), allowMissingColumns=True)


def _named(df: DataFrame, name: str, alias: str) -> Column:
    return df[f"`{name.replace('`', '``')}`"].alias(alias)
