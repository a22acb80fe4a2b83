"""Exact quantiles without collecting a group's values in one place.

Spark's own ``percentile`` keeps every distinct value of a group in one
aggregation buffer, which a hot group of a large table does not fit. Here the
values are counted in order-preserving buckets first (partial aggregation, a
bounded number of buckets per group), the running counts tell which bucket
holds each wanted rank, and only the values of those few buckets are sorted. A
bucket with many values is cut evenly into smaller ones first, as often as it
takes; where no bucket is that large, adaptive execution drops these steps.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Buckets per power of two. More buckets leave fewer values to sort in the end
# and more counts to add up first: of evenly spread values, the bucket of a
# wanted rank holds about one in 16,000.
BUCKETS_PER_OCTAVE = 8192

# Rows of a bucket that are sorted as they are, and the parts a larger one is cut into.
# Of 2^52 doubles of an octave, a bucket has 2^39 and a part 2^19, and equal values
# are one row: that many rows are sorted at most.
MOST_SORTED = 65_536
_PARTS = 1 << 20
_CUTS = 1

# Added to the exponent to keep it positive for the smallest double.
_OFFSET = 1100
_LARGEST = 1.7976931348623157e308

# A frame with one row per group is broadcast only up to this many groups.
MAX_BROADCAST_GROUPS = 50_000


# A bucket number that never decreases when the value increases: a scaled logarithm.
_SCALED = f"floor(({_OFFSET} + log2(least(abs(_v), {_LARGEST}D))) * {BUCKETS_PER_OCTAVE})"
_BUCKET = f"CASE WHEN _v = 0 THEN 0L WHEN _v < 0 THEN -{_SCALED} WHEN _v > 0 THEN {_SCALED} END"


def bucket_of(value: str, per_octave: int) -> Column:
    """A number that never decreases when the value, a double, increases; a bounded number of them."""
    scaled = f"floor(({_OFFSET} + log2(least(abs({value}), {_LARGEST}D))) * {per_octave})"
    return F.expr(f"CASE WHEN {value} = 0 THEN 0L WHEN {value} < 0 THEN -{scaled} WHEN {value} > 0 THEN {scaled} END")


def has_few_groups(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether a frame with one row per group is small enough to broadcast.

    Counts distinct keys up to the limit: one job that reads the key columns.
    """
    groups = df.select(*keys).distinct().limit(MAX_BROADCAST_GROUPS + 1)
    return groups.count() <= MAX_BROADCAST_GROUPS


def quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    few_groups: bool,
) -> DataFrame:
    """Linearly interpolated quantiles per group: ``keys, n, q`` (array of double).

    ``value`` must be a double column without NaN; NULLs are ignored, a group
    with nothing but NULLs has ``n = 0`` and NULL quantiles. ``few_groups``
    allows broadcasting the per-group bracket (see ``has_few_groups``).
    """
    rows = df.select(*keys, F.col(value).alias("_v")).withColumn("_b", F.expr(_BUCKET))
    group = Window.partitionBy(*keys)
    running = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = rows.groupBy(*keys, "_b").agg(
        F.expr("count(_v) AS _c"), F.expr("min(_v) AS _lo"), F.expr("max(_v) AS _hi")
    )
    # _start and _end are the ranks before and after a bucket; _n the values of the group.
    placed = counted.select(
        "*", F.sum("_c").over(running).alias("_end"), F.sum("_c").over(group).alias("_n")
    ).withColumn("_start", F.expr("_end - _c"))

    places = [f"((_n - 1) * {float(p)}D)" for p in probabilities]
    ranks = [f"{side}({place})" for place in places for side in ("floor", "ceil")]
    hits = [f"({r} >= _start AND {r} < _end)" for r in ranks]
    here = ", ".join(f"CASE WHEN {hit} THEN {r} END" for hit, r in zip(hits, ranks))
    # The bucket of the NULLs keeps groups without any value in the result.
    located = placed.where(" OR ".join(["_b IS NULL", *hits])).selectExpr(
        *[_quoted(k) for k in keys],
        "_b", "_n", "_start", "_end", "_lo", "_hi",
        f"CASE WHEN _b IS NULL THEN array(-1L) ELSE array_distinct(array_compact(array({here}))) END AS _r",
    )
    # The smallest and largest value of a bucket are known already.
    known = located.selectExpr(
        *[_quoted(k) for k in keys],
        "_n", "_start", "_lo", "_hi",
        "explode(filter(_r, r -> _b IS NULL OR _lo = _hi OR r = _start OR r = _end - 1)) AS _rank",
    ).selectExpr(
        *[_quoted(k) for k in keys], "_n", "_rank", "CASE WHEN _rank = _start OR _lo = _hi THEN _lo ELSE _hi END AS _v"
    )
    names = [_quoted(k) for k in keys]
    aliases = [f"{k} AS _k{i}" for i, k in enumerate(names)]
    own = [f"_k{i} AS {k}" for i, k in enumerate(names)]
    bounds = ["_bb", "_n", "_start", "_lo", "_hi", "_r"]
    brackets = (
        located.where("_b IS NOT NULL AND _lo < _hi")
        .withColumn("_r", F.expr("filter(_r, r -> r > _start AND r < _end - 1)"))
        .where("size(_r) > 0")
        .selectExpr(*aliases, "_b AS _bb", "_n", "_start", "_end - _start AS _c", "_lo", "_hi", "_r")
    )
    same = " AND ".join([f"{k} <=> _k{i}" for i, k in enumerate(names)] + ["_b = _bb", "_v >= _lo", "_v <= _hi"])
    filled = rows.where("_v IS NOT NULL")

    def bracketed(inside: DataFrame, extra: Sequence[str]) -> DataFrame:
        """Values inside the brackets, counted by what describes their bracket and by ``extra`` of them."""
        if few_groups:
            # All columns of a bracket depend on it; as grouping keys they leave a
            # plain counter to aggregate.
            met = filled.join(F.broadcast(inside), F.expr(same)).selectExpr(*own, *bounds, "_v", "1L AS _m", *extra)
        else:
            # Repeated values are combined before the join, so that a hot value or
            # group reaches it as one row per distinct value.
            values = filled.groupBy(*keys, "_b", "_v").agg(F.expr("count(*) AS _m"))
            met = values.join(inside, F.expr(same)).selectExpr(*own, *bounds, "_v", "_m", *extra)
        return met

    parts = []
    for _ in range(_CUTS):
        parts.append(brackets.where(f"_c <= {MOST_SORTED}"))
        cut = f"least(floor((_v - _lo) / (_hi - _lo) * {_PARTS}), {_PARTS - 1}) AS _s"
        grouped = bracketed(brackets.where(f"_c > {MOST_SORTED}"), [cut]).groupBy(*keys, *bounds, "_s").agg(
            F.expr("sum(_m) AS _c"), F.expr("min(_v) AS _least"), F.expr("max(_v) AS _most")
        )
        before = Window.partitionBy(*keys, "_bb", "_lo").orderBy("_s").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        placed = (
            grouped.withColumn("_to", F.col("_start") + F.sum("_c").over(before))
            .withColumn("_from", F.expr("_to - _c"))
            .withColumn("_r", F.expr("filter(_r, r -> r >= _from AND r < _to)"))
            .where("size(_r) > 0")
        )
        known = known.unionByName(
            placed.selectExpr(*names, "_n", "_from", "_least", "_most", "explode(filter(_r, r -> _least = _most OR r = _from OR r = _to - 1)) AS _rank")
            .selectExpr(*names, "_n", "_rank", "CASE WHEN _rank = _from OR _least = _most THEN _least ELSE _most END AS _v")
        )
        brackets = (
            placed.where("_least < _most")
            .withColumn("_r", F.expr("filter(_r, r -> r > _from AND r < _to - 1)"))
            .where("size(_r) > 0")
            .selectExpr(*aliases, "_bb", "_n", "_from AS _start", "_c", "_least AS _lo", "_most AS _hi", "_r")
        )
    parts.append(brackets)
    values = bracketed(reduce(DataFrame.unionByName, parts), []).groupBy(*keys, *bounds, "_v").agg(F.expr("sum(_m) AS _c"))
    in_bracket = (
        Window.partitionBy(*keys, "_bb", "_lo").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    refined = values.withColumn("_end", F.col("_start") + F.sum("_c").over(in_bracket)).selectExpr(
        *names, "_n", "explode(filter(_r, r -> r >= _end - _c AND r < _end)) AS _rank", "_v"
    )
    found = (
        known.unionByName(refined)
        .groupBy(*keys)
        .agg(F.expr("max(_n) AS _n"), F.expr("map_from_entries(collect_list(struct(_rank, _v))) AS _at"))
    )
    wanted = ", ".join(_interpolated(p, place) for p, place in zip(probabilities, places))
    return found.selectExpr(*[_quoted(k) for k in keys], "_n AS n", f"array({wanted}) AS q")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _interpolated(p: float, place: str) -> str:
    low, high = f"try_element_at(_at, floor({place}))", f"try_element_at(_at, ceil({place}))"
    # The middle of an even count is a plain mean; otherwise low equals high.
    between = f"({low} + {high}) / 2" if p == 0.5 else f"{low} + ({high} - {low}) * ({place} - floor({place}))"
    return f"CASE WHEN _n > 0 THEN {between} END"
