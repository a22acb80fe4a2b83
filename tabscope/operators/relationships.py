"""Discovery of join keys across tables, from names and shared values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.errors import AnalysisError
from tabscope.functions.arithmetic import rounded
from tabscope.functions.columns import col, require_column, require_frame
from tabscope.functions.names import name_similarity, similar_names
from tabscope.operators.values import (
    NumberedColumn,
    catalog_of,
    padded_counts,
    plain_counts,
    shared_counts,
    signatures,
    sketches,
    with_partners,
)

# Default thresholds.
MIN_CONFIDENCE = 0.4
MIN_MAP_CONFIDENCE = 0.5
NAME_WEIGHT, VALUE_WEIGHT = 0.4, 0.6
MIN_NAME_SIMILARITY = 0.3

# Up to so many columns, all names are compared; names of more meet in an index.
_FEW_COLUMNS = 300

EDGE_COLUMNS = (
    "left_dataset", "left_column", "right_dataset", "right_column", "confidence",
    "name_similarity", "value_overlap", "cardinality", "safe_to_join",
)


def _some(datasets: Mapping[str, DataFrame], catalog: Sequence[NumberedColumn]) -> dict[str, DataFrame]:
    return {name: df for name, df in datasets.items() if any(c.dataset == name for c in catalog)}


def _scored(datasets: Mapping[str, DataFrame], target: str | None = None) -> DataFrame:
    """Score all pairs of columns of one family in different tables that have similar names or a value in common.

    A first job reads every table and leaves counts, bounds and hashed values of each column. Only columns that may share a
    value, or whose uniqueness a pair of similar names depends on, have their values compared; everything joined here has
    a row per column or pair.
    """
    spark = next(iter(datasets.values())).sparkSession
    catalog = catalog_of(datasets)
    columns = spark.createDataFrame([tuple(c) for c in catalog], "number int, dataset string, name string, family string")

    def wanted(left: str, right: str) -> Column:
        return F.lit(True) if target is None else (F.col(left) == target) | (F.col(right) == target)

    def side(which: str) -> DataFrame:
        return columns.select(F.col("number").alias(f"{which}_number"), F.col("dataset").alias(f"{which}_dataset"), F.col("name").alias(f"{which}_column"))

    def named(pairs: DataFrame) -> DataFrame:
        both = pairs.join(side("left"), "left_number").join(side("right"), "right_number")
        similarity = name_similarity(F.col("left_column"), F.col("right_column"))
        return both.where((F.col("left_dataset") != F.col("right_dataset")) & wanted("left_dataset", "right_dataset")).withColumn("name_similarity", similarity)

    found = sketches(datasets, catalog)
    if len(catalog) > _FEW_COLUMNS:
        met = similar_names(columns, MIN_NAME_SIMILARITY)
    else:
        one, two = (columns.select("family", F.col("number").alias(f"{x}_number")) for x in ("left", "right"))
        met = one.join(two, "family").where("left_number < right_number").select("left_number", "right_number")
    alike = named(met).where(F.col("name_similarity") >= MIN_NAME_SIMILARITY)
    numbers = {r.n for r in alike.select(F.explode(F.array("left_number", "right_number")).alias("n")).distinct().collect()}
    undecided = {n for n in numbers if found[n].varied and not found[n].surely_repeats}
    read = [c for c in catalog if c.number in undecided | {n for n in with_partners(catalog, found, target) if found[n].varied}]
    facts = spark.createDataFrame(
        [(c.number, s.filled, s.surely_repeats) for c in catalog if (s := found[c.number]).varied], "number int, filled bigint, repeats boolean"
    )
    zero = F.lit(0).cast("bigint")
    if read:
        # Numbers without gaps keep the bit masks short.
        place = {c.number: k for k, c in enumerate(read)}
        numbering = spark.createDataFrame([(k, n) for n, k in place.items()], "place int, number int")
        dense = [c._replace(number=place[c.number]) for c in read]
        sets = signatures(_some(datasets, read), dense)
        counts = shared_counts(sets)
        exact = plain_counts(sets)
        padded = padded_counts(datasets, dense, {place[c.number] for c in read if found[c.number].padded})
        if padded is not None:
            exact = exact.unionByName(padded).groupBy("number").agg(F.sum("n").alias("n"))
        exact = exact.select(F.col("number").alias("place"), F.col("n").alias("exact"))
        own = counts.where("a = b").select(F.col("a").alias("place"), F.col("n").alias("values"))
        facts = facts.join(F.broadcast(numbering.join(F.broadcast(own), "place", "left").join(F.broadcast(exact), "place", "left").drop("place")), "number", "left")
        left, right = (numbering.select(F.col("place").alias(x), F.col("number").alias(f"{side}_number")) for x, side in (("a", "left"), ("b", "right")))
        shared = counts.where("a != b").withColumnRenamed("n", "both").join(left, "a").join(right, "b").select("left_number", "right_number", "both")
        families = [columns.select(F.col("number").alias(f"{x}_number"), F.col("family").alias(f"{x}_family")) for x in ("left", "right")]
        valued = named(shared.join(families[0], "left_number").join(families[1], "right_number").where("left_family = right_family").select("left_number", "right_number", "both"))
    else:
        facts = facts.withColumns({"values": zero, "exact": zero})
        valued = alike.limit(0).withColumn("both", zero)
    pair = ["left_number", "right_number", "left_dataset", "left_column", "right_dataset", "right_column", "name_similarity"]
    pairs = valued.select(*pair, "both").unionByName(alike.select(*pair, zero.alias("both"))).groupBy(*pair).agg(F.max("both").alias("both"))

    def facts_of(which: str) -> DataFrame:
        # A row per column: broadcast, as the columns themselves are.
        unique = ~F.col("repeats") & (F.col("filled") == F.coalesce("exact", zero))
        return facts.select(F.col("number").alias(f"{which}_number"), F.coalesce("values", zero).alias(f"{which}_values"), unique.alias(f"{which}_unique"))

    either = F.col("left_values") + F.col("right_values") - F.col("both")
    lu, ru = F.col("left_unique"), F.col("right_unique")
    return (
        pairs.join(F.broadcast(facts_of("left")), "left_number").join(F.broadcast(facts_of("right")), "right_number")
        .withColumn("value_overlap", F.coalesce(F.when(F.col("both") > 0, rounded(F.try_divide(F.col("both"), either), 3)), F.lit(0.0)))
        .withColumn("confidence", rounded(NAME_WEIGHT * F.col("name_similarity") + VALUE_WEIGHT * F.col("value_overlap"), 2))
        .withColumn("cardinality", F.when(lu & ru, "1:1").when(lu, "1:N").when(ru, "N:1").otherwise("N:N"))
        .withColumn("safe_to_join", lu | ru)
        .where(_is_candidate())
        .select("left_number", "right_number", *EDGE_COLUMNS)
    )


def _is_candidate() -> Column:
    """A pair with unlike names and no shared value is not a candidate."""
    return (F.col("name_similarity") >= MIN_NAME_SIMILARITY) | (F.col("value_overlap") > 0)


def _require_datasets(datasets: Mapping[str, DataFrame]) -> None:
    for df in datasets.values():
        require_frame(df)


def score_key_pair(
    left: DataFrame, right: DataFrame, left_column: str, right_column: str
) -> DataFrame:
    """Score of one column pair in one row, or no row when it is not a candidate.

    Columns: left_column, right_column, name_similarity, value_overlap,
    confidence, cardinality, safe_to_join. Equal numbers are equal values
    whatever their types are.
    """
    require_frame(left)
    require_frame(right)
    require_column(left, left_column, "left dataset")
    require_column(right, right_column, "right dataset")
    return _scored({"left": left.select(col(left_column)), "right": right.select(col(right_column))}).select(
        "left_column", "right_column", "name_similarity", "value_overlap", "confidence", "cardinality", "safe_to_join"
    )


def value_overlap(
    left: DataFrame, right: DataFrame, left_column: str, right_column: str
) -> DataFrame:
    """Jaccard index of the distinct values of two columns.

    One row: ``left_values, right_values, shared_values, value_overlap``. All
    values are compared: those of one family (numbers, dates and times, text) by
    value, whatever their types are, text without surrounding spaces; those of
    unlike families as text.
    """
    require_frame(left)
    require_frame(right)
    require_column(left, left_column, "left dataset")
    require_column(right, right_column, "right dataset")
    datasets = {"left": left.select(col(left_column)), "right": right.select(col(right_column))}
    catalog = catalog_of(datasets)
    if len({c.family for c in catalog}) > 1:
        catalog = [c._replace(family="text") for c in catalog]
    sets = signatures(datasets, catalog)

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0).cast("bigint"))

    in_left, in_right = F.array_contains("members", 0), F.array_contains("members", 1)
    counts = sets.agg(
        total(in_left).alias("left_values"),
        total(in_right).alias("right_values"),
        total(in_left & in_right).alias("shared_values"),
    )
    either = F.col("left_values") + F.col("right_values") - F.col("shared_values")
    overlap = F.coalesce(rounded(F.try_divide(F.col("shared_values"), either), 3), F.lit(0.0))
    return counts.withColumn("value_overlap", overlap)


def discover_relationships(
    datasets: Mapping[str, DataFrame],
    target_dataset: str | None = None,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Candidate join keys between all tables, most confident first.

    Confidence is 0.4 · name similarity + 0.6 · value overlap. Columns with at
    most one distinct value and pairs of unlike types are left out; equal numbers
    are equal values whatever their types are. ``target_dataset`` keeps the pairs
    of one table. A first job, when this is called, sketches the columns; the
    result reads those that may share a value, once for any number of pairs.
    """
    _require_datasets(datasets)
    if target_dataset is not None and target_dataset not in datasets:
        raise AnalysisError("unknown_dataset", f"'{target_dataset}' is no table.", datasets)
    if len(datasets) < 2:
        raise AnalysisError("too_few_datasets", "Relationships need two tables.")
    return (
        _scored(datasets, target_dataset)
        .where(F.col("confidence") >= min_confidence)
        .orderBy(F.col("confidence").desc(), "left_number", "right_number")
        .select(*EDGE_COLUMNS)
    )


def schema_graph(
    datasets: Mapping[str, DataFrame], max_edges: int | None = None
) -> DataFrame:
    """The strongest relationships as a table of edges with a match percentage."""
    edges = discover_relationships(datasets, min_confidence=MIN_MAP_CONFIDENCE)
    if max_edges is not None:
        edges = edges.limit(max_edges)
    return edges.select(
        "left_dataset",
        "left_column",
        "right_dataset",
        "right_column",
        "cardinality",
        F.floor(F.col("confidence") * 100).cast("int").alias("match_percentage"),
    )
