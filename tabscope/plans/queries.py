"""Every operator as a query over whole tables of a scale-factor folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tabscope as ts
from tabscope.functions.arithmetic import rounded
from tabscope.functions.columns import col
from tabscope.sources.csv import apply_types, infer_types, preview, shape

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

RELATED = ("region", "nation", "customer", "supplier", "orders", "part", "lineitem")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(*tables: str):
    """Register a function of the named tables under its own name."""

    def register(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(*[table(spark, sf_dir, t) for t in tables])

        QUERIES[build.__name__] = run
        return build

    return register


# --- inputs derived from the tables ------------------------------------------


def orders_with_gaps(orders: DataFrame) -> DataFrame:
    """Orders with NULL and NaN prices, a boolean, a NULL group and a constant."""
    price = (
        F.when(F.col("o_orderstatus") == "P", F.lit(None))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit(float("nan")))
        .otherwise(F.col("o_totalprice"))
    )
    return orders.select(
        "o_orderkey",
        "o_custkey",
        "o_orderdate",
        price.alias("price"),
        (F.col("o_totalprice") > 250000).alias("is_large"),
        F.when(F.col("o_orderpriority") != "3-MEDIUM", F.col("o_orderpriority")).alias("priority"),
        F.lit(7).alias("constant"),
    )


def orders_as_text(orders: DataFrame) -> DataFrame:
    """Orders as they would come from a CSV file, dates in several formats."""
    date = F.col("o_orderdate")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("key"),
        F.when(F.col("o_orderstatus") == "P", "NA").otherwise(F.col("o_custkey").cast("string")).alias("customer"),
        F.format_string("%.2f", "o_totalprice").alias("price"),
        F.when(F.col("o_totalprice") > 250000, "True").otherwise("False").alias("large"),
        F.date_format(date, "yyyy-MM-dd").alias("iso_date"),
        F.date_format(date, "M/d/yyyy").alias("us_date"),
        F.date_format(date, "dd-MM-yyyy").alias("day_first"),
        F.when(F.col("o_orderstatus") == "P", "pending").otherwise(F.date_format(date, "yyyy/MM/dd")).alias("partly"),
        F.date_format(F.trunc(date, "month"), "yyyy-MM-dd").alias("ordered"),
        F.col("o_orderpriority").alias("priority"),
        F.lit("").alias("nothing"),
    )


# --- group-by ------------------------------------------------------------------


def _groupby(agg: str) -> None:
    def build(orders: DataFrame) -> DataFrame:
        return ts.groupby_analysis(orders, "o_orderpriority", "o_totalprice", agg)

    build.__name__ = f"groupby_{agg}"
    query("orders")(build)


for _agg in ("mean", "sum", "count", "min", "max", "median", "std"):
    _groupby(_agg)


@query("orders")
def groupby_datetime(orders):
    return ts.groupby_analysis(orders, "o_orderdate", "o_totalprice", "sum", max_groups=None)


@query("orders")
def groupby_with_gaps(orders):
    return ts.groupby_analysis(orders_with_gaps(orders), "priority", "price", "mean")


@query("orders")
def groupby_median_many_groups(orders):
    return ts.groupby_analysis(in_cents(orders), "o_custkey", "cents", "median")


@query("lineitem")
def groupby_filtered(lineitem):
    return ts.groupby_analysis(lineitem, "l_linenumber", "l_extendedprice", "sum", filter_values=[1, "3", 7])


@query("orders")
def groupby_filtered_text(orders):
    return ts.groupby_analysis(
        orders, "o_orderpriority", "o_totalprice", "mean", filter_values=["1-URGENT", "2-HIGH"]
    )


@query("orders")
def groupby_filtered_boolean(orders):
    return ts.groupby_analysis(orders_with_gaps(orders), "is_large", "o_custkey", "count", filter_values=["True"])


@query("customer")
def groupby_top_n(customer):
    return ts.groupby_analysis(customer, "c_nationkey", "c_acctbal", "sum", top_n=10)


@query("customer")
def groupby_bottom_n(customer):
    return ts.groupby_analysis(customer, "c_nationkey", "c_acctbal", "sum", top_n=10, sort_order="asc")


@query("orders")
def groupby_all(orders):
    return ts.groupby_analysis(orders, "o_custkey", "o_totalprice", "sum")


@query("orders")
def groupby_best_worst_many(orders):
    return ts.best_and_worst_group(orders, "o_custkey", "o_totalprice", "sum")


@query("orders")
def groupby_ranking_many(orders):
    return ts.group_ranking(orders, "o_custkey", "o_totalprice", "max")


@query("orders")
def groupby_capped_50(orders):
    return ts.groupby_analysis(orders, "o_custkey", "o_totalprice", "sum", max_groups=50)


@query("lineitem")
def groupby_best_worst(lineitem):
    return ts.best_and_worst_group(lineitem, "l_returnflag", "l_extendedprice", "sum")


@query("part")
def groupby_ranking(part):
    return ts.group_ranking(part, "p_brand", "p_retailprice", "mean")


@query("lineitem")
def groupby_two_way_comparison(lineitem):
    return ts.compare_two_groups(lineitem, "l_linestatus", "l_quantity", "sum")


# --- time series -----------------------------------------------------------------


def in_cents(orders: DataFrame) -> DataFrame:
    """Orders with whole cents, of which means and medians are exact where they lie on a half."""
    return orders.withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("bigint"))


def _series(period: str, agg: str) -> None:
    def build(orders: DataFrame) -> DataFrame:
        return ts.time_analysis(in_cents(orders), "o_orderdate", "cents", period, agg)

    build.__name__ = f"series_{period}"
    query("orders")(build)


for _period, _agg in (("day", "sum"), ("week", "mean"), ("month", "sum"), ("quarter", "median"), ("year", "std")):
    _series(_period, _agg)


@query("orders")
def series_year_filter(orders):
    return ts.time_analysis(orders, "o_orderdate", "o_totalprice", "month", "max", year=1997)


@query("events")
def series_date_range(events):
    return ts.time_analysis(
        events, "ts", "value", "day", "sum", start_date="2024-01-05", end_date="2024-01-20"
    )


@query("events")
def series_by_group(events):
    return ts.time_analysis(
        events, "ts", "value", "week", "mean", group_column="event_type", filter_values=["click", "error", "signup"]
    )


@query("events")
def series_by_group_wide(events):
    grouped = ts.time_analysis(events, "ts", "value", "week", "count", group_column="event_type")
    return ts.pivot_series(grouped, ["click", "error", "purchase", "signup", "view"])


@query("orders")
def period_buckets(orders):
    bucketed = ts.add_period_column(orders, "o_orderdate", "quarter")
    return bucketed.select(
        "o_orderkey", "period_start", ts.period_label(F.col("period_start"), "quarter").alias("period")
    )


@query("orders")
def series_best_worst(orders):
    summary = ts.series_summary(orders, "o_orderdate", "o_totalprice", "month", "sum")
    return summary.select("best_period", "best_value", "worst_period", "worst_value", "total_periods")


@query("events")
def series_trend(events):
    return ts.series_summary(events, "ts", "value", "week", "sum").select("trend_direction", "total_periods")


@query("orders")
def series_overall_change(orders):
    summary = ts.series_summary(orders, "o_orderdate", "o_totalprice", "year", "mean")
    return summary.select("overall_change", "overall_percentage_change")


# --- period comparison --------------------------------------------------------------


@query("orders")
def change_period_over_period(orders):
    return ts.percentage_change(orders, "o_orderdate", "o_totalprice", "month", "sum", max_changes=None)


@query("orders")
def change_latest_24(orders):
    return ts.percentage_change(orders, "o_orderdate", "o_totalprice", max_changes=24)


@query("orders")
def change_filtered(orders):
    return ts.percentage_change(
        orders,
        "o_orderdate",
        "o_totalprice",
        "quarter",
        "mean",
        group_column="o_orderpriority",
        filter_values=["1-URGENT"],
        max_changes=None,
    )


@query("orders")
def change_largest(orders):
    return ts.change_highlights(orders, "o_orderdate", "o_totalprice")


@query("orders")
def change_overall(orders):
    return ts.overall_change(orders, "o_orderdate", "o_totalprice")


@query("orders")
def change_year_vs_year(orders):
    return ts.compare_years(orders, "o_orderdate", "o_totalprice", 1996, 1997)


@query("orders")
def change_year_vs_year_median(orders):
    return ts.compare_years(orders, "o_orderdate", "o_totalprice", 1998, 1999, "median")


# --- columns ---------------------------------------------------------------------------


@query("orders")
def table_shape(orders):
    return shape(orders)


@query("orders")
def table_preview(orders):
    return preview(orders)


@query("orders")
def outliers_constant(orders):
    return ts.outlier_analysis(orders_with_gaps(orders), "constant")


@query("orders")
def profile_texts(orders):
    return ts.dataset_info(orders_as_text(orders))


@query("lineitem")
def profile_lineitem(lineitem):
    return ts.dataset_info(lineitem)


@query("orders")
def profile_nothing(orders):
    return ts.dataset_info(orders.where(F.col("o_orderkey").isNull()))


@query("orders")
def chart_points_by_date(orders):
    return ts.create_visualization(orders, "scatter", "o_orderdate", "o_totalprice")


@query("orders")
def table_numeric_columns(orders):
    return ts.select_numeric(orders_with_gaps(orders)).select(
        "o_orderkey", "o_custkey", F.nanvl("price", F.lit(None).cast("double")).alias("price"), "constant"
    )


@query("orders")
def missing_values(orders):
    return ts.missing_values(orders_with_gaps(orders))


@query("orders")
def missing_totals(orders):
    return ts.missing_totals(orders_with_gaps(orders))


@query("lineitem")
def statistics_all(lineitem):
    return ts.statistics(lineitem)


@query("orders")
def statistics_column(orders):
    return ts.statistics(orders_with_gaps(orders), "price")


@query("orders")
def statistics_boolean(orders):
    return ts.statistics(orders_with_gaps(orders), "is_large")


@query("lineitem")
def outliers_all(lineitem):
    return ts.outlier_analysis(lineitem, multiplier=0.25)


@query("events")
def outliers_column(events):
    return ts.outlier_analysis(events, "value")


@query("part")
def outlier_examples(part):
    return ts.outlier_examples(part, multiplier=0.25)


@query("lineitem")
def correlation_target(lineitem):
    return ts.correlation_analysis(lineitem, "l_quantity", top_n=5)


@query("lineitem")
def correlation_pairs(lineitem):
    return ts.correlation_analysis(lineitem, top_n=20)


@query("lineitem")
def correlation_all_pairs(lineitem):
    return ts.correlation_analysis(lineitem)


@query("orders")
def correlation_with_infinity(orders):
    price = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(float("inf"))).otherwise(F.col("o_totalprice"))
    return ts.correlation_analysis(orders.select("o_orderkey", "o_custkey", price.alias("price")))


@query("lineitem")
def correlation_subset(lineitem):
    columns = ["l_discount", "l_tax", "l_extendedprice"]
    return ts.correlation_analysis(lineitem, "l_quantity", columns)


@query("orders")
def correlation_with_gaps(orders):
    return ts.correlation_analysis(orders_with_gaps(orders))


@query("lineitem")
def correlation_extremes(lineitem):
    return ts.correlation_extremes(lineitem)


@query("orders")
def correlation_constant_columns(orders):
    return ts.constant_columns(orders_with_gaps(orders))


@query("customer")
def profile(customer):
    return ts.dataset_info(customer)


@query("events")
def profile_events(events):
    return ts.dataset_info(events)


@query("documents")
def profile_documents(documents):
    return ts.dataset_info(documents)


@query("customer")
def profile_identifiers(customer):
    return ts.potential_identifiers(customer)


@query("events")
def profile_group_candidates(events):
    return ts.candidate_group_columns(events)


@query("documents")
def profile_samples(documents):
    return ts.sample_values(documents)


# --- ingestion ------------------------------------------------------------------------------


@query("orders")
def type_inference(orders):
    return infer_types(orders_as_text(orders))


@query("orders")
def typed_columns(orders):
    texts = orders_as_text(orders)
    types = {r["column"]: r["type"] for r in infer_types(texts).collect()}
    return ts.convert_date_columns(apply_types(texts, types))


@query("orders")
def date_detection(orders):
    return ts.detect_date_columns(orders_as_text(orders))


@query("orders")
def date_conversion(orders):
    return ts.convert_date_columns(orders_as_text(orders))


def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ts.file_manifest(spark, sf_dir, "*.parquet")


QUERIES["file_manifest"] = file_manifest


# --- joins ------------------------------------------------------------------------------------


@query("customer", "orders")
def join_inner(customer, orders):
    return ts.execute_join(orders, customer, "o_custkey", "c_custkey", cardinality="N:1")


@query("documents", "labels")
def join_left(documents, labels):
    return ts.execute_join(documents, labels, "doc_id", "doc_id", "left")


@query("customer", "orders")
def join_left_one_to_many(customer, orders):
    return ts.execute_join(customer, orders, "c_custkey", "o_custkey", "left")


@query("labels", "documents")
def join_right(labels, documents):
    return ts.execute_join(labels, documents, "doc_id", "doc_id", "right")


@query("nation", "supplier")
def join_right_one_to_many(nation, supplier):
    left = nation.select(F.col("n_nationkey").alias("nationkey"), F.col("n_name").alias("name"))
    right = supplier.select(F.col("s_nationkey").alias("nationkey"), F.col("s_name").alias("name"), "s_suppkey")
    return ts.execute_join(left, right, "nationkey", "nationkey", "right")


@query("labels", "documents")
def join_outer(labels, documents):
    return ts.execute_join(labels, documents, "doc_id", "doc_id", "outer")


@query("customer", "orders")
def join_outer_null_keys(customer, orders):
    keyed = orders.select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_custkey"), "o_orderkey", "o_totalprice"
    )
    return ts.execute_join(keyed, customer, "o_custkey", "c_custkey", "outer")


@query("customer", "orders")
def join_viability(customer, orders):
    return ts.inspect_join_viability(customer, orders, "c_custkey", "o_custkey").select(
        "cardinality", "left_rows", "right_rows", "left_missing_keys", "right_missing_keys", "safe_to_join"
    )


@query("customer", "supplier")
def join_projected_rows(customer, supplier):
    facts = ts.inspect_join_viability(customer, supplier, "c_nationkey", "s_nationkey")
    return facts.select(
        "cardinality", "safe_to_join", "inner_rows", "left_join_rows", "right_join_rows", "outer_rows"
    )


@query("customer", "orders")
def join_key_counts(customer, orders):
    return ts.key_counts(customer, orders, "c_custkey", "o_custkey")


@query("nation", "customer")
def join_then_groupby(nation, customer):
    joined = ts.execute_join(customer, nation, "c_nationkey", "n_nationkey")
    return ts.groupby_analysis(joined, "n_name", "c_acctbal", "sum")


@query("customer", "supplier", "orders")
def join_refusals(customer, supplier, orders):
    """Why joins on some keys are refused, from the kinds and the counts of the keys of whole tables; null where none is."""
    asked = [(customer, supplier, "c_nationkey", "s_nationkey"), (customer, orders, "c_custkey", "o_custkey"), (orders, customer, "o_orderpriority", "c_custkey")]
    rows = []
    for left, right, left_on, right_on in asked:
        try:
            ts.execute_join(left, right, left_on, right_on)
            rows.append((left_on, right_on, None))
        except ts.AnalysisError as error:
            rows.append((left_on, right_on, error.code))
    return customer.sparkSession.createDataFrame(rows, "left_on string, right_on string, refused string")


# --- relationships --------------------------------------------------------------------------------


@query("customer", "events")
def value_overlap(customer, events):
    return ts.value_overlap(customer, events, "c_custkey", "user_id")


@query("part")
def name_similarity(part):
    pairs = {"name_type": ("p_name", "p_type"), "type_brand": ("p_type", "p_brand"), "name_brand": ("p_name", "p_brand")}
    return part.select(
        "p_partkey", *[ts.name_similarity(col(a), col(b)).alias(k) for k, (a, b) in pairs.items()]
    )


@query("customer", "orders")
def score_key_pair(customer, orders):
    return ts.score_key_pair(customer, orders, "c_custkey", "o_custkey")


@query(*RELATED)
def relationships(*tables):
    return ts.discover_relationships(dict(zip(RELATED, tables)), min_confidence=0.1)


@query(*RELATED)
def relationships_of_one(*tables):
    return ts.discover_relationships(dict(zip(RELATED, tables)), target_dataset="nation")


@query(*RELATED)
def schema_graph(*tables):
    return ts.schema_graph(dict(zip(RELATED, tables)))


# --- chart data and findings ---------------------------------------------------------------------------


@query("part")
def chart_category(part):
    return ts.create_visualization(part, "bar", "p_brand", "p_retailprice", "mean", top_n=5)


@query("orders")
def chart_time(orders):
    chart = ts.create_visualization(in_cents(orders), "line", "o_orderdate", "cents", "mean", period="quarter")
    return chart.select("x", rounded("y", 4).alias("y"))


@query("orders")
def chart_visible_line(orders):
    return ts.visible_line(orders, "o_orderdate", "o_totalprice", 300)


@query("lineitem")
def chart_visible_line_of_numbers(lineitem):
    return ts.create_visualization(lineitem, "line", "l_extendedprice", "l_orderkey", pixels=100)


@query("orders")
def chart_points(orders):
    return ts.create_visualization(orders_with_gaps(orders), "scatter", "o_custkey", "price")


@query("orders")
def chart_histogram(orders):
    chart = ts.create_visualization(orders, "histogram", "o_totalprice")
    return chart.select("bin", rounded("lower", 4).alias("lower"), rounded("upper", 4).alias("upper"), "count")


@query("orders")
def chart_histogram_categories(orders):
    return ts.create_visualization(orders, "histogram", "o_orderpriority")


@query("lineitem")
def chart_box(lineitem):
    box = ts.create_visualization(lineitem, "box", "l_returnflag", "l_extendedprice")
    exact = ("x", "count", "outlier_count")
    return box.select(*[c if c in exact else rounded(c, 4).alias(c) for c in box.columns])


@query("customer", "supplier")
def chart_multi_series(customer, supplier):
    return ts.create_multi_dataset_visualization(
        {"customer": customer, "supplier": supplier},
        [
            {"dataset_name": "customer", "x_column": "c_nationkey", "y_column": "c_acctbal"},
            {"dataset_name": "supplier", "x_column": "s_nationkey", "y_column": "s_acctbal", "name": "suppliers"},
        ],
    )


@query("orders")
def findings(orders):
    return ts.findings(orders_with_gaps(orders), "o_orderdate", "price", "priority", leading=3)
