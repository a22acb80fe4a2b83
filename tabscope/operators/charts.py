"""The numbers behind charts; drawing them is left to the caller."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.errors import AnalysisError
from tabscope.functions.columns import (
    col,
    drop_missing,
    family_of,
    is_datetime,
    is_numeric,
    number,
    numeric_columns,
    require_choice,
    require_column,
    require_frame,
    require_numeric,
    require_rows,
    type_of,
)
from tabscope.functions.filters import where_values
from tabscope.functions.periods import PERIODS
from tabscope.operators.aggregates import AGGREGATES, check_aggregate
from tabscope.operators.groupby import groupby_analysis
from tabscope.operators.quantiles import has_few_groups, quantiles
from tabscope.operators.timeseries import bucketed

CHART_TYPES = ("bar", "line", "scatter", "histogram", "box")
DEFAULT_BINS = 20
_WHISKER = 1.5


def create_visualization(
    df: DataFrame,
    chart_type: str,
    x_column: str,
    y_column: str | None = None,
    agg_function: str | None = None,
    period: str | None = None,
    filter_values: Sequence | None = None,
    top_n: int | None = None,
    sort_order: str | None = None,
    bins: int = DEFAULT_BINS,
    strict: bool = False,
    max_groups: int | None = None,
    pixels: int | None = None,
) -> DataFrame:
    """The data of a bar, line, scatter, histogram or box chart.

    With ``agg_function``: ``x, y`` per category (text, rounded, limited by
    ``top_n`` or ``max_groups``) or per calendar period when x is a date (default month).
    Without: all ``x, y`` points with both values, ordered when x is a date;
    bins of a histogram; quartiles, whiskers and outlier counts of a box plot.
    ``pixels`` leaves of a line what can be seen at that width (see ``visible_line``).
    """
    require_frame(df)
    require_choice("Chart type", chart_type, CHART_TYPES)
    require_column(df, x_column)
    if y_column is not None:
        require_column(df, y_column)
    if chart_type != "histogram" and y_column is None:
        raise AnalysisError("y_required", f"A {chart_type} chart shows two columns; name the second as y_column.")
    if agg_function is not None:
        require_choice("Aggregation function", agg_function, AGGREGATES)
        if chart_type == "histogram":
            raise AnalysisError("no_aggregate", "A histogram counts and takes no aggregate.")
    if pixels is not None and (chart_type != "line" or agg_function is not None):
        raise AnalysisError("no_pixels", "Only a line of points can be left in pixels.")
    rows = where_values(df, x_column, filter_values)
    if strict and filter_values:
        require_rows(rows, f"The filter on '{x_column}' leaves nothing.")
    if agg_function is not None:
        return _aggregated(rows, x_column, y_column, agg_function, period, top_n, sort_order, max_groups)
    if chart_type == "histogram":
        return histogram(drop_missing(rows, [c for c in (x_column, y_column) if c]), x_column, bins)
    if chart_type == "box":
        return box_plot(rows, x_column, y_column)
    if pixels is not None:
        return visible_line(rows, x_column, y_column, pixels).select("x", "y").orderBy("x", "y")
    points = drop_missing(rows, [x_column, y_column]).select(col(x_column).alias("x"), col(y_column).alias("y"))
    if not is_datetime(df, x_column):
        return points
    # Sorted by more than x, so that a date with many points is spread over tasks.
    numbered = points.withColumn("_i", F.monotonically_increasing_id())
    return numbered.orderBy("x", "y", "_i").drop("_i")


def visible_line(df: DataFrame, x_column: str, y_column: str, pixels: int) -> DataFrame:
    """The points of a line that decide what is seen of it on ``pixels`` columns of equal width: ``pixel, x, y``.

    In each column these are the first, last, lowest and highest point, at most four: drawn in the order of x, they
    cover the same pixels as all points. One grouped aggregate, combined in every task, after one that finds the ends of x;
    no point is sorted or exchanged. x is a date or a number, y a number; points without both or with an infinite x are left
    out. Among points of the lowest y the first is kept, among those of the highest the last, among those of one x the lowest
    as first and the highest as last.
    """
    require_frame(df)
    for name in (x_column, y_column):
        require_column(df, name)
    require_numeric(df, y_column, "a line needs its height")
    if pixels <= 0:
        raise AnalysisError("bad_pixels", "The number of pixels has to be above 0.")
    if is_datetime(df, x_column):
        at = col(x_column).cast("timestamp_ntz")
        seconds = F.unix_date(at.cast("date")).cast("bigint") * 86_400 + F.hour(at) * 3600 + F.minute(at) * 60
        place = seconds * 1_000_000 + (F.date_part(F.lit("SECOND"), at) * 1_000_000).cast("bigint")
    else:
        require_numeric(df, x_column, "a line runs along dates or numbers")
        place = number(df, x_column)
    points = drop_missing(df, [x_column, y_column]).select(col(x_column).alias("x"), col(y_column).alias("y"), place.alias("at"))
    points = points.where(F.abs(F.col("at").cast("double")) < float("inf"))
    ends = points.agg(F.min("at").alias("first"), F.max("at").alias("last"))
    first, last = ends.select("first").scalar(), ends.select("last").scalar()
    share = F.try_divide((F.col("at") - F.col("first")).cast("double"), (F.col("last") - F.col("first")).cast("double"))
    pixel = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * pixels), F.lit(pixels - 1)).cast("int")
    placed = points.withColumns({"first": first, "last": last}).select(pixel.alias("pixel"), F.struct("x", "y").alias("along"), F.struct("y", "x").alias("up"))
    seen = placed.groupBy("pixel").agg(F.min("along").alias("a"), F.max("along").alias("b"), F.min("up").alias("c"), F.max("up").alias("d"))
    some = [F.struct(F.col(f"{p}.x").alias("x"), F.col(f"{p}.y").alias("y")) for p in "abcd"]
    return seen.select("pixel", F.inline(F.array_distinct(F.array(*some))))


def _aggregated(
    rows: DataFrame,
    x_column: str,
    y_column: str,
    agg_function: str,
    period: str | None,
    top_n: int | None,
    sort_order: str | None,
    max_groups: int | None,
) -> DataFrame:
    check_aggregate(rows, y_column, agg_function)
    present = drop_missing(rows, [x_column, y_column])
    if is_datetime(rows, x_column):
        used = period or "month"
        require_choice("Time period", used, PERIODS)
        series = bucketed(present, x_column, y_column, used, agg_function)
        return series.select(F.col("period_start").alias("x"), F.col("value").alias("y")).orderBy("x")
    grouped = groupby_analysis(present, x_column, y_column, agg_function, top_n=top_n, sort_order=sort_order, max_groups=max_groups)
    label = F.col("group").cast("string")
    if family_of(type_of(rows, x_column)) == "boolean":
        label = F.initcap(label)  # as where_values takes them
    return grouped.select(label.alias("x"), F.col("value").alias("y"))


def histogram(df: DataFrame, column: str, bins: int = DEFAULT_BINS) -> DataFrame:
    """Counts per equal-width bin: ``bin, lower, upper, count`` (bins without rows left out).

    The last bin includes the maximum; a constant column has one bin. Columns
    that are not numeric are counted per value: ``x, count``.
    """
    require_frame(df)
    require_column(df, column)
    if bins <= 0:
        raise AnalysisError("bad_bins", "The number of bins has to be above 0.")
    if not is_numeric(df, column):
        return df.where(col(column).isNotNull()).groupBy(col(column).alias("x")).agg(F.count("*").alias("count"))
    values = df.select(number(df, column).alias("value")).where(F.col("value").isNotNull())
    ends = values.agg(F.min("value").alias("lowest"), F.max("value").alias("highest"))
    lowest, highest = ends.select("lowest").scalar(), ends.select("highest").scalar()
    placed = values.select("value", lowest.alias("lowest"), highest.alias("highest"))
    width = (F.col("highest") - F.col("lowest")) / bins
    place = F.floor(F.try_divide(F.col("value") - F.col("lowest"), width))
    number_of = F.when(place.isNull(), 0).otherwise(F.least(place, F.lit(bins - 1)))
    counts = placed.groupBy(number_of.cast("int").alias("bin"), "lowest", "highest").agg(F.count("*").alias("count"))
    return counts.select(
        "bin",
        (F.col("lowest") + F.col("bin") * width).alias("lower"),
        F.when(F.col("bin") == bins - 1, F.col("highest"))
        .otherwise(F.col("lowest") + (F.col("bin") + 1) * width)
        .alias("upper"),
        "count",
    ).orderBy("bin")


def box_plot(df: DataFrame, x_column: str, y_column: str) -> DataFrame:
    """Box plot numbers of y per x.

    Columns: x, count, min, q25, median, q75, max, lower_whisker, upper_whisker
    (the last values within 1.5 interquartile ranges), outlier_count.
    """
    require_frame(df)
    require_column(df, x_column)
    require_column(df, y_column)
    require_numeric(df, y_column, "a box plot cannot be made")
    rows = drop_missing(df, [x_column, y_column]).select(
        col(x_column).alias("x"), number(df, y_column).alias("value")
    )
    few = has_few_groups(rows, ["x"])
    q = F.col("q")
    reach = _WHISKER * (q[2] - q[0])
    boxes = quantiles(rows, ["x"], "value", [0.25, 0.5, 0.75], few).select(
        "x", "q", (q[0] - reach).alias("low"), (q[2] + reach).alias("high")
    )
    inside = F.col("value").between(F.col("low"), F.col("high"))
    return (
        rows.join(F.broadcast(boxes) if few else boxes, "x")
        .groupBy("x", "q")
        .agg(
            F.count("*").alias("count"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            F.min(F.when(inside, F.col("value"))).alias("lower_whisker"),
            F.max(F.when(inside, F.col("value"))).alias("upper_whisker"),
            F.count_if(~inside).alias("outlier_count"),
        )
        .select(
            "x", "count", "min", q[0].alias("q25"), q[1].alias("median"), q[2].alias("q75"), "max",
            "lower_whisker", "upper_whisker", "outlier_count",
        )
    )


def create_multi_dataset_visualization(
    datasets: Mapping[str, DataFrame],
    series: Sequence[Mapping[str, str]],
    chart_type: str = "line",
    strict: bool = False,
) -> DataFrame:
    """Several series from several tables in one frame: ``series, x, y``.

    Every entry names ``dataset_name``, ``x_column``, ``y_column`` and
    optionally ``name`` (default ``dataset: y``). Rows need both values; y must
    be numeric. x is text, so that series of unlike types share an axis.
    ``strict`` raises when a series has no rows.
    """
    if not datasets:
        raise AnalysisError("no_dataset", "There is no table to draw series from.")
    require_choice("Chart type", chart_type, ("line", "bar"))
    if not series:
        raise AnalysisError("no_series", "Name at least one series.")
    parts = []
    for spec in series:
        dataset, x, y = spec.get("dataset_name"), spec.get("x_column"), spec.get("y_column")
        if dataset not in datasets:
            raise AnalysisError("unknown_dataset", f"A series refers to '{dataset}', which is no table.", datasets)
        df = datasets[dataset]
        for name in (x, y):
            require_column(df, name, f"dataset '{dataset}'")
        if not is_numeric(df, y):
            raise AnalysisError(
                "not_numeric", f"'{y}' of '{dataset}' holds no numbers.", numeric_columns(df)
            )
        points = drop_missing(df, [x, y]).select(
            F.lit(spec.get("name") or f"{dataset}: {y}").alias("series"),
            (col(x).cast("timestamp_ntz") if family_of(type_of(df, x)) == "datetime" else col(x))
            .cast("string")
            .alias("x"),
            number(df, y).alias("y"),
        )
        if strict:
            require_rows(points, f"The series of '{dataset}' has no complete row.")
        parts.append(points)
    return reduce(DataFrame.unionByName, parts)
