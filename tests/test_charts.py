"""Chart data beside pandas."""

import numpy as np
import pandas as pd
import pytest

import tabscope as ts
from conftest import as_dict, records, refused


def test_a_bar_for_every_category(harvest, crates):
    bars = as_dict(ts.create_visualization(harvest, "bar", "rain", "kilos", "sum"), "x", "y")
    want = crates.dropna(subset=["kilos"]).groupby("rain")["kilos"].sum()
    assert bars == {str(k): pytest.approx(v, abs=0.006) for k, v in want.items()}
    assert ts.create_visualization(harvest, "bar", "lot", "kilos", "mean").count() == crates["kilos"].notna().sum()
    assert ts.create_visualization(harvest, "bar", "lot", "kilos", "mean", max_groups=7).count() == 7
    top = ts.create_visualization(harvest, "bar", "field", "kilos", "sum", top_n=2)
    assert [r["x"] for r in top.collect()] == list(crates.groupby("field")["kilos"].sum().nlargest(2).index)


def test_labels_can_be_filtered_by(harvest):
    labels = sorted(r["x"] for r in ts.create_visualization(harvest, "bar", "organic", "kilos", "mean").collect())
    assert labels == ["False", "True"]
    assert ts.where_values(harvest, "organic", labels).count() == harvest.count()


def test_lines(harvest, crates):
    known = crates.dropna(subset=["kilos"])
    line = ts.create_visualization(harvest, "line", "picked", "kilos", "mean", period="quarter").collect()
    want = known.groupby(known["picked"].dt.to_period("Q"))["kilos"].mean()
    assert [r["x"] for r in line] == [p.start_time.to_pydatetime() for p in want.index]
    assert [r["y"] for r in line] == pytest.approx(want.tolist())
    points = records(ts.create_visualization(harvest, "line", "picked", "kilos"))
    assert [p[0] for p in points] == [t.to_pydatetime() for t in sorted(known["picked"])]
    assert ts.create_visualization(harvest, "scatter", "sugar", "kilos").count() == len(known)


@pytest.mark.parametrize("bins", [1, 8, 20])
def test_histogram(harvest, crates, bins):
    v = crates["sugar"]
    edges = np.linspace(v.min(), v.max(), bins + 1)
    counts = np.minimum(np.floor((v - v.min()) / ((v.max() - v.min()) / bins)), bins - 1).value_counts()
    got = {r["bin"]: r for r in ts.create_visualization(harvest, "histogram", "sugar", bins=bins).collect()}
    assert {b: r["count"] for b, r in got.items()} == counts.to_dict()
    assert all(r["lower"] == pytest.approx(edges[b]) and r["upper"] == pytest.approx(edges[b + 1]) for b, r in got.items())


def test_histograms_of_other_columns(harvest, crates):
    assert as_dict(ts.histogram(harvest, "field"), "x", "count") == crates["field"].value_counts().to_dict()
    assert [(r["bin"], r["count"]) for r in ts.histogram(harvest, "pickers").collect()] == [(0, len(crates))]
    assert ts.histogram(harvest.limit(0), "kilos").isEmpty()


def test_boxes(harvest, crates):
    boxes = {r["x"]: r for r in ts.box_plot(harvest, "field", "kilos").collect()}
    for field, v in crates.dropna(subset=["kilos"]).groupby("field")["kilos"]:
        q = v.quantile([0.25, 0.5, 0.75]).tolist()
        reach = 1.5 * (q[2] - q[0])
        inside = v[(v >= q[0] - reach) & (v <= q[2] + reach)]
        b = boxes[field]
        assert (b["q25"], b["median"], b["q75"]) == pytest.approx(tuple(q))
        assert (b["count"], b["min"], b["max"], b["outlier_count"]) == (len(v), v.min(), v.max(), len(v) - len(inside))
        assert (b["lower_whisker"], b["upper_whisker"]) == (inside.min(), inside.max())


def test_series_of_two_tables(spark, harvest, crates):
    rain = spark.createDataFrame(pd.DataFrame({"month": [1, 2, 3], "litres": [4.5, np.nan, 2.0]}))
    chart = ts.create_multi_dataset_visualization(
        {"rain": rain, "crates": harvest},
        [{"dataset_name": "rain", "x_column": "month", "y_column": "litres", "name": "rainfall"}, {"dataset_name": "crates", "x_column": "picked", "y_column": "rain"}],
    )
    assert sorted(r[1:] for r in records(chart) if r[0] == "rainfall") == [("1", 4.5), ("3", 2.0)]
    assert sum(r[0] == "crates: rain" for r in records(chart)) == len(crates)


def test_charts_that_cannot_be_made(harvest):
    tables, good = {"crates": harvest}, {"dataset_name": "crates", "x_column": "rain", "y_column": "kilos"}
    for code, call in {
        "y_required": lambda: ts.create_visualization(harvest, "box", "field"),
        "no_aggregate": lambda: ts.create_visualization(harvest, "histogram", "kilos", agg_function="sum"),
        "unsupported": lambda: ts.create_visualization(harvest, "radar", "field"),
        "unknown_column": lambda: ts.create_visualization(harvest, "bar", "barn", "kilos"),
        "no_rows": lambda: ts.create_visualization(harvest, "bar", "field", "kilos", filter_values=["Moor"], strict=True),
        "bad_bins": lambda: ts.histogram(harvest, "kilos", 0),
        "no_dataset": lambda: ts.create_multi_dataset_visualization({}, [good]),
        "no_series": lambda: ts.create_multi_dataset_visualization(tables, []),
        "unknown_dataset": lambda: ts.create_multi_dataset_visualization(tables, [good | {"dataset_name": "barn"}]),
        "not_numeric": lambda: ts.create_multi_dataset_visualization(tables, [good | {"y_column": "lot"}]),
    }.items():
        with refused(code):
            call()


def drawn(points, ends, heights, width, height):
    """Pixels that straight lines from point to point, in the order of x, touch: in whole pixels, from column to column."""
    (x0, x1), (y0, y1) = ends, heights
    at = [(min(int((x - x0) / (x1 - x0) * width), width - 1), min(int((y - y0) / (y1 - y0) * height), height - 1)) for x, y in sorted(points)]
    seen = set(at)
    for (a, b), (c, d) in zip(at, at[1:]):
        if a == c:
            seen |= {(a, k) for k in range(min(b, d), max(b, d) + 1)}
        else:
            seen |= {(k, round(b + (d - b) * (k - a) / (c - a))) for k in range(a, c + 1)}
    return seen


@pytest.mark.parametrize("seed,pixels", [(0, 40), (1, 7), (2, 300)])
def test_a_visible_line_covers_the_same_pixels(spark, seed, pixels):
    rng = np.random.default_rng(seed)
    x = rng.permutation(5000)[:2000].astype(float)
    points = list(zip(x.tolist(), np.cumsum(rng.normal(0, 1, 2000)).tolist()))
    df = spark.createDataFrame(points + [(None, 1.0), (2.0, None), (float("inf"), 0.0), (1.0, float("nan"))], "x double, y double").repartition(5)
    left = [tuple(r) for r in ts.create_visualization(df, "line", "x", "y", pixels=pixels).collect()]
    assert len(left) <= 4 * pixels and set(left) <= set(points) and left == sorted(left)
    ends, heights = [(min(c), max(c)) for c in zip(*points)]
    assert drawn(left, ends, heights, pixels, 50) == drawn(points, ends, heights, pixels, 50)


def test_visible_lines_of_few_points(spark):
    day = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ'2024-01-01 10:00:00', 3), (TIMESTAMP_NTZ'2024-01-01 10:00:00', 1) AS t(at, n)")
    assert sorted(tuple(r)[0::2] for r in ts.visible_line(day, "at", "n", 10).collect()) == [(0, 1), (0, 3)]
    assert ts.visible_line(day.where("false"), "at", "n", 10).collect() == []
    with refused("bad_pixels"):
        ts.visible_line(day, "at", "n", 0)
    with refused("no_pixels"):
        ts.create_visualization(day, "scatter", "at", "n", pixels=5)
