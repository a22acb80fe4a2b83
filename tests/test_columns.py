import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import tabscope as ts
import tabscope.operators.quantiles
from conftest import as_dict, one, records
from tabscope.operators import profile
from tabscope.operators.quantiles import quantiles


def test_statistics_agree_with_pandas(spark):
    rng = np.random.default_rng(1)
    frame = pd.DataFrame({"skewed": rng.exponential(5, 501), "normal": rng.normal(-3, 2, 501)})
    facts = {r["column"]: r for r in ts.statistics(spark.createDataFrame(frame)).collect()}
    for name, series in frame.items():
        row = facts[name]
        assert row["mean"] == pytest.approx(series.mean(), abs=0.006)
        assert row["std"] == pytest.approx(series.std(), abs=0.006)
        assert row["skewness"] == pytest.approx(series.skew(), abs=0.006)
        assert row["q25"] == pytest.approx(series.quantile(0.25), abs=0.006)
        assert row["median"] == pytest.approx(series.median(), abs=0.006)


def test_many_columns_are_chunked(spark):
    wide = spark.range(10).select(*[(F.col("id") * i).cast("double").alias(f"c{i}") for i in range(1, 20)])
    means = as_dict(ts.statistics(wide), "column", "mean")
    assert means == {f"c{i}": 4.5 * i for i in range(1, 20)}


SPECIAL = [0.0, -0.0, 1.0, -1.0, 0.5, 1e-320, -1e-320, 5e-324, 1e308, -1e308, 1.7e308, 2.0**29, 2.0**29 - 2.0**-23, 3.0]


@pytest.mark.parametrize("few_groups", [True, False])
@pytest.mark.parametrize("seed", range(4))
def test_quantiles_against_brute_force(spark, seed, few_groups):
    rng = random.Random(seed)
    rows = []
    for group in ("hot", "cold", "tiny", "nothing", None):
        size = {"hot": 3000, "cold": 200, "tiny": 2, "nothing": 3, None: 50}[group]
        for _ in range(size):
            kind = rng.random()
            if group == "nothing" or kind < 0.05:
                value = None
            elif group == "hot" and kind < 0.4:
                value = 7.25
            elif kind < 0.5:
                value = rng.choice(SPECIAL)
            elif kind < 0.8:
                value = 7.25 + rng.random() * 1e-6
            else:
                value = rng.uniform(-1e6, 1e6) ** rng.choice([1, 3])
            rows.append((group, value))
    p = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    found = {r["g"]: (r["n"], r["q"]) for r in quantiles(df, ["g"], "v", p, few_groups).collect()}
    assert set(found) == {"hot", "cold", "tiny", "nothing", None}
    for group, (n, q) in found.items():
        values = sorted(v for g, v in rows if g == group and v is not None)
        assert n == len(values)
        for share, got in zip(p, q):
            if not values:
                assert got is None
                continue
            place = (n - 1) * share
            low, high = values[math.floor(place)], values[math.ceil(place)]
            assert got == pytest.approx(low + (high - low) * (place - math.floor(place)), rel=1e-9)


@pytest.mark.parametrize("few_groups", [True, False])
@pytest.mark.parametrize("kind", ["ids", "times", "far", "wide"])
def test_large_buckets_are_cut(spark, monkeypatch, kind, few_groups):
    monkeypatch.setattr(tabscope.operators.quantiles, "MOST_SORTED", 50)
    rng = np.random.default_rng(4)
    values = {
        "ids": 1e12 + rng.permutation(30_000),
        "times": 1.7e9 + rng.integers(0, 86_400, 30_000),
        "far": 1.0 + 2.0**-52 * rng.integers(0, 2**20, 30_000),
        "wide": np.concatenate([rng.normal(0, 1e-300, 10_000), rng.normal(1e300, 1, 20_000)]),
    }[kind]
    groups = np.where(rng.random(30_000) < 0.9, "hot", "other")
    df = spark.createDataFrame(pd.DataFrame({"g": groups, "v": values})).repartition(6)
    p = [0.0, 0.1, 0.25, 0.5, 0.999, 1.0]
    for r in quantiles(df, ["g"], "v", p, few_groups).collect():
        assert r["q"] == pytest.approx(np.quantile(values[groups == r["g"]], p).tolist(), rel=1e-15)


def test_quantiles_with_infinities(spark):
    df = spark.createDataFrame([("a", v) for v in (float("inf"), 1.0, 2.0, -float("inf"), 3.0)], "g string, v double")
    assert quantiles(df, ["g"], "v", [0.25, 0.5, 0.75], True).first()["q"] == [1.0, 2.0, 3.0]


def test_outlier_examples_are_the_farthest(spark):
    values = [float(v % 5) for v in range(100)] + [50.0, -60.0, 70.0, 70.0, 80.0, -90.0, 100.0]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    assert [r[2] for r in records(ts.outlier_examples(df, "v").orderBy("rank"))] == [100.0, -90.0, 80.0, 70.0, 70.0]


def test_correlation_agrees_with_pandas(spark):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame(rng.normal(1e6, 1, (400, 5)), columns=list("abcde"))
    frame["b"] += 0.7 * frame["a"]
    frame["c"] -= 0.4 * frame["a"]
    frame = frame.mask(rng.random(frame.shape) < 0.1)
    # Constant over the rows it shares with a, but not constant.
    frame["f"] = np.where(frame["a"].isna(), np.arange(400.0), 3.0)
    want = frame.corr()
    df = spark.createDataFrame(frame).repartition(6)
    found = {(r["column_1"], r["column_2"]): r["correlation"] for r in ts.correlation_analysis(df, top_n=20).collect()}
    assert ("a", "f") not in found and len(found) == 14
    for (a, b), r in found.items():
        assert r == pytest.approx(want.loc[a, b], abs=0.0006)
    extremes = {r["kind"]: (r["column_1"], r["column_2"]) for r in ts.correlation_extremes(df).collect()}
    assert extremes == {"strongest_positive": ("a", "b"), "strongest_negative": ("a", "c")}


def profile_of(df, **options):
    return {r["column"]: r for r in ts.dataset_info(df, **options).collect()}


def test_profile_counts_whole_long_texts(spark):
    same = "x" * 5000
    df = spark.createDataFrame([(same + "a",), (same + "b",), (same + "b",)], "t string")
    assert profile_of(df)["t"]["unique_count"] == 2
    assert profile_of(df, approx=True)["t"]["unique_count"] == 2


def test_profile_counts_values_like_numbers(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (None,)], "v double")
    row = profile_of(df)["v"]
    assert (row["unique_count"], row["null_count"]) == (1, 2)




def test_whole_numbers_are_counted_by_bits(spark):
    rng = np.random.default_rng(7)
    n = 4000
    frame = pd.DataFrame({
        "dense": rng.integers(-900, 900, n), "sparse": rng.integers(-(2**63), 2**63 - 1, n), "few": rng.integers(0, 2, n),
        "key": rng.permutation(n) - 63, "edge": rng.choice([-(2**63), 2**63 - 1, -1, 0, 63, 64, -64, -65], n), "text": rng.integers(0, 50, n).astype(str),
    })
    empty = rng.random(n) < 0.1
    df = spark.createDataFrame(frame.assign(empty=empty)).repartition(5)
    df = df.select(
        *[F.when(~F.col("empty"), F.col(c)).alias(c) for c in frame], F.col("few").cast("tinyint").alias("tiny"),
        F.date_add(F.lit("1969-12-01").cast("date"), (F.col("dense") % 100).cast("int")).alias("day"), F.lit(None).cast("int").alias("nothing"),
    )
    want = df.toPandas().nunique().to_dict()
    assert as_dict(ts.dataset_info(df), "column", "unique_count") == want
    assert want["nothing"] == 0 and want["edge"] == 8


def test_dense_keys_move_a_word_for_64_of_them(spark):
    words = profile._distinct_counts(spark.range(0, 640_000, 1, 1).toDF("k"))
    plan = words._jdf.queryExecution().executedPlan().toString()
    assert "cast(k" not in plan and "bit_or" in plan
    assert words.collect() == [(0, 640_000)]
    assert spark.range(640_000).groupBy(F.shiftright("id", 6)).count().count() == 10_000
