import pytest

import tabscope as ts
from conftest import as_dict, one, records, refused


def grouped(df, *args, **kwargs):
    return as_dict(ts.groupby_analysis(df, *args, **kwargs), "group", "value")


def test_null_groups_vanish_and_all_null_values(spark):
    df = spark.createDataFrame(
        [("a", None), ("a", float("nan")), ("b", 1.0), (None, 5.0)], "g string, v double"
    )
    assert grouped(df, "g", "v", "sum") == {"a": 0.0, "b": 1.0}
    assert grouped(df, "g", "v", "mean") == {"a": None, "b": 1.0}
    assert grouped(df, "g", "v", "median") == {"a": None, "b": 1.0}
    assert grouped(df, "g", "v", "count") == {"a": 0.0, "b": 1.0}
    assert grouped(df, "g", "v", "std") == {"a": None, "b": None}


def test_no_dataset():
    with refused("no_dataset"):
        ts.groupby_analysis(None, "a", "b")


def test_all_groups_unless_fewer_are_asked_for(spark):
    df = spark.createDataFrame([(f"k{i % 130}", i) for i in range(260)], "k string, v bigint")
    assert len(grouped(df, "k", "v")) == 130
    few = grouped(df, "k", "v", max_groups=12)
    assert len(few) == 12 and min(few.values()) == 183.0
    assert one(ts.best_and_worst_group(df, "k", "v")) == {"best_group": "k129", "best_value": 194.0, "worst_group": "k0", "worst_value": 65.0}
    ranks = records(ts.group_ranking(df, "k", "v"))
    assert sorted(ranks) == [(r + 1, f"k{129 - r}", 194.0 - r) for r in range(130)]


def test_integers_and_decimals_stay_exact(spark):
    df = spark.createDataFrame([("a", 2**53 + 1), ("a", 1), ("b", 2**62), ("b", 2**62)], "k string, v bigint")
    assert grouped(df, "k", "v", "sum") == {"a": float(2**53 + 2), "b": float(2**63)}
    cents = df.selectExpr("k", "CAST(0.1 AS decimal(10,2)) AS v")
    assert grouped(cents, "k", "v", "sum") == {"a": 0.2, "b": 0.2}


def test_first_group_wins_ties(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0)], "g string, v double")
    extremes = one(ts.best_and_worst_group(df, "g", "v"))
    assert (extremes["best_group"], extremes["worst_group"]) == ("a", "a")


def test_two_groups_on_a_zero_base(spark):
    df = spark.createDataFrame([("a", 0.0), ("b", 4.0)], "g string, v double")
    assert one(ts.compare_two_groups(df, "g", "v"))["percentage_change"] is None


def test_filters_by_type(spark):
    df = spark.createDataFrame(
        [(1.5, True, "2024-01-01", "x"), (20.0, False, "2024-01-02", "y"), (1e7, None, None, "20")],
        "d double, b boolean, t string, s string",
    ).selectExpr("d", "b", "to_timestamp_ntz(t) AS t", "to_date(t) AS day", "CAST(d AS decimal(12,2)) AS c", "s")
    def count(name, *values):
        return ts.where_values(df, name, values).count()

    assert count("d", 20) == count("d", "20.0") == 1
    assert count("d", 1e7, "1.5") == 2
    assert count("c", "1.50") == 1
    assert count("b", True) == count("b", "False") == 1
    assert count("t", "2024-01-02") == count("day", "2024-01-02 00:00:00") == 1
    assert count("s", 20) == 1
    assert count("d", "text") == count("t", "text") == 0
    assert ts.where_values(df, "d", None).count() == ts.where_values(df, "d", []).count() == 3
