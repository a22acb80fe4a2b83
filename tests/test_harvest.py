"""The operators on one table of the tests' own, beside pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import tabscope as ts
from conftest import as_dict, one, records, refused


def half_up(v, digits=2):
    return None if pd.isna(v) else float(np.floor(v * 10**digits + 0.5 + 1e-9) / 10**digits)


def close(got, want):
    assert set(got) == set(want)
    for k, v in want.items():
        assert (got[k] is None and pd.isna(v)) or got[k] == pytest.approx(v, abs=0.0051), k


AGGREGATES = {"mean": "mean", "sum": "sum", "count": "count", "min": "min", "max": "max", "median": "median", "std": "std"}


@pytest.mark.parametrize("how", AGGREGATES)
def test_groups(harvest, crates, how):
    got = as_dict(ts.groupby_analysis(harvest, "field", "kilos", how), "group", "value")
    close(got, getattr(crates.groupby("field")["kilos"], AGGREGATES[how])().to_dict())


def test_groups_of_other_columns(harvest, crates):
    close(as_dict(ts.groupby_analysis(harvest, "sort", "organic", "mean"), "group", "value"), crates.groupby("sort")["organic"].mean().to_dict())
    close(as_dict(ts.groupby_analysis(harvest, "organic", "lot", "count"), "group", "value"), crates.groupby("organic")["lot"].count().to_dict())
    some = ts.groupby_analysis(harvest, "rain", "kilos", "sum", filter_values=["3", 4, 11])
    assert {r["group"] for r in some.collect()} == {3, 4, 11}
    dates = [r["group"] for r in ts.groupby_analysis(harvest, "picked", "kilos", "sum").collect()]
    assert dates == sorted(dates) and len(dates) == crates["picked"].nunique()


def test_ranking_and_extremes(harvest, crates):
    sums = crates.groupby("field")["kilos"].sum().sort_values(ascending=False)
    assert [r["group"] for r in ts.group_ranking(harvest, "field", "kilos", "sum").orderBy("rank").collect()] == list(sums.index)
    assert [r["group"] for r in ts.groupby_analysis(harvest, "field", "kilos", "sum", top_n=3).collect()] == list(sums.index[:3])
    assert [r["group"] for r in ts.groupby_analysis(harvest, "field", "kilos", "sum", top_n=2, sort_order="asc").collect()] == list(sums.index[::-1][:2])
    ends = one(ts.best_and_worst_group(harvest, "field", "kilos", "sum"))
    assert (ends["best_group"], ends["worst_group"]) == (sums.index[0], sums.index[-1])


def test_two_groups_side_by_side(harvest, crates):
    pear, plum = (half_up(crates.groupby("sort")["kilos"].mean()[s]) for s in ("pear", "plum"))
    pair = one(ts.compare_two_groups(harvest, "sort", "kilos"))
    assert (pair["group_1"], pair["group_2"]) == ("pear", "plum")
    assert pair["absolute_difference"] == pytest.approx(abs(plum - pear), abs=0.011)
    assert pair["percentage_change"] == pytest.approx(100 * (plum - pear) / pear, abs=0.011)
    assert ts.compare_two_groups(harvest, "field", "kilos").isEmpty()
    ordered = one(ts.compare_two_groups(harvest, "field", "kilos", top_n=2, sort_order="asc"))
    assert ordered["value_1"] <= ordered["value_2"]


def test_requests_that_cannot_be_met(harvest):
    for code, call in {
        "unknown_column": lambda: ts.groupby_analysis(harvest, "barn", "kilos"),
        "not_numeric": lambda: ts.groupby_analysis(harvest, "field", "lot"),
        "unsupported": lambda: ts.groupby_analysis(harvest, "field", "kilos", "mode"),
        "no_rows": lambda: ts.groupby_analysis(harvest, "field", "kilos", filter_values=["Moor"], strict=True),
        "not_a_date": lambda: ts.time_analysis(harvest, "field", "kilos"),
        "bad_date": lambda: ts.time_analysis(harvest, "picked", "kilos", start_date="soon"),
        "two_years": lambda: ts.compare_years(harvest, "picked", "kilos", 2021, None),
        "bad_multiplier": lambda: ts.outlier_analysis(harvest, multiplier=-2),
        "no_values": lambda: ts.statistics(harvest.withColumn("void", F.lit(None).cast("double")), "void", strict=True),
        "no_numeric": lambda: ts.statistics(harvest.select("lot")),
        "too_few_columns": lambda: ts.correlation_analysis(harvest, columns=["kilos"]),
        "constant": lambda: ts.correlation_analysis(harvest, "pickers", strict=True),
    }.items():
        with refused(code):
            call()
    for request in (dict(column="barn"), dict(columns=["kilos", "barn"])):
        with refused("unknown_column"):
            ts.correlation_analysis(harvest, **request)
    for request in (dict(column="lot"), dict(columns=["kilos", "lot"])):
        with refused("not_numeric"):
            ts.correlation_analysis(harvest, **request)
    assert ts.time_analysis(harvest, "picked", "kilos", year=1999).isEmpty()
    with refused("no_rows"):
        ts.time_analysis(harvest, "picked", "kilos", year=1999, strict=True)


FREQUENCY = {"day": "D", "week": "W-SUN", "month": "M", "quarter": "Q", "year": "Y"}


@pytest.mark.parametrize("period", FREQUENCY)
def test_series(harvest, crates, period):
    known = crates.dropna(subset=["kilos"])
    want = known.groupby(known["picked"].dt.to_period(FREQUENCY[period]))["kilos"].sum()
    got = ts.time_analysis(harvest, "picked", "kilos", period, "sum").collect()
    assert [r["period_start"] for r in got] == [p.start_time.to_pydatetime() for p in want.index]
    assert [r["value"] for r in got] == pytest.approx(want.tolist(), abs=0.006)


def test_series_within_dates_and_groups(harvest, crates):
    known = crates.dropna(subset=["kilos"])
    part = known[(known["picked"] >= "2022-01-01") & (known["picked"] <= "2022-05-31")]
    got = as_dict(ts.time_analysis(harvest, "picked", "kilos", "month", "max", start_date="2022-01-01", end_date="2022-05-31"), "period", "value")
    close(got, part.groupby(part["picked"].dt.strftime("%Y-%m"))["kilos"].max().to_dict())
    months = {r["period"] for r in ts.time_analysis(harvest, "picked", "kilos", year=2023).collect()}
    assert months == set(known[known["picked"].dt.year == 2023]["picked"].dt.strftime("%Y-%m"))
    series = ts.time_analysis(harvest, "picked", "kilos", "year", "count", group_column="field", filter_values=["Elm", "Ink"])
    some = known[known["field"].isin(["Elm", "Ink"])]
    assert {(r["period"], r["group"]): r["value"] for r in series.collect()} == some.groupby([some["picked"].dt.strftime("%Y"), "field"])["kilos"].count().to_dict()
    wide = ts.pivot_series(series, ["Elm", "Ink"])
    assert wide.columns == ["period_start", "period", "Elm", "Ink"] and wide.count() == 3


def test_changes(harvest, crates):
    known = crates.dropna(subset=["kilos"])
    sums = known.groupby(known["picked"].dt.to_period("Q"))["kilos"].sum()
    got = ts.percentage_change(harvest, "picked", "kilos", "quarter").collect()
    assert [r["absolute_change"] for r in got] == pytest.approx(sums.diff().dropna().tolist(), abs=0.006)
    assert [r["percentage_change"] for r in got] == pytest.approx((100 * sums.pct_change()).dropna().tolist(), abs=0.006)
    by = {r["kind"]: r for r in ts.change_highlights(harvest, "picked", "kilos", "quarter").collect()}
    assert by["largest_increase"]["percentage_change"] == max(r["percentage_change"] for r in got)
    assert by["latest_change"]["current_period"] == got[-1]["current_period"]
    overall = one(ts.overall_change(harvest, "picked", "kilos", "quarter"))
    assert overall["total_periods_compared"] == len(got)
    assert overall["overall_change"] == pytest.approx(sums.iloc[-1] - sums.iloc[0], abs=0.011)
    summary = one(ts.series_summary(harvest, "picked", "kilos", "quarter", "sum"))
    assert summary["best_value"] == pytest.approx(sums.max(), abs=0.006) and summary["total_periods"] == len(sums)


def test_years(harvest, crates):
    known = crates.dropna(subset=["kilos"])
    for how in ("sum", "median"):
        a, b = (getattr(known[known["picked"].dt.year == y]["kilos"], how)() for y in (2021, 2022))
        years = one(ts.compare_years(harvest, "picked", "kilos", 2021, 2022, how))
        assert (years["previous_value"], years["current_value"]) == (pytest.approx(a, abs=0.006), pytest.approx(b, abs=0.006))
        assert years["comparison_summary"] == ("increased" if b > a else "decreased")
    assert records(ts.percentage_change(harvest, "picked", "kilos", year_1=2021, year_2=2023)) == records(ts.compare_years(harvest, "picked", "kilos", 2021, 2023))
    assert ts.compare_years(harvest, "picked", "kilos", 2021, 1999).isEmpty()


def test_missing(harvest, crates):
    got = {r["column"]: (r["missing_count"], r["missing_percentage"]) for r in ts.missing_values(harvest).collect()}
    want = crates.isna().sum()
    assert got == {c: (n, half_up(100 * n / len(crates))) for c, n in want.items() if n}
    assert one(ts.missing_totals(harvest)) == {"total_rows": len(crates), "total_missing_values": int(want.sum()), "has_missing_values": True}


NUMBERS = ["kilos", "rain", "pickers", "sugar"]


def test_statistics(harvest, crates):
    facts = {r["column"]: r for r in ts.statistics(harvest).collect()}
    assert set(facts) == set(NUMBERS)
    for c in NUMBERS:
        v = crates[c].dropna()
        want = {"count": len(v), "mean": v.mean(), "median": v.median(), "std": v.std(), "min": v.min(), "max": v.max(), "q25": v.quantile(0.25), "q75": v.quantile(0.75)}
        close({k: facts[c][k] for k in want}, want)
    assert facts["kilos"]["skewness"] == pytest.approx(crates["kilos"].skew(), abs=0.006)
    assert (facts["pickers"]["std"], facts["pickers"]["iqr"], facts["pickers"]["skewness"], facts["pickers"]["coefficient_of_variation"]) == (0, 0, 0, None)


def test_outliers(harvest, crates):
    facts = {r["column"]: r for r in ts.outlier_analysis(harvest).collect()}
    assert set(facts) == set(NUMBERS) and facts["pickers"]["is_constant"]
    for c in ("kilos", "rain", "sugar"):
        v = crates[c].dropna()
        a, b = v.quantile(0.25), v.quantile(0.75)
        out = v[(v < a - 1.5 * (b - a)) | (v > b + 1.5 * (b - a))]
        assert (facts[c]["observations"], facts[c]["outlier_count"]) == (len(v), len(out))
    far = [r["value"] for r in ts.outlier_examples(harvest, "kilos", max_examples=3).orderBy("rank").collect()]
    assert far == sorted(crates["kilos"].dropna(), key=lambda x: -abs(x - crates["kilos"].median()))[:3]
    assert ts.outlier_analysis(harvest, max_columns=1).count() == 1


def test_correlations(harvest, crates):
    want = crates[NUMBERS].corr()
    got = {(r["column_1"], r["column_2"]): r["correlation"] for r in ts.correlation_analysis(harvest).collect()}
    assert set(got) == {("kilos", "rain"), ("kilos", "sugar"), ("rain", "sugar")}
    assert all(r == pytest.approx(want.loc[a, b], abs=0.0006) for (a, b), r in got.items())
    assert ts.correlation_analysis(harvest, top_n=1).count() == 1
    assert {r["column_2"] for r in ts.correlation_analysis(harvest, "sugar", ["rain"]).collect()} == {"rain"}
    assert records(ts.constant_columns(harvest)) == [("pickers",)]


def test_infinite_cells_count_as_missing(spark):
    frame = pd.DataFrame({"x": [2.0, 4.0, 5.0, np.inf, 9.0], "y": [1.0, 2.5, np.nan, 3.0, 7.0], "z": [4.0, -np.inf, 2.0, 8.0, 1.0]})
    want = frame.replace([np.inf, -np.inf], np.nan).corr()
    got = {(r["column_1"], r["column_2"]): r["correlation"] for r in ts.correlation_analysis(spark.createDataFrame(frame)).collect()}
    assert len(got) == 3 and all(r == pytest.approx(want.loc[a, b], abs=0.0006) for (a, b), r in got.items())
    many = spark.range(50).select(*[(F.rand(i) + F.col("id") * (i % 3)).alias(f"c{i}") for i in range(12)])
    assert ts.correlation_analysis(many).count() == 66


def test_profile(harvest, crates):
    facts = {r["column"]: r for r in ts.dataset_info(harvest).collect()}
    assert {c: r["semantic_type"] for c, r in facts.items()} == {
        "lot": "categorical", "picked": "datetime", "field": "categorical", "sort": "categorical", "kilos": "numeric",
        "rain": "numeric", "organic": "boolean", "pickers": "numeric", "logged": "datetime", "sugar": "numeric", "seen": "categorical",
    }
    assert {c: r["unique_count"] for c, r in facts.items()} == crates.nunique().to_dict() | {"seen": 0}
    assert facts["seen"]["is_all_null"] and facts["pickers"]["is_constant"] and facts["lot"]["identifier_status"] == "possible"
    assert set(as_dict(ts.candidate_group_columns(harvest), "column", "unique_count")) == {"field", "sort", "organic"}
    assert ts.dataset_info(harvest.limit(0)).isEmpty() and ts.dataset_info(harvest.select()).isEmpty()


def test_samples_and_dates(harvest, crates):
    got = {}
    for r in ts.sample_values(harvest).orderBy("column", "rank").collect():
        got.setdefault(r["column"], []).append(r["value"])
    assert got == {"lot": sorted(crates["lot"])[:5], "field": sorted(crates["field"].dropna().unique())[:5], "sort": ["pear", "plum"], "organic": ["false", "true"]}
    assert ts.date_columns(harvest) == ["picked", "logged"]
    typed = ts.convert_date_columns(harvest)
    assert dict(typed.dtypes)["logged"] == "timestamp_ntz"
    assert typed.where(F.col("logged") != F.to_date("picked").cast("timestamp_ntz")).isEmpty()


def test_findings(harvest, crates):
    rows = ts.findings(harvest, "picked", "kilos", "field", agg_function="sum", leading=2).collect()
    sums = crates.groupby("field")["kilos"].sum().sort_values(ascending=False)
    found = {(r["operator"], r["finding"]): r for r in rows}
    assert found["groupby_analysis", "best group"]["detail"] == sums.index[0]
    assert found["groupby_analysis", "worst group"]["detail"] == sums.index[-1]
    assert found["groupby_analysis", "rank 2"]["detail"] == sums.index[1] and ("groupby_analysis", "rank 3") not in found
    assert found["correlation_analysis", "strongest positive"]["subject"] == "rain & sugar"
    ranks = [r for r in ts.findings(harvest, "picked", "kilos", "field", agg_function="sum").collect() if r["finding"].startswith("rank ")]
    assert len(ranks) == 7


def test_the_order_of_rows_does_not_matter(harvest):
    other = harvest.orderBy(F.rand(9)).repartition(3)
    for build in (ts.statistics, ts.outlier_analysis, ts.correlation_analysis, ts.dataset_info, lambda df: ts.groupby_analysis(df, "field", "kilos", "median")):
        assert sorted(map(str, build(harvest).collect())) == sorted(map(str, build(other).collect()))


def test_name_similarity_makes_bigrams_once(spark):
    names = spark.createDataFrame([("cust_id", "Customer"), ("order key", "orderkey"), (None, "a"), (None, None), ("", "é"), ("aaaa", "aa")], "a string, b string")
    found = names.select(ts.name_similarity(F.col("a"), F.col("b")).alias("s"))
    assert [r.s for r in found.collect()] == [0.75, 0.95, 0.0, 1.0, 0.0, 1.0]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("sequence(") == 2
