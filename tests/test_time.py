import datetime as dt

import pytest
from pyspark.sql import functions as F

import tabscope as ts
from conftest import as_dict, day, one, records, refused


def test_period_starts_and_labels(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 15, 10, 30),)], "t timestamp_ntz")
    expected = {
        "day": (day("2024-03-15"), "2024-03-15"),
        "week": (day("2024-03-11"), "Week of 2024-03-11"),
        "month": (day("2024-03-01"), "2024-03"),
        "quarter": (day("2024-01-01"), "2024-Q1"),
        "year": (day("2024-01-01"), "2024"),
    }
    for kind in ("timestamp_ntz", "timestamp", "date"):
        typed = df.select(F.col("t").cast(kind))
        for period, (start, label) in expected.items():
            bucketed = ts.add_period_column(typed, "t", period)
            assert records(bucketed.select("period_start", ts.period_label(F.col("period_start"), period))) == [
                (start, label)
            ]


def test_unknown_label_and_period(spark):
    nothing = spark.createDataFrame([(None,)], "t timestamp_ntz")
    assert records(nothing.select(ts.period_label(F.col("t"), "month"))) == [("Unknown",)]
    with refused("unsupported"):
        ts.add_period_column(nothing, "t", "century")


def test_end_date_is_midnight(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 2), 1.0), (dt.datetime(2024, 1, 2, 1), 2.0)], "t timestamp_ntz, v double"
    )
    assert records(ts.time_analysis(df, "t", "v", "day", "sum", end_date="2024-01-02"), "value") == [(1.0,)]


def test_too_many_groups(spark):
    df = spark.createDataFrame([(day("2024-01-01"), f"g{i}", 1.0) for i in range(51)], "t timestamp_ntz, g string, v double")
    with refused("too_many_groups"):
        ts.time_analysis(df, "t", "v", group_column="g", max_groups=50)
    assert ts.time_analysis(df, "t", "v", group_column="g").count() == 51


def series_of(spark, *values):
    rows = [(day(f"2024-{i:02d}-01"), v) for i, v in enumerate(values, start=1)]
    return spark.createDataFrame(rows, "Date timestamp_ntz, Sales double")


@pytest.mark.parametrize(
    "values, trend, change",
    [
        ((100.0, 200.0, 300.0), "strictly_increasing", 200.0),
        ((300.0, 200.0, 100.0), "strictly_decreasing", -200.0),
        ((150.0, 150.0, 150.0), "stable", 0.0),
        ((100.0, 50.0, 300.0), "increasing", 200.0),
        ((300.0, 50.0, 100.0), "decreasing", -200.0),
        ((100.0, 50.0, 100.0), "fluctuating", 0.0),
        ((100.0,), "insufficient_data", None),
    ],
)
def test_trends(spark, values, trend, change):
    facts = one(ts.series_summary(series_of(spark, *values), "Date", "Sales"))
    assert (facts["trend_direction"], facts["overall_change"]) == (trend, change)


def test_earliest_period_wins_ties(spark):
    facts = one(ts.series_summary(series_of(spark, 5.0, 5.0, 4.0, 4.0), "Date", "Sales"))
    assert (facts["best_period"], facts["worst_period"]) == ("2024-01", "2024-03")


def test_zero_base(spark):
    df = spark.createDataFrame([(day("2023-01-01"), 0.0), (day("2024-01-01"), 150.0)], "Date timestamp_ntz, v double")
    assert records(ts.percentage_change(df, "Date", "v", "year"), "previous_value", "percentage_change") == [(0.0, None)]
    assert as_dict(ts.change_highlights(df, "Date", "v", "year"), "kind", "absolute_change") == {"latest_change": 150.0}


def test_latest_24_changes(spark):
    rows = [(dt.datetime(2020 + i // 12, i % 12 + 1, 1), float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, v double")
    latest = records(ts.percentage_change(df, "t", "v", max_changes=24), "current_value")
    assert [v for (v,) in latest] == [float(i) for i in range(16, 40)]
    assert ts.percentage_change(df, "t", "v").count() == 39


def test_too_few_periods(spark):
    with refused("too_few_periods"):
        ts.percentage_change(series_of(spark, 1.0), "Date", "Sales", strict=True)


def test_date_bounds_by_type(spark):
    rows = [(dt.date(2024, 1, d), dt.datetime(2024, 1, d, 12)) for d in (1, 2, 3)]
    df = spark.createDataFrame(rows, "day date, noon timestamp_ntz")
    def days(column, start, end):
        return [r["day"].day for r in ts.where_dates(df, column, start_date=start, end_date=end).collect()]

    assert days("day", "2024-01-01", "2024-01-02") == [1, 2]
    assert days("day", "2024-01-01 06:00", "2024-01-02 06:00") == [2]
    assert days("noon", "2024-01-01", "2024-01-02") == [1]
    assert days("noon", dt.datetime(2024, 1, 1, 12), dt.date(2024, 1, 3)) == [1, 2]


