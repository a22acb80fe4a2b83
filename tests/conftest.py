from __future__ import annotations

import datetime as dt
import os
import sys
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import tabscope as ts  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def day(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def records(df, *columns):
    """Rows as tuples in their order, of the named columns or of all."""
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def one(df):
    """The only row, as a dictionary."""
    (row,) = df.collect()
    return row.asDict()


@contextmanager
def refused(code):
    """The block asks for what can't be answered, for the reason of that code."""
    with pytest.raises(ts.AnalysisError) as error:
        yield
    assert error.value.code == code and error.value.message


@pytest.fixture(scope="session")
def crates():
    """Crates picked on seven fields in three years, as pandas has them: gaps, a constant, few far-off weights."""
    rng = np.random.default_rng(77)
    n = 600
    day_of = pd.Timestamp("2021-03-02") + pd.to_timedelta(rng.integers(0, 950 * 24, n), unit="h")
    kilos = np.round(rng.gamma(9.0, 2.5, n), 1)
    kilos[rng.choice(n, 6, replace=False)] = [95.5, 120.0, 88.0, 200.0, 101.0, 150.5]
    frame = pd.DataFrame(
        {
            "lot": [f"lot-{i:05d}" for i in range(n)],
            "picked": day_of,
            "field": rng.choice(["Elm", "Fen", "Gate", "Hill", "Ink", "Jay", "Kiln"], n, p=[0.4, 0.2, 0.1, 0.1, 0.1, 0.05, 0.05]),
            "sort": rng.choice(["plum", "pear"], n),
            "kilos": kilos,
            "rain": rng.integers(0, 40, n),
            "organic": rng.random(n) < 0.3,
            "pickers": 4,
            "logged": [d.strftime("%d/%m/%Y") for d in day_of],
        }
    )
    frame["sugar"] = np.round(9 + 0.1 * frame["rain"] + rng.normal(0, 1, n), 2)
    frame.loc[rng.random(n) < 0.08, "kilos"] = np.nan
    frame.loc[rng.random(n) < 0.05, "field"] = None
    frame["seen"] = None
    return frame


@pytest.fixture(scope="session")
def harvest(spark, crates):
    schema = "lot string, picked timestamp_ntz, field string, sort string, kilos double, rain bigint, organic boolean, pickers bigint, logged string, sugar double, seen string"
    rows = [tuple(None if v is None or v != v and not isinstance(v, float) else v.to_pydatetime() if isinstance(v, pd.Timestamp) else v for v in r) for r in crates[[c.split()[0] for c in schema.split(", ")]].itertuples(index=False)]
    return spark.createDataFrame([tuple(x.item() if isinstance(x, np.generic) else x for x in r) for r in rows], schema).repartition(5)
