import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

import tabscope as ts
from conftest import as_dict, day, one, records
from tabscope.functions.names import looks_like_date


@pytest.fixture
def write(tmp_path):
    def save(content, name="sales.csv"):
        path = tmp_path / name
        path.write_bytes(content.encode() if isinstance(content, str) else content)
        return str(path)

    return save


def types_of(df):
    return dict(df.dtypes)


def test_typed_csv(spark, write):
    df = ts.load_dataset(spark, write("Date,Store,Sales\n2024-01-01,20,100\n2024-02-01,4,90.5\n"))
    assert types_of(df) == {"Date": "timestamp_ntz", "Store": "bigint", "Sales": "double"}
    assert records(df) == [(day("2024-01-01"), 20, 100.0), (day("2024-02-01"), 4, 90.5)]


def test_csv_types_and_missing_cells(spark, write):
    text = (
        'i,big,f,b,t,none,quoted\n1,9223372036854775808,1e3,True,1x,,"a,""b"""\n'
        "NA,2,.5,false,NaN,null,c\n-3,3,inf,NA,x,,d\n"
    )
    df = ts.load_dataset(spark, write(text))
    assert types_of(df) == {
        "i": "bigint", "big": "double", "f": "double", "b": "boolean", "t": "string", "none": "double",
        "quoted": "string",
    }
    assert records(df, "i", "b", "t", "quoted") == [
        (1, True, "1x", 'a,"b"'), (None, False, None, "c"), (-3, None, "x", "d"),
    ]


def test_csv_folder_and_upper_case(spark, tmp_path):
    folder = tmp_path / "many.CSV"
    folder.mkdir()
    for i in range(3):
        (folder / f"{i}.csv").write_text(f"id,d\n{i},0{i + 1}/02/2024\n")
    df = ts.load_dataset(spark, str(folder))
    assert sorted(records(df)) == [(i, dt.datetime(2024, i + 1, 2)) for i in range(3)]


def test_csv_with_line_breaks(spark, write):
    df = ts.load_dataset(spark, write('a,b\n1,"x\ny"\n'), multiline=True)
    assert records(df) == [(1, "x\ny")]


@pytest.mark.parametrize(
    "content, name, code",
    [
        (b"", "empty.csv", "empty_file"),
        (b"not,a,valid\xffcsv", "broken.csv", "unreadable"),
        (b"a,b\n1,\xff\n", "broken.csv", "unreadable"),
        (b"a,b\n1,2,3\n", "long.csv", "unreadable"),
        (b"Store,Sales\n", "header.csv", "no_rows"),
        (b"x", "dataset.txt", "unsupported_file"),
        (b"x", "book.xlsx", "unsupported_file"),
    ],
)
def test_unusable_files(spark, write, content, name, code):
    with pytest.raises(ts.AnalysisError) as error:
        ts.load_dataset(spark, write(content, name))
    assert error.value.code == code


def test_short_rows_are_filled(spark, write):
    assert records(ts.load_dataset(spark, write("a,b\n1\n3,4\n"))) == [(1, None), (3, 4)]


def test_undecodable_bytes_can_be_kept(spark, write):
    assert ts.load_dataset(spark, write(b"a,b\n1,x\xff\n"), check_encoding=False).count() == 1


def test_name_hints():
    assert all(looks_like_date(n) for n in ("date", "Order_Date", "timestamp", "sales_date", "Order-Time"))
    assert not any(looks_like_date(n) for n in ("Store", "Weekly_Sales"))


def detected(spark, cells, name="x"):
    rows = ts.detect_date_columns(spark.createDataFrame([(c,) for c in cells], f"{name} string")).collect()
    return [(r["format"], r["parsed_as"], r["confidence"]) for r in rows]


def test_ambiguous_and_partial_dates(spark):
    assert detected(spark, ["03-04-2024", "05-06-2024"]) == [("auto-detected", "MM-DD-YYYY", 1.0)]
    assert detected(spark, ["13-04-2024", "05-06-2024"]) == [("DD-MM-YYYY", "DD-MM-YYYY", 1.0)]
    mostly = ["2024-01-31"] * 8 + ["soon", "later"]
    assert detected(spark, mostly) == [("YYYY-MM-DD", "YYYY-MM-DD", 0.8)]
    assert detected(spark, mostly, "order_date") == [("YYYY-MM-DD", "YYYY-MM-DD", 0.85)]
    assert detected(spark, mostly[:7] + ["a", "b"]) == []
    assert detected(spark, [None, None]) == []
    assert detected(spark, ["2024-1-5 ", " 2024-01-31", None]) == [("YYYY-MM-DD", "YYYY-MM-DD", 1.0)]
    assert detected(spark, ["2024-02-30", "2024-01-31 10:00"]) == []


def test_cells_that_do_not_fit_become_null(spark):
    df = spark.createDataFrame([(c,) for c in ["2024-01-31"] * 9 + ["soon"]], "d string")
    assert ts.convert_date_columns(df).where("d IS NULL").count() == 1


def test_type_inference(spark):
    df = spark.createDataFrame([("1", "1.5", "true", "x"), ("NA", " 2 ", "False", "1")], "a string, b string, c string, d string")
    assert as_dict(ts.infer_types(df), "column", "type") == {"a": "bigint", "b": "double", "c": "boolean", "d": "string"}


def test_manifest(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Store,Sales\n20,100\n")
    (tmp_path / "b.csv").write_bytes(b"x" * 100_000)
    before = spark.createDataFrame(ts.file_manifest(spark, str(tmp_path)).collect())
    assert as_dict(before, "name", "sha256") == {
        name: hashlib.sha256((tmp_path / name).read_bytes()).hexdigest() for name in ("a.csv", "b.csv")
    }
    (tmp_path / "a.csv").write_text("Store,Sales\n20,200\n")
    (tmp_path / "c.csv").write_text("new")
    changes = ts.changed_files(before, ts.file_manifest(spark, str(tmp_path)))
    assert {r["path"].rsplit("/", 1)[1]: r["change"] for r in changes.collect()} == {"a.csv": "replaced", "c.csv": "added"}


def test_columns_with_odd_names(spark):
    df = spark.createDataFrame([("a", 1.0, "2024-01-31"), ("b", 2.0, "2024-01-30")], ["the.key", "a `value`", "on day"])
    assert as_dict(ts.groupby_analysis(df, "the.key", "a `value`"), "group", "value") == {"a": 1.0, "b": 2.0}
    assert ts.convert_date_columns(df).dtypes[2] == ("on day", "timestamp_ntz")
    assert ts.dataset_info(df).count() == 3
    assert one(ts.statistics(df))["column"] == "a `value`"
    joined = ts.execute_join(df, df, "the.key", "the.key")
    assert joined.columns == ["the.key", "a `value`_x", "on day_x", "a `value`_y", "on day_y"]
