"""CSV files to typed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tabscope.errors import AnalysisError
from tabscope.functions.cells import READINGS, cell_facts, narrowest_type, without_na
from tabscope.functions.columns import col, name_at
from tabscope.functions.dates import DATE_FORMATS, MIN_RATIO, choose_format
from tabscope.sources.dates import as_timestamp

_REPLACEMENT = "\ufffd"
_CORRUPT = "_corrupt_record"


def infer_types(df: DataFrame) -> DataFrame:
    """The narrowest type of every text column: ``column, type``, from one scan.

    bigint, double or boolean when every non-missing cell reads as such, double
    when there is no cell at all, else string. Missing cells do not widen a type.
    """
    facts = cell_facts(df, [without_na(col(c)) for c in df.columns])
    return facts.select(name_at(df.columns).alias("column"), narrowest_type().alias("type"))


def apply_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """The text table with every column read as its type; missing tokens become NULL."""
    typed = []
    for name in df.columns:
        text = without_na(col(name))
        read = READINGS.get(types.get(name, "string"))
        typed.append((read(text) if read else text).alias(name))
    return df.select(*typed)


def load_dataset(spark: SparkSession, path: str, multiline: bool = False, check_encoding: bool = True) -> DataFrame:
    """Read a CSV file (or a folder of them whose path ends in .csv) as a typed table.

    The cells are read as text; one aggregate then decides the type of every
    column and which text columns hold dates, and the typed columns are lazy
    expressions over the text. Raises ``AnalysisError`` for other file types,
    files without columns or data rows, rows with more cells than the header
    and undecodable bytes (``check_encoding=False`` keeps those as they are).
    ``multiline`` allows line breaks inside quotes, at the price that a file is
    no longer split between tasks.
    """
    if not path.lower().rstrip("/").endswith(".csv"):
        raise AnalysisError("unsupported_file", "Only CSV files are read.", [".csv"])
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)
    names = reader.csv(path).columns
    if not names:
        raise AnalysisError("empty_file", "The file has no header.")
    if check_encoding and any(_REPLACEMENT in n for n in names) and _has_bad_bytes(spark, path):
        raise AnalysisError("unreadable", "The file is no valid CSV in UTF-8.")
    schema = ", ".join("`" + n.replace("`", "``") + "` string" for n in [*names, _CORRUPT])
    raw = reader.option("columnNameOfCorruptRecord", _CORRUPT).schema(schema).csv(path)

    whole = Observation()
    observed = raw.observe(
        whole,
        # A malformed row whose last column is filled has cells beyond the header.
        F.count_if(col(_CORRUPT).isNotNull() & col(names[-1]).isNotNull()).alias("too_long"),
        F.count_if(F.concat_ws("", *[col(c) for c in names]).contains(_REPLACEMENT)).alias("undecodable"),
    )
    facts = (
        cell_facts(observed, [without_na(col(c)) for c in names])
        .withColumn("choice", choose_format(F.col("hits"), F.nullif("n", F.lit(0))))
        .select("position", narrowest_type().alias("type"), "choice.at", "choice.ratio")
        .collect()
    )
    if not facts:
        raise AnalysisError("no_rows", "The file has a header, but no rows.")
    if whole.get["too_long"] or (check_encoding and whole.get["undecodable"] and _has_bad_bytes(spark, path)):
        raise AnalysisError("unreadable", "The file is no valid CSV in UTF-8.")
    typed = {}
    for fact in facts:
        name = names[fact["position"]]
        text, kind = without_na(col(name)), fact["type"]
        if kind == "string":
            is_date = fact["ratio"] is not None and fact["ratio"] >= MIN_RATIO
            typed[name] = as_timestamp(text, DATE_FORMATS[fact["at"]]) if is_date else text
        else:
            typed[name] = READINGS[kind](text)
    return raw.select(*[typed[name].alias(name) for name in names])


def _has_bad_bytes(spark: SparkSession, path: str) -> bool:
    """Whether a line isn't UTF-8. The replacement character in a decoded text may also stand in the file as such."""
    return not spark.read.text(path).where(~F.is_valid_utf8("value")).isEmpty()


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """The first rows of a table."""
    return df.limit(rows)


def shape(df: DataFrame) -> DataFrame:
    """``num_rows, num_columns`` of a table, in one row."""
    return df.agg(F.count(F.lit(1)).alias("num_rows"), F.lit(len(df.columns)).alias("num_columns"))


def column_types(df: DataFrame) -> DataFrame:
    """``position, column, type`` of a table, from its schema."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")
