"""Schema inspection, request checks and null-normalised column access.

Everything here reads ``df.schema`` only and never starts a Spark job.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscope.errors import AnalysisError

_FLOATS = (T.FloatType, T.DoubleType)
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DATETIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)

# Characters removed by strip() on text: fixed values.
WHITESPACE = " \t\n\r\x0b\x0c"


def col(name: str) -> Column:
    """A column by its exact name, also when the name contains dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def family_of(data_type: T.DataType) -> str:
    """The semantic family of a type: numeric, boolean, datetime, text or other."""
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    if isinstance(data_type, _INTEGERS + _FLOATS + (T.DecimalType,)):
        return "numeric"
    if isinstance(data_type, _DATETIMES):
        return "datetime"
    if isinstance(data_type, (T.StringType, T.CharType, T.VarcharType)):
        return "text"
    return "other"


def join_family_of(data_type: T.DataType) -> str:
    """Families within which two join keys may be compared."""
    if isinstance(data_type, _INTEGERS):
        return "integer"
    if isinstance(data_type, _FLOATS):
        return "float"
    if isinstance(data_type, T.DecimalType):
        return "decimal"
    return family_of(data_type)


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_numeric(df: DataFrame, name: str) -> bool:
    """Numeric for a named column's check: booleans count as 0 and 1."""
    return family_of(type_of(df, name)) in ("numeric", "boolean")


def is_datetime(df: DataFrame, name: str) -> bool:
    return family_of(type_of(df, name)) == "datetime"


def is_float(data_type: T.DataType) -> bool:
    return isinstance(data_type, _FLOATS)


def is_integer(data_type: T.DataType) -> bool:
    return isinstance(data_type, _INTEGERS)


def numeric_columns(df: DataFrame) -> list[str]:
    """All numeric columns, without booleans."""
    return [f.name for f in df.schema.fields if family_of(f.dataType) == "numeric"]


def non_numeric_columns(df: DataFrame) -> list[str]:
    """The columns left out when all numeric columns are analysed."""
    return [f.name for f in df.schema.fields if family_of(f.dataType) != "numeric"]


def select_numeric(df: DataFrame) -> DataFrame:
    """Only the numeric columns of a table."""
    return df.select(*[col(c) for c in numeric_columns(df)])


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into NULL; other types are unchanged."""
    c = col(name)
    return F.when(~F.isnan(c), c) if is_float(type_of(df, name)) else c


def number(df: DataFrame, name: str) -> Column:
    """The column as a double, NaN as NULL, booleans as 0 and 1."""
    if family_of(type_of(df, name)) == "boolean":
        return col(name).cast("int").cast("double")
    return present(df, name).cast("double")


def drop_missing(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Rows in which every named column holds a value (neither NULL nor NaN)."""
    names = list(dict.fromkeys(names))
    for name in names:
        df = df.where(col(name).isNotNull())
        if is_float(type_of(df, name)):
            df = df.where(~F.isnan(col(name)))
    return df


def rows_from_wide(wide: DataFrame, rows: Sequence[Column]) -> DataFrame:
    """Turn a one-row frame into one row per struct in ``rows``."""
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def stacked(df: DataFrame, cells: Sequence[Column], value: str = "value") -> DataFrame:
    """``position, value`` rows: the given columns of one type below each other."""
    wide = df.select(*[c.alias(f"c{i}") for i, c in enumerate(cells)])
    parts = [x for i in range(len(cells)) for x in (F.lit(i), F.col(f"c{i}"))]
    rows = wide.select(F.stack(F.lit(len(cells)), *parts).alias("position", value))
    # Never NULL, but stated: a join on the position then adds no filter of its
    # own, and branches of one plan stay equal and are computed once.
    return rows.where("position IS NOT NULL")


def long_numbers(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``position, value`` rows, value as double, for the named numeric columns."""
    return stacked(df, [number(df, c) for c in names])


def name_at(names: Sequence[str], position: str = "position") -> Column:
    """The name a position of ``stacked`` stands for."""
    return F.element_at(F.array(*[F.lit(c) for c in names]), F.col(position) + 1)


def require_frame(df: DataFrame | None) -> None:
    if df is None:
        raise AnalysisError("no_dataset", "A table is needed first.")


def require_column(df: DataFrame, name: str, where: str = "the dataset") -> None:
    if name not in df.columns:
        raise AnalysisError("unknown_column", f"There is no '{name}' in {where}.", df.columns)


def require_numeric(df: DataFrame, name: str, why: str) -> None:
    if not is_numeric(df, name):
        raise AnalysisError("not_numeric", f"'{name}' holds no numbers: {why}.", numeric_columns(df))


def require_datetime(df: DataFrame, name: str) -> None:
    if not is_datetime(df, name):
        dates = [f.name for f in df.schema.fields if family_of(f.dataType) == "datetime"]
        raise AnalysisError("not_a_date", f"'{name}' holds no dates.", dates)


def require_choice(what: str, value: str, allowed: Iterable[str]) -> None:
    allowed = sorted(allowed)
    if value not in allowed:
        raise AnalysisError("unsupported", f"{what}: '{value}' is none of the choices.", allowed)


def require_rows(df: DataFrame, message: str) -> None:
    """The strict check: one ``isEmpty`` job that raises when no row is left."""
    if df.isEmpty():
        raise AnalysisError("no_rows", message)
