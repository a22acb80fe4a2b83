"""Date text formats and tolerant parsing."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabscope.functions.columns import WHITESPACE


class DateFormat(NamedTuple):
    label: str
    pattern: str
    shape: str


_Y, _M, _D = r"\d{4}", "(0?[1-9]|1[0-2])", "(0?[1-9]|[12][0-9]|3[01])"

# Accepted formats in order of preference: fixed values. ``shape`` holds the
# digits a cell must have, so that the parser is only called on likely dates.
DATE_FORMATS = (
    DateFormat("YYYY-MM-DD", "yyyy-M-d", f"^{_Y}-{_M}-{_D}$"),
    DateFormat("YYYY/MM/DD", "yyyy/M/d", f"^{_Y}/{_M}/{_D}$"),
    DateFormat("MM-DD-YYYY", "M-d-yyyy", f"^{_M}-{_D}-{_Y}$"),
    DateFormat("MM/DD/YYYY", "M/d/yyyy", f"^{_M}/{_D}/{_Y}$"),
    DateFormat("DD-MM-YYYY", "d-M-yyyy", f"^{_D}-{_M}-{_Y}$"),
    DateFormat("DD/MM/YYYY", "d/M/yyyy", f"^{_D}/{_M}/{_Y}$"),
    DateFormat("YYYY-DD-MM", "yyyy-d-M", f"^{_Y}-{_D}-{_M}$"),
    DateFormat("YYYY/DD/MM", "yyyy/d/M", f"^{_Y}/{_D}/{_M}$"),
)
DATE_SHAPE = r"^(\d{4}[-/]\d{1,2}[-/]\d{1,2}|\d{1,2}[-/]\d{1,2}[-/]\d{4})$"
AUTO_DETECTED = "auto-detected"
MIN_RATIO = 0.80
TIE = 0.001
NAME_BONUS = 0.05


def parse_date(text: Column, fmt: DateFormat) -> Column:
    """The date a cell denotes in one format, NULL when it does not fit."""
    trimmed = F.btrim(text, F.lit(WHITESPACE))
    return F.when(trimmed.rlike(fmt.shape), F.try_to_date(trimmed, fmt.pattern))


def choose_format(hits: Column, n: Column) -> Column:
    """Struct ``(at, ratio, tied)`` of the best format from the cells per format.

    Two formats within a small tolerance are tied when the preferred one does
    not fit worse.
    """
    ranked = F.array_sort(F.transform(hits, lambda h, i: F.struct((-h / n).alias("score"), i.alias("at"))))
    best, second = ranked[0], ranked[1]
    tied = (
        (second["score"] < 0)
        & (F.abs(best["score"] - second["score"]) < TIE)
        & (best["at"] < second["at"])
    )
    return F.struct(best["at"].alias("at"), (-best["score"]).alias("ratio"), tied.alias("tied"))
