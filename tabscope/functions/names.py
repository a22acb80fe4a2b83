"""What column names suggest: similarity, dates and identifiers."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscope.functions.arithmetic import rounded

# Names and name parts that suggest a date: fixed values.
DATE_NAMES = (
    "date", "datetime", "timestamp", "time", "day",
    "order_date", "orderdate", "sale_date", "saledate",
    "sales_date", "transaction_date", "transactiondate",
    "purchase_date", "purchasedate",
)
DATE_NAME_PARTS = (
    "date", "datetime", "timestamp",
    "order_time", "sale_time", "purchase_time", "transaction_time",
)

# Name parts that suggest an identifier: fixed values. The listed compound
# words can only match through these parts, since separators are removed first.
IDENTIFIER_PARTS = ("id", "identifier", "code", "key", "uuid", "guid", "ssn", "account", "pk", "fk")

# Affixes ignored when two names are compared: fixed values.
KEY_PREFIX = "^id"
KEY_SUFFIX = "(id|num|code|key)$"


def looks_like_date(name: str) -> bool:
    unified = re.sub(r"[-/ ]", "_", name.strip().lower())
    return unified in DATE_NAMES or any(part in unified for part in DATE_NAME_PARTS)


def looks_like_identifier(name: str) -> bool:
    compact = re.sub(r"[-_ ]", "", name.lower())
    return any(part in compact for part in IDENTIFIER_PARTS)


def normalized_name(name: Column) -> Column:
    """Letters and digits only, without one leading ``id`` and one trailing key word."""
    plain = F.regexp_replace(F.lower(name), "[^a-zA-Z0-9]", "")
    return F.regexp_replace(F.regexp_replace(plain, KEY_PREFIX, ""), KEY_SUFFIX, "")


def _bigrams(text: Column) -> Column:
    pairs = F.transform(F.sequence(F.lit(1), F.length(text) - 1), lambda i: F.substring(text, i, F.lit(2)))
    return F.when(F.length(text) >= 2, F.array_distinct(pairs)).otherwise(F.array(text))


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def name_similarity(left: Column, right: Column) -> Column:
    """Similarity of two names between 0 and 1, 3 decimals.

    1.0 equal, 0.95 equal after normalisation, 0.75 one normalised name inside
    the other (shorter at least 3 characters), else the Jaccard index of the
    character bigrams of the lower-cased names.
    """
    a, b = F.trim(F.lower(left)), F.trim(F.lower(right))
    names = F.struct(a.alias("a"), b.alias("b"), normalized_name(a).alias("na"), normalized_name(b).alias("nb"))

    def of_sets(s: Column) -> Column:
        shared = F.size(F.array_intersect(s["a"], s["b"]))
        return rounded(shared / (F.size(s["a"]) + F.size(s["b"]) - shared), 3)

    def of_names(s: Column) -> Column:
        na, nb = s["na"], s["nb"]
        return (
            F.when(s["a"] == s["b"], 1.0)
            .when((na != "") & (na == nb), 0.95)
            .when((F.least(F.length(na), F.length(nb)) >= 3) & (F.contains(na, nb) | F.contains(nb, na)), 0.75)
            .otherwise(_with(F.struct(_bigrams(s["a"]).alias("a"), _bigrams(s["b"]).alias("b")), of_sets))
        )

    return _with(names, of_names)


def _marked(kind: Column):
    return lambda token: F.struct(kind.alias("kind"), token.alias("token"))


def similar_names(columns: DataFrame, least: float) -> DataFrame:
    """Pairs of columns of one family in different tables with similar names: ``left_number, right_number``.

    ``columns`` holds ``number, dataset, family, name``; the pairs hold all those with a similarity of ``least`` (0 to 0.75) or
    more and some below. Names meet in an inverted index, where they have in common one of the rarest bigrams that so
    similar sets must share, or the normalised name, or a rarest trigram of the normalised name that the other contains.
    """
    name = F.trim(F.lower(F.col("name")))
    base = columns.select("number", "dataset", "family", _bigrams(name).alias("bigrams"), normalized_name(name).alias("plain"))
    # Similarities are rounded to 3 decimals before they are compared.
    spare = F.size("bigrams") - F.ceil(max(least - 0.0005, 0.0) * F.size("bigrams")).cast("int") + 1
    threes = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("plain") - 2), lambda i: F.substring("plain", i, F.lit(3))))
    none = F.array().cast("array<string>")
    kinds = {
        "2": F.col("bigrams"),
        "=": F.when(F.col("plain") != "", F.array("plain")).otherwise(none),
        "3": F.when(F.length("plain") >= 3, threes).otherwise(none),
    }
    listed = F.concat(*[F.transform(tokens, _marked(F.lit(kind))) for kind, tokens in kinds.items()])
    index = (
        base.select("number", "dataset", "family", spare.alias("spare"), F.inline(listed))
        .withColumn("n", F.count("*").over(Window.partitionBy("family", "kind", "token")))
        .withColumn("place", F.row_number().over(Window.partitionBy("number", "kind").orderBy("n", "token")))
        .where("kind != '2' OR place <= spare")
    )
    token = ["family", "kind", "token"]
    one = index.where("kind != '3' OR place = 1").select(*token, F.col("number").alias("x"), F.col("dataset").alias("xd"))
    two = index.select(*token, F.col("number").alias("y"), F.col("dataset").alias("yd"))
    met = one.join(two, token).where("xd != yd")
    return met.select(F.least("x", "y").alias("left_number"), F.greatest("x", "y").alias("right_number")).distinct()
