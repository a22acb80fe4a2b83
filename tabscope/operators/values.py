"""Values of many columns in comparable forms: sketches that prove columns disjoint, and the sets of columns each value occurs in."""

from __future__ import annotations

from collections.abc import Collection, Iterable, Iterator, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscope.functions.columns import (
    WHITESPACE,
    family_of,
    is_float,
    is_integer,
    type_of,
)

FAMILIES = ("numeric", "datetime", "text", "other")

# Columns per bit mask, and masks that are kept next to each other.
_BITS = 62
_WORDS = 4

# Longer texts are compared by the SHA-256 of the whole text.
_LONG_TEXT = 256

# 64-bit words of a column's bitmap of hashed values, leading bytes of the bounds of
# texts, and columns of numbers whose bounds one aggregate finds.
_HASH_WORDS = 16
_PREFIX = 7
_CHUNK = 8


class NumberedColumn(NamedTuple):
    number: int
    dataset: str
    name: str
    family: str


def comparable_family(data_type: T.DataType) -> str:
    """Columns are comparable within a family; booleans count as numeric."""
    family = family_of(data_type)
    return "numeric" if family == "boolean" else family


def catalog_of(datasets: Mapping[str, DataFrame]) -> list[NumberedColumn]:
    fields = [(name, f) for name, df in datasets.items() for f in df.schema.fields]
    return [NumberedColumn(i, name, f.name, comparable_family(f.dataType)) for i, (name, f) in enumerate(fields)]


_KINDS = {"i": "bigint", "d": "double", "s": "timestamp_ntz", "t": "string"}


def _forms(df: DataFrame, name: str, family: str) -> dict[str, str]:
    """One form for equal values of a family, whatever their types are: an integer, a double, a time or text.

    Holds SQL for the forms that the type has; at most one of them is not null. Integral numbers of any type
    are integers and other numbers doubles where these are exact; dates and times have no time zone. As text, a value
    keeps its surrounding spaces. (One string for a form: columns by the thousand make no calls by the ten thousand.)
    """
    data_type = type_of(df, name)
    v = _present(df, name)
    if family == "text" and family_of(data_type) != "text":
        v = f"CAST({v} AS TIMESTAMP_NTZ)" if family_of(data_type) == "datetime" else v
        return {"t": f"CAST({v} AS STRING)"}
    if is_integer(data_type):
        return {"i": f"CAST({v} AS BIGINT)"}
    if is_float(data_type):
        # A float means the shortest text that stands for it.
        v = f"CAST(CAST({v} AS STRING) AS DOUBLE)" if isinstance(data_type, T.FloatType) else v
        whole = f"({v} = rint({v}) AND abs({v}) < 9223372036854775808D)"
        return {"i": f"IF({whole}, CAST({v} AS BIGINT), NULL)", "d": f"IF({whole}, NULL, {v})"}
    if isinstance(data_type, T.DecimalType):
        double, digits = f"CAST({v} AS DOUBLE)", f"CAST({v} AS STRING)"
        whole = f"({v} % 1 = 0 AND abs({double}) < 4611686018427387904D)"
        exact = f"coalesce(try_cast({double} AS {data_type.simpleString()}) = {v}, false)"
        plain = f"IF(contains({digits}, '.'), regexp_replace({digits}, '[.]?0+$', ''), {digits})"
        return {"i": f"IF({whole}, CAST({v} AS BIGINT), NULL)", "d": f"IF(NOT {whole} AND {exact}, {double}, NULL)", "t": f"IF(NOT {whole} AND NOT {exact}, {plain}, NULL)"}
    if family == "datetime":
        return {"s": f"CAST({v} AS TIMESTAMP_NTZ)"}
    return {"t": f"CAST({v} AS STRING)"}


def _present(df: DataFrame, name: str) -> str:
    quoted = "`" + name.replace("`", "``") + "`"
    return f"IF(isnan({quoted}), NULL, {quoted})" if is_float(type_of(df, name)) else quoted


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


# --- sketches -----------------------------------------------------------------


class Sketch(NamedTuple):
    """What one pass tells about a column: counts, whether there are two values, bounds of each form, and hashed values."""

    rows: int
    filled: int
    padded: int
    varied: bool
    bounds: dict[str, tuple]
    hashes: tuple

    @property
    def surely_repeats(self) -> bool:
        """More values than integers between the bounds, or more than one gap."""
        low, high = self.bounds.get("i", (0, -1))
        return self.rows - self.filled > 1 or (set(self.bounds) == {"i"} and self.filled > high - low + 1)


def _rows_of(found: Iterable[DataFrame]) -> list:
    found = list(found)
    return reduce(DataFrame.unionAll, found).collect() if found else []


def _bounds(df: DataFrame, c: NumberedColumn) -> str:
    """Of a column of numbers or times: how many there are, whether they differ, and the bounds of each form."""
    v, forms = _present(df, c.name), _forms(df, c.name, c.family)
    fields = [f"'number', {c.number}", f"'filled', count({v})", f"'varied', coalesce(min({v}) < max({v}), false)", f"'texts', {f'count({forms['t']})' if 't' in forms else '0L'}"]
    for f, kind in (("i", "BIGINT"), ("d", "DOUBLE"), ("s", "BIGINT")):
        for side, how in (("low", "min"), ("high", "max")):
            end = f"{how}({forms[f]})" if f in forms else "NULL"
            end = f"unix_date(CAST({end} AS DATE))" if f == "s" and f in forms else end
            fields.append(f"'{side}_{f}', CAST({end} AS {kind})")
    return f"named_struct({', '.join(fields)})"


def _of_numbers(datasets: Mapping[str, DataFrame], some: Sequence[NumberedColumn], rows: Mapping[str, int]) -> dict[int, Sketch]:
    """Sketches of columns of numbers and times. Their values are not hashed: between the same bounds, most of them are the same."""
    wide, tables = [], {c.number: c.dataset for c in some}
    for name, df in datasets.items():
        mine = [c for c in some if c.dataset == name]
        for k in range(0, len(mine), _CHUNK):
            row = df.agg(*[F.expr(f"{_bounds(df, c)} AS s{n}") for n, c in enumerate(mine[k : k + _CHUNK])])
            wide.append(row.selectExpr(f"inline(array({', '.join(row.columns)}))"))
    found = {}
    for r in _rows_of(wide):
        bounds = {f: (r[f"low_{f}"], r[f"high_{f}"]) for f in "ids" if r[f"low_{f}"] is not None}
        if r.texts:  # decimals that no double stands for
            bounds["t"] = (0, 2**63 - 1)
        found[r.number] = Sketch(rows[tables[r.number]], r.filled, 0, r.varied, bounds, (-1,) * _HASH_WORDS)
    return found


def _of_texts(datasets: Mapping[str, DataFrame], some: Sequence[NumberedColumn], rows: Mapping[str, int]) -> dict[int, Sketch]:
    """Sketches of columns of texts, with a bitmap of their hashed values and the first bytes as bounds."""
    if not some:
        return {}
    text = F.when(F.col("family") == FAMILIES.index("text"), trimmed(F.col("value"))).otherwise(F.col("value"))
    # A whole number in the same order as the first bytes.
    lead = F.conv(F.rpad(F.hex(F.substring(text.cast("binary"), 1, _PREFIX)), 2 * _PREFIX, "0"), 16, 10).cast("bigint")
    used = {name: df for name, df in datasets.items() if any(c.dataset == name for c in some)}
    cells = cells_of(used, some).select("number", lead.alias("lead"), F.xxhash64("value").alias("own"), (text != F.col("value")).alias("padded"), F.xxhash64(_key(text)).alias("hash"))
    cells = cells.withColumns({"word": F.expr(f"shiftrightunsigned(hash, 6) & {_HASH_WORDS - 1}"), "bit": F.expr("shiftleft(1L, CAST(hash & 63 AS INT))")})
    masks = [F.expr(f"bit_or(IF(word = {k}, bit, 0L)) AS hash{k}") for k in range(_HASH_WORDS)]
    ends = [F.min("lead").alias("low"), F.max("lead").alias("high"), (F.min("own") < F.max("own")).alias("varied")]
    seen = {r.number: r for r in cells.groupBy("number").agg(F.count(F.lit(1)).alias("filled"), F.count_if("padded").alias("padded"), *ends, *masks).collect()}
    none = (0,) * _HASH_WORDS
    return {
        c.number: Sketch(rows[c.dataset], r.filled, r.padded, r.varied, {"t": (r.low, r.high)}, tuple(r[f"hash{k}"] for k in range(_HASH_WORDS)))
        if (r := seen.get(c.number)) else Sketch(rows[c.dataset], 0, 0, False, {}, none)
        for c in some
    }


def sketches(datasets: Mapping[str, DataFrame], catalog: Sequence[NumberedColumn]) -> dict[int, Sketch]:
    """A sketch for each column; every task combines what it reads, and a row per column reaches the driver."""
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("dataset"), "n") for name, df in datasets.items()]
    rows = {r.dataset: r.n for r in _rows_of(counts)}
    numbers = [c for c in catalog if set(_forms(datasets[c.dataset], c.name, c.family)) != {"t"}]
    others = [c for c in catalog if c not in numbers]
    return _of_numbers(datasets, numbers, rows) | _of_texts(datasets, others, rows)


def _meeting(mine: Sequence[NumberedColumn], found: Mapping[int, Sketch], target: str | None) -> Iterator[tuple[int, np.ndarray]]:
    """For each column, those of other tables whose bounds meet its own, as places in the list."""
    tables = np.array([c.dataset for c in mine])
    wanted = np.array([target in (None, c.dataset) for c in mine])
    bounds = []
    for f in _KINDS:
        ends = [found[c.number].bounds.get(f) for c in mine]
        kind = np.float64 if f == "d" else np.int64
        bounds.append((np.array([e is not None for e in ends], bool), *(np.array([e[side] if e else 0 for e in ends], kind) for side in (0, 1))))
    for k, c in enumerate(mine):
        meets = np.zeros(len(mine), bool)
        for have, low, high in bounds:
            if have[k]:
                meets |= have & (low <= high[k]) & (high >= low[k])
        yield k, np.flatnonzero(meets & (tables != c.dataset) & (wanted | wanted[k]))


def with_partners(catalog: Sequence[NumberedColumn], found: Mapping[int, Sketch], target: str | None = None) -> set[int]:
    """Numbers of the columns that may share a value with a column of their family in another table.

    All others provably share none: no bounds meet, or no hash of a value is on both sides.
    """
    out = set()
    for family in FAMILIES:
        mine = [c for c in catalog if c.family == family and found[c.number].filled]
        hashes = np.array([found[c.number].hashes for c in mine], np.int64).reshape(-1, _HASH_WORDS)
        for k, others in _meeting(mine, found, target):
            hit = others[(hashes[others] & hashes[k]).any(1)]
            if len(hit):
                out |= {mine[k].number, *(mine[x].number for x in hit.tolist())}
    return out


# --- values in common ------------------------------------------------------------


def _key(text: Column) -> Column:
    return F.when(F.length(text) > _LONG_TEXT, F.concat(F.lit("#"), F.sha2(text.cast("binary"), 256))).otherwise(F.concat(F.lit("="), text))


def cells_of(datasets: Mapping[str, DataFrame], catalog: Sequence[NumberedColumn], form: str = "t") -> DataFrame | None:
    """``number, family, value``: every value of the columns that has this form; a text keeps its surrounding spaces."""
    parts = []
    for name, df in datasets.items():
        mine = [(c, forms[form]) for c in catalog if c.dataset == name and form in (forms := _forms(df, c.name, c.family))]
        if not mine:
            continue
        cells = ", ".join(f"{c.number}, {FAMILIES.index(c.family)}, v{c.number}" for c, _ in mine)
        parts.append(df.selectExpr(*[f"{x} AS v{c.number}" for c, x in mine]).selectExpr(f"stack({len(mine)}, {cells}) AS (number, family, value)"))
    return reduce(DataFrame.unionAll, parts).where("value IS NOT NULL") if parts else None


def _sets(cells: DataFrame, form: str, count: int) -> DataFrame:
    """``sets``: for every distinct value, bit masks of the columns it occurs in, and of those where it has no spaces around it."""
    bit = F.expr(f"shiftleft(1L, number % {_BITS})")
    none = F.lit(0).cast("bigint")
    masks = {"any": bit, "plain": bit}
    if form == "t":
        text = F.when(F.col("family") == FAMILIES.index("text"), trimmed(F.col("value"))).otherwise(F.col("value"))
        cells = cells.select("number", "family", _key(text).alias("value"), (text == F.col("value")).alias("is_plain"))
        masks = {"any": F.when(F.col("value") != "=", bit).otherwise(none), "plain": F.when(F.col("is_plain"), bit).otherwise(none)}
    words = -(-count // _BITS)
    if words <= _WORDS:
        names, aggregates = [], []
        for w in range(words):
            here = F.floor(F.col("number") / _BITS) == w
            names.append(F.struct(F.lit(w).cast("bigint").alias("word"), F.col(f"any{w}").alias("any"), F.col(f"plain{w}").alias("plain")))
            aggregates += [F.bit_or(F.when(here, m).otherwise(none) if words > 1 else m).alias(f"{k}{w}") for k, m in masks.items()]
        return cells.groupBy("family", "value").agg(*aggregates).select(F.array(*names).alias("sets"))
    parts = cells.groupBy("family", "value", F.floor(F.col("number") / _BITS).alias("word")).agg(*[F.bit_or(m).alias(k) for k, m in masks.items()])
    return parts.groupBy("family", "value").agg(F.array_sort(F.collect_list(F.struct("word", "any", "plain"))).alias("sets"))


def _whole_sets(cells: DataFrame) -> DataFrame:
    """``members, n``: how many integers occur in exactly these columns.

    A value sets one of the 64 bits of its block. Bits of a column are combined before the shuffle, so dense ids move a
    word for 64 of them; the columns of a block then cut its bits into those that lie in equal columns.
    """
    bit = F.expr("shiftleft(1L, CAST(value & 63 AS INT))")
    bits = cells.groupBy("family", F.expr("shiftright(value, 6)").alias("block"), "number").agg(F.bit_or(bit).alias("bits"))
    held = bits.groupBy("family", "block").agg(F.array_sort(F.collect_list(F.struct("number", "bits"))).alias("held"))
    cut = "array(struct(p.at & x.bits AS at, concat(p.members, array(x.number)) AS members), struct(p.at & ~x.bits AS at, p.members AS members))"
    parts = f"aggregate(held, array(struct(-1L AS at, CAST(array() AS ARRAY<INT>) AS members)), (parts, x) -> filter(flatten(transform(parts, p -> {cut})), p -> p.at <> 0))"
    found = held.select(F.explode(F.expr(parts)).alias("part")).select("part.members", F.bit_count("part.at").alias("n"))
    return found.where(F.size("members") > 0).groupBy("members").agg(F.sum("n").alias("n"))


def signatures(datasets: Mapping[str, DataFrame], catalog: Sequence[NumberedColumn]) -> DataFrame:
    """``members, plain, n``: how many values occur in exactly these columns, numbered from 0 without gaps.

    Every distinct value is reduced to the set of columns it occurs in, bit masks that are combined before the shuffle;
    equal sets are then counted. The number of different sets depends on the schemas, not on the data. ``plain`` are the
    columns holding the value without surrounding spaces. Texts of nothing but spaces have no members. The forms of
    values are grouped apart, each with a key of its own type, integers as bits.
    """
    cells = {form: c for form in _KINDS if (c := cells_of(datasets, catalog, form)) is not None}

    def numbers(which: str) -> Column:
        places = f"filter(sequence(0, {_BITS - 1}), b -> (w.{which} & shiftleft(1L, b)) <> 0)"
        return F.expr(f"flatten(transform(sets, w -> transform({places}, b -> CAST(w.word * {_BITS} + b AS INT))))")

    found = []
    if "i" in cells:
        found.append(_whole_sets(cells.pop("i")).select("members", F.col("members").alias("plain"), "n"))
    if cells:
        sets = reduce(DataFrame.unionAll, [_sets(c, form, len(catalog)) for form, c in cells.items()])
        found.append(sets.groupBy("sets").agg(F.count("*").alias("n")).select(numbers("any").alias("members"), numbers("plain").alias("plain"), "n"))
    return reduce(DataFrame.unionAll, found).groupBy("members", "plain").agg(F.sum("n").alias("n"))


def shared_counts(sets: DataFrame) -> DataFrame:
    """``a, b, n``: values that columns ``a`` <= ``b`` have in common; the column's own values where both are equal."""
    first = sets.select(F.explode("members").alias("a"), "members", "n")
    return first.select("a", F.explode(F.expr("filter(members, m -> m >= a)")).alias("b"), "n").groupBy("a", "b").agg(F.sum("n").alias("n"))


def plain_counts(sets: DataFrame) -> DataFrame:
    """``number, n``: distinct values of a column that have no spaces around them."""
    return sets.select(F.explode("plain").alias("number"), "n").groupBy("number").agg(F.sum("n").alias("n"))


def padded_counts(datasets: Mapping[str, DataFrame], catalog: Sequence[NumberedColumn], padded: Collection[int]) -> DataFrame | None:
    """``number, n``: distinct texts of a column that have spaces around them; None where no column has any."""
    some = [c for c in catalog if c.number in padded]
    if not some:
        return None
    cells = cells_of({name: df for name, df in datasets.items() if any(c.dataset == name for c in some)}, some)
    return cells.where(F.col("value") != trimmed(F.col("value"))).select("number", _key(F.col("value")).alias("key")).distinct().groupBy("number").agg(F.count("*").alias("n"))
