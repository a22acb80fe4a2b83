"""SQL over the same tables for the queries that SQL can express."""

from __future__ import annotations

_GAPS = """gaps AS (
  SELECT o_orderkey, o_custkey, o_orderdate,
         CASE WHEN o_orderstatus = 'P' OR o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END AS price,
         o_totalprice > 250000 AS is_large,
         CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_orderpriority END AS priority,
         7 AS constant
  FROM orders)"""

_CENTS = "(SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)"

_TEXT = """texts AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS key,
         CASE WHEN o_orderstatus = 'P' THEN 'NA' ELSE CAST(o_custkey AS VARCHAR) END AS customer,
         printf('%.2f', o_totalprice) AS price,
         CASE WHEN o_totalprice > 250000 THEN 'True' ELSE 'False' END AS large,
         strftime(o_orderdate, '%Y-%m-%d') AS iso_date,
         strftime(o_orderdate, '%-m/%-d/%Y') AS us_date,
         strftime(o_orderdate, '%d-%m-%Y') AS day_first,
         CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE strftime(o_orderdate, '%Y/%m/%d') END AS partly,
         strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS ordered,
         o_orderpriority AS priority,
         '' AS nothing
  FROM orders)"""

_SQL_AGGREGATES = {
    "mean": "avg({v})",
    "sum": "CAST(coalesce(sum({v}), 0) AS DOUBLE)",
    "count": "CAST(count({v}) AS DOUBLE)",
    "min": "min({v})",
    "max": "max({v})",
    "median": "(quantile_disc({v}, 0.5) - quantile_disc(-{v}, 0.5)) / 2",
    "std": "stddev_samp({v})",
}

_LABELS = {
    "day": "strftime({b}, '%Y-%m-%d')",
    "week": "'Week of ' || strftime({b}, '%Y-%m-%d')",
    "month": "strftime({b}, '%Y-%m')",
    "quarter": "CAST(year({b}) AS VARCHAR) || '-Q' || CAST(quarter({b}) AS VARCHAR)",
    "year": "strftime({b}, '%Y')",
}


def _groupby(key: str, value: str, agg: str, source: str, where: str = "TRUE", tail: str = "") -> str:
    how = _SQL_AGGREGATES[agg].format(v=value)
    return (
        f'SELECT {key} AS "group", round({how}, 2) AS value FROM {source} '
        f"WHERE {key} IS NOT NULL AND ({where}) GROUP BY {key} {tail}"
    )


def _bucket(column: str, period: str) -> str:
    return f"CAST(date_trunc('{period}', {column}) AS TIMESTAMP)"


def _series(
    date: str, value: str, period: str, agg: str, source: str, where: str = "TRUE", by: str | None = None
) -> str:
    """Unrounded aggregate per period: b, value (and g)."""
    how = _SQL_AGGREGATES[agg].format(v=value)
    extra, group = (f", {by} AS g", ", g") if by else ("", "")
    keep = f"AND {by} IS NOT NULL" if by else ""
    return (
        f"SELECT {_bucket(date, period)} AS b{extra}, {how} AS value FROM {source} "
        f"WHERE {date} IS NOT NULL AND {value} IS NOT NULL {keep} AND ({where}) GROUP BY b{group}"
    )


def _labelled(series: str, period: str, by: bool = False) -> str:
    group = ', g AS "group"' if by else ""
    return (
        f"SELECT b AS period_start, {_LABELS[period].format(b='b')} AS period{group}, round(value, 2) AS value "
        f"FROM ({series})"
    )


def _changes(series: str, period: str) -> str:
    label = _LABELS[period]
    return f"""
  SELECT b, {label.format(b='pb')} AS previous_period, {label.format(b='b')} AS current_period,
         round(pv, 2) AS previous_value, round(value, 2) AS current_value,
         round(value - pv, 2) AS absolute_change,
         CASE WHEN pv <> 0 THEN round(100 * (value - pv) / pv, 2) END AS percentage_change
  FROM (SELECT b, value, lag(value) OVER (ORDER BY b) AS pv, lag(b) OVER (ORDER BY b) AS pb
        FROM ({series}) WHERE value IS NOT NULL)
  WHERE pb IS NOT NULL"""


_CHANGE_COLUMNS = (
    "previous_period, current_period, previous_value, current_value, absolute_change, percentage_change"
)


def _summary(series: str, period: str) -> str:
    return f"""
  SELECT {_LABELS[period].format(b='best')} AS best_period, best_value,
         {_LABELS[period].format(b='worst')} AS worst_period, worst_value, total_periods,
         CASE WHEN total_periods < 2 THEN 'insufficient_data'
              WHEN best_value = worst_value THEN 'stable'
              WHEN up THEN 'strictly_increasing' WHEN down THEN 'strictly_decreasing'
              WHEN last > first THEN 'increasing' WHEN last < first THEN 'decreasing'
              ELSE 'fluctuating' END AS trend_direction,
         CASE WHEN total_periods >= 2 THEN round(last - first, 2) END AS overall_change,
         CASE WHEN total_periods >= 2 AND first <> 0 THEN round(100 * (last - first) / first, 2) END
           AS overall_percentage_change
  FROM (SELECT arg_min(b, (-value, b)) AS best, max(value) AS best_value,
               arg_min(b, (value, b)) AS worst, min(value) AS worst_value, count(*) AS total_periods,
               arg_min(value, b) AS first, arg_max(value, b) AS last,
               bool_and(value < n) AS up, bool_and(value > n) AS down
        FROM (SELECT b, value, lead(value) OVER (ORDER BY b) AS n
              FROM (SELECT b, round(value, 2) AS value FROM ({series})) WHERE value IS NOT NULL))"""


def _years(value: str, agg: str, first: int, second: int) -> str:
    how = _SQL_AGGREGATES[agg].format(v=value)
    return f"""
SELECT '{first}' AS previous_period, '{second}' AS current_period,
       round(v1, 2) AS previous_value, round(v2, 2) AS current_value,
       round(v2 - v1, 2) AS absolute_change,
       CASE WHEN v1 <> 0 THEN round(100 * (v2 - v1) / v1, 2) END AS percentage_change,
       CASE WHEN v1 + v2 <> 0 THEN round(100 * abs(round(v2 - v1, 2)) / ((v1 + v2) / 2), 2) END
         AS percentage_difference,
       CASE WHEN v2 > v1 THEN 'increased' WHEN v2 < v1 THEN 'decreased' ELSE 'unchanged' END AS comparison_summary
FROM (SELECT (SELECT {how} FROM orders WHERE year(o_orderdate) = {first}) AS v1,
             (SELECT {how} FROM orders WHERE year(o_orderdate) = {second}) AS v2)"""


def _statistics(columns: dict[str, str], source: str) -> str:
    parts = [
        f"""SELECT '{name}' AS "column", count(v) AS count, round(avg(v), 2) AS mean,
       round((quantile_disc(v, 0.5) - quantile_disc(-v, 0.5)) / 2, 2) AS median, coalesce(round(stddev_samp(v), 2), 0.0) AS std,
       round(min(v), 2) AS min, round(max(v), 2) AS max, round(quantile_cont(v, 0.25), 2) AS q25,
       round(quantile_cont(v, 0.75), 2) AS q75, round(skewness(v), 2) AS skew
FROM (SELECT CAST({expression} AS DOUBLE) AS v FROM {source})"""
        for name, expression in columns.items()
    ]
    return f"""
SELECT "column", count, mean, median, std, min, max, q25, q75, round(q75 - q25, 2) AS iqr,
       CASE WHEN count >= 3 AND std > 0 THEN skew ELSE 0.0 END AS skewness,
       CASE WHEN mean <> 0 AND std > 0 THEN round(std / abs(mean), 4) END AS coefficient_of_variation
FROM ({' UNION ALL '.join(parts)}) WHERE count > 0"""


def _fences(columns: list[str], source: str, k: float) -> str:
    """Every value next to the fences of its column: c, i, v, lo, hi, med."""
    parts = [
        f"""SELECT '{c}' AS c, {i} AS i, CAST({c} AS DOUBLE) AS v, lo, hi, med FROM {source},
  (SELECT q1 - {k} * (q3 - q1) AS lo, q3 + {k} * (q3 - q1) AS hi, med
   FROM (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3,
                quantile_cont(CAST({c} AS DOUBLE), 0.5) AS med FROM {source})) AS f{i}
  WHERE {c} IS NOT NULL"""
        for i, c in enumerate(columns)
    ]
    return " UNION ALL ".join(parts)


def _outliers(columns: list[str], source: str, k: float) -> str:
    return f"""
SELECT c AS "column", observations, outlier_count,
       round(100 * outlier_count / observations, 2) AS outlier_percentage,
       CASE WHEN NOT is_constant THEN round(lo, 2) END AS lower_bound,
       CASE WHEN NOT is_constant THEN round(hi, 2) END AS upper_bound, is_constant
FROM (SELECT c, count(*) AS observations, min(v) = max(v) AS is_constant, max(lo) AS lo, max(hi) AS hi,
             CASE WHEN min(v) = max(v) THEN 0 ELSE count(*) FILTER (v < lo OR v > hi) END AS outlier_count
      FROM ({_fences(columns, source, k)}) GROUP BY c)"""


def _outlier_examples(columns: list[str], source: str, k: float) -> str:
    return f"""
SELECT c AS "column", CAST(rank AS INTEGER) AS rank, round(v, 2) AS value
FROM (SELECT c, v, row_number() OVER (PARTITION BY c ORDER BY abs(v - med) DESC, v) AS rank
      FROM ({_fences(columns, source, k)}) WHERE v < lo OR v > hi) WHERE rank <= 5"""


_LINEITEM = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
]


def _pairs(columns: list[str], target: str | None = None) -> list[tuple[str, str]]:
    if target is not None:
        return [(target, c) for c in columns if c != target]
    return [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]


def _correlations(pairs: list[tuple[str, str]], source: str) -> str:
    parts = [
        f"SELECT {i} AS p, '{a}' AS column_1, '{b}' AS column_2, "
        f"CASE WHEN isfinite(corr({a}, {b})) THEN corr({a}, {b}) END AS r FROM {source}"
        for i, (a, b) in enumerate(pairs)
    ]
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE r IS NOT NULL"


def _strongest(pairs: list[tuple[str, str]], source: str, limit: int) -> str:
    return (
        f"SELECT column_1, column_2, round(r, 3) AS correlation FROM ({_correlations(pairs, source)}) "
        f"ORDER BY abs(r) DESC, p LIMIT {limit}"
    )


def _profile(source: str, columns: list[tuple[str, str, str, bool]], formats: dict[str, str] | None = None) -> str:
    """columns: name, type, semantic type, identifier-like name; formats: of dates that are text."""
    parts = []
    for i, (name, kind, semantic, named) in enumerate(columns):
        integral = "FALSE" if kind in ("double", "float") else "TRUE"
        date = f"'{(formats or {}).get(name, 'datetime64')}'" if semantic == "datetime" else "CAST(NULL AS VARCHAR)"
        sure = "1.0" if semantic == "datetime" else "CAST(NULL AS DOUBLE)"
        parts.append(
            f"""SELECT {i} AS position, '{name}' AS "column", '{kind}' AS dtype, '{semantic}' AS semantic_type,
       count(*) AS row_count, count(*) - count({name}) AS null_count, count(DISTINCT {name}) AS unique_count,
       {named} AS named, {integral} AS integral, {date} AS date_format, CAST({sure} AS DOUBLE) AS date_confidence
FROM {source}"""
        )
    return f"""
SELECT CAST(position AS INTEGER) AS position, "column", dtype, semantic_type, row_count, null_count,
       null_percentage, unique_count, uniqueness_ratio, is_constant, is_all_null, identifier_status,
       semantic_type IN ('categorical', 'boolean') AND unique_count BETWEEN 2 AND 50
         AND coalesce(identifier_status, '') <> 'detected' AS is_candidate_group,
       date_format, date_confidence
FROM (SELECT *, CASE
        WHEN named AND valid >= 5 AND uniqueness_ratio = 1 THEN 'detected'
        WHEN named AND valid >= 10 AND uniqueness_ratio >= 0.95 THEN 'detected'
        WHEN valid >= 10 AND uniqueness_ratio = 1 AND semantic_type IN ('categorical', 'numeric')
             AND integral AND NOT is_constant THEN 'possible' END AS identifier_status
      FROM (SELECT *, row_count - null_count AS valid,
                   round(100 * null_count / row_count, 2) AS null_percentage,
                   coalesce(round(unique_count / nullif(row_count - null_count, 0), 3), 0.0) AS uniqueness_ratio,
                   unique_count = 1 AS is_constant, null_count = row_count AS is_all_null
            FROM ({' UNION ALL '.join(parts)})))"""


_CUSTOMER = [
    ("c_custkey", "bigint", "numeric", True),
    ("c_name", "string", "categorical", False),
    ("c_nationkey", "int", "numeric", True),
    ("c_acctbal", "double", "numeric", False),
    ("c_mktsegment", "string", "categorical", False),
]
_ORDER_TEXTS = [
    *[(name, "string", "categorical", name == "key") for name in ("key", "customer", "price", "large")],
    *[(name, "string", "datetime", False) for name in ("iso_date", "us_date", "day_first")],
    ("partly", "string", "categorical", False),
    ("ordered", "string", "datetime", False),
    *[(name, "string", "categorical", False) for name in ("priority", "nothing")],
]
_ORDER_FORMATS = {"iso_date": "YYYY-MM-DD", "us_date": "MM/DD/YYYY", "day_first": "DD-MM-YYYY", "ordered": "auto-detected"}
_EVENTS = [
    ("event_id", "bigint", "numeric", True),
    ("ts", "timestamp_ntz", "datetime", False),
    ("user_id", "bigint", "numeric", True),
    ("event_type", "string", "categorical", False),
    ("value", "double", "numeric", False),
    ("props", "string", "categorical", False),
]
_ORDERS = [
    ("o_orderkey", "bigint", "numeric", True),
    ("o_custkey", "bigint", "numeric", True),
    ("o_totalprice", "double", "numeric", False),
]
_LINEITEM_COLUMNS = [
    ("l_orderkey", "bigint", "numeric", True),
    ("l_partkey", "bigint", "numeric", True),
    ("l_suppkey", "bigint", "numeric", True),
    ("l_linenumber", "int", "numeric", False),
    ("l_quantity", "double", "numeric", False),
    ("l_extendedprice", "double", "numeric", False),
    ("l_discount", "double", "numeric", False),
    ("l_tax", "double", "numeric", False),
    ("l_returnflag", "string", "categorical", False),
    ("l_linestatus", "string", "categorical", False),
    ("l_shipdate", "timestamp_ntz", "datetime", False),
]
_DOCUMENTS = [
    ("doc_id", "bigint", "numeric", True),
    ("text", "string", "categorical", False),
    ("lang", "string", "categorical", False),
    ("source", "string", "categorical", False),
    ("n_chars", "bigint", "numeric", False),
]

_FORMATS = [
    ("YYYY-MM-DD", "%Y-%m-%d"), ("YYYY/MM/DD", "%Y/%m/%d"), ("MM-DD-YYYY", "%m-%d-%Y"), ("MM/DD/YYYY", "%m/%d/%Y"),
    ("DD-MM-YYYY", "%d-%m-%Y"), ("DD/MM/YYYY", "%d/%m/%Y"), ("YYYY-DD-MM", "%Y-%d-%m"), ("YYYY/DD/MM", "%Y/%d/%m"),
]
_TEXT_COLUMNS = [
    "key", "customer", "price", "large", "iso_date", "us_date", "day_first", "partly", "ordered", "priority", "nothing",
]


def _date_detection() -> str:
    scores = [
        f"SELECT '{c}' AS c, {j} AS j, '{label}' AS label, count(try_strptime({c}, '{fmt}')) / count({c}) AS ratio FROM texts"
        for c in _TEXT_COLUMNS
        for j, (label, fmt) in enumerate(_FORMATS)
    ]
    return f"""
WITH {_TEXT}, scores AS ({' UNION ALL '.join(scores)}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY ratio DESC, j) AS place FROM scores)
SELECT a.c AS "column",
       CASE WHEN b.ratio > 0 AND abs(a.ratio - b.ratio) < 0.001 AND a.j < b.j THEN 'auto-detected' ELSE a.label END
         AS format,
       a.label AS parsed_as,
       round(least(1.0, a.ratio + CASE WHEN a.c IN ('iso_date', 'us_date') THEN 0.05 ELSE 0.0 END), 3) AS confidence
FROM ranked a JOIN ranked b ON a.c = b.c AND a.place = 1 AND b.place = 2 WHERE a.ratio >= 0.8"""


def _type_inference() -> str:
    na = "('', '#N/A', '#N/A N/A', '#NA', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null')"
    parts = [
        f"""SELECT '{c}' AS "column",
       CASE WHEN count(v) = 0 THEN 'double'
            WHEN count(v) FILTER (regexp_full_match(v, '[+-]?[0-9]+')) = count(v) THEN 'bigint'
            WHEN count(try_cast(v AS DOUBLE)) FILTER (regexp_full_match(v, '[+-]?[0-9.eE+-]+')) = count(v) THEN 'double'
            WHEN count(v) FILTER (lower(v) IN ('true', 'false')) = count(v) THEN 'boolean'
            ELSE 'string' END AS type
FROM (SELECT CASE WHEN {c} NOT IN {na} THEN {c} END AS v FROM texts)"""
        for c in _TEXT_COLUMNS
    ]
    return f"WITH {_TEXT} {' UNION ALL '.join(parts)}"


_RELATED = {
    "region": [("r_regionkey", "n"), ("r_name", "t")],
    "nation": [("n_nationkey", "n"), ("n_name", "t"), ("n_regionkey", "n")],
    "customer": [("c_custkey", "n"), ("c_name", "t"), ("c_nationkey", "n"), ("c_acctbal", "n"), ("c_mktsegment", "t")],
    "supplier": [("s_suppkey", "n"), ("s_name", "t"), ("s_nationkey", "n"), ("s_acctbal", "n")],
    "orders": [
        ("o_orderkey", "n"), ("o_custkey", "n"), ("o_orderstatus", "t"), ("o_totalprice", "n"), ("o_orderdate", "d"),
        ("o_orderpriority", "t"),
    ],
    "part": [
        ("p_partkey", "n"), ("p_name", "t"), ("p_brand", "t"), ("p_type", "t"), ("p_size", "n"), ("p_retailprice", "n"),
    ],
    "lineitem": [
        ("l_orderkey", "n"), ("l_partkey", "n"), ("l_suppkey", "n"), ("l_linenumber", "n"), ("l_quantity", "n"),
        ("l_extendedprice", "n"), ("l_discount", "n"), ("l_tax", "n"), ("l_returnflag", "t"), ("l_linestatus", "t"),
        ("l_shipdate", "d"),
    ],
}


def _normalized(x: str) -> str:
    plain = f"regexp_replace(lower({x}), '[^a-zA-Z0-9]', '', 'g')"
    return f"regexp_replace(regexp_replace({plain}, '^id', ''), '(id|num|code|key)$', '')"


def _bigrams(x: str) -> str:
    return (
        f"CASE WHEN length({x}) >= 2 THEN list_distinct(list_transform(range(1, length({x})), "
        f"lambda i: substring({x}, i, 2))) ELSE [{x}] END"
    )


def _similarity(a: str, b: str) -> str:
    a, b = f"trim(lower({a}))", f"trim(lower({b}))"
    na, nb = _normalized(a), _normalized(b)
    ba, bb = _bigrams(a), _bigrams(b)
    shared = f"len(list_intersect({ba}, {bb}))"
    return f"""CASE WHEN {a} = {b} THEN 1.0 WHEN {na} <> '' AND {na} = {nb} THEN 0.95
  WHEN least(length({na}), length({nb})) >= 3 AND (contains({na}, {nb}) OR contains({nb}, {na})) THEN 0.75
  ELSE CAST(round({shared} / (len({ba}) + len({bb}) - {shared}), 3) AS DOUBLE) END"""


def _edges(related: dict[str, list[tuple[str, str]]]) -> str:
    """All scored candidate pairs of the given tables: numbers are compared as doubles."""
    cells, facts = [], []
    number = 0
    for d, (name, columns) in enumerate(related.items()):
        for c, family in columns:
            value = f"CAST(CAST({c} AS DOUBLE) AS VARCHAR)" if family == "n" else f"trim(CAST({c} AS VARCHAR))"
            cells.append(f"SELECT DISTINCT {number} AS number, '{family}' AS family, {value} AS v FROM {name} WHERE {c} IS NOT NULL")
            facts.append(
                f"SELECT {number} AS number, {d} AS d, '{name}' AS dataset, '{c}' AS name, '{family}' AS family, "
                f"count(DISTINCT {c}) AS u, count(*) = count(DISTINCT {c}) + CASE WHEN count({c}) < count(*) THEN 1 ELSE 0 END "
                f"AS is_unique FROM {name}"
            )
            number += 1
    return f"""
cells AS MATERIALIZED ({' UNION ALL '.join(cells)}), facts AS MATERIALIZED ({' UNION ALL '.join(facts)}),
sizes AS MATERIALIZED (SELECT number, count(*) AS n FROM cells WHERE v <> '' GROUP BY number),
sets AS MATERIALIZED (
  SELECT members, count(*) AS n FROM (SELECT family, v, list_sort(list(number)) AS members FROM cells WHERE v <> '' GROUP BY family, v)
  WHERE len(members) > 1 GROUP BY members),
shared AS MATERIALIZED (
  SELECT an, bn, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT an, unnest(members) AS bn, n FROM (SELECT unnest(members) AS an, members, n FROM sets)) WHERE an < bn GROUP BY an, bn),
scored AS MATERIALIZED (
  SELECT l.number AS ln, r.number AS rn, l.dataset AS left_dataset, l.name AS left_column,
         r.dataset AS right_dataset, r.name AS right_column,
         CAST({_similarity('l.name', 'r.name')} AS DOUBLE) AS name_similarity,
         coalesce(round(s.n / nullif(ls.n + rs.n - s.n, 0), 3), 0.0) AS value_overlap,
         CASE WHEN l.is_unique AND r.is_unique THEN '1:1' WHEN l.is_unique THEN '1:N'
              WHEN r.is_unique THEN 'N:1' ELSE 'N:N' END AS cardinality,
         l.is_unique OR r.is_unique AS safe_to_join
  FROM facts l JOIN facts r ON l.d < r.d AND l.family = r.family AND l.u > 1 AND r.u > 1
  LEFT JOIN sizes ls ON ls.number = l.number LEFT JOIN sizes rs ON rs.number = r.number
  LEFT JOIN shared s ON s.an = l.number AND s.bn = r.number),
edges AS (
  SELECT *, round(0.4 * name_similarity + 0.6 * value_overlap, 2) AS confidence FROM scored
  WHERE name_similarity >= 0.3 OR value_overlap > 0)"""


def _visible_line(table: str, x: str, place: str, y: str, pixels: int) -> str:
    """First, last, lowest and highest point of each column of pixels."""
    return f"""
WITH points AS (SELECT {x} AS x, {y} AS y, {place} AS place FROM {table} WHERE {x} IS NOT NULL AND {y} IS NOT NULL),
ends AS (SELECT min(place) AS a, max(place) AS b FROM points),
placed AS (SELECT x, y, CAST(least(floor(CAST(place - a AS DOUBLE) / CAST(b - a AS DOUBLE) * {pixels}), {pixels - 1}) AS INTEGER) AS pixel FROM points, ends),
ranked AS (SELECT *, row_number() OVER (PARTITION BY pixel ORDER BY x, y) AS r1, row_number() OVER (PARTITION BY pixel ORDER BY x DESC, y DESC) AS r2,
  row_number() OVER (PARTITION BY pixel ORDER BY y, x) AS r3, row_number() OVER (PARTITION BY pixel ORDER BY y DESC, x DESC) AS r4 FROM placed)
SELECT DISTINCT pixel, x, y FROM ranked WHERE 1 IN (r1, r2, r3, r4)"""


_EDGE_COLUMNS = (
    "left_dataset, left_column, right_dataset, right_column, confidence, name_similarity, value_overlap, "
    "cardinality, safe_to_join"
)

_FINDING = "CAST({value} AS DOUBLE) AS value, CAST({detail} AS VARCHAR) AS detail"


def _findings() -> str:
    """Everything noteworthy about the orders with gaps."""
    numeric = ["o_orderkey", "o_custkey", "price", "constant"]
    mean = _series("o_orderdate", "price", "month", "mean", "gaps")
    total = _series("o_orderdate", "price", "month", "sum", "gaps")

    def row(operator: str, subject: str, finding: str, value: str, detail: str, source: str, where: str = "TRUE") -> str:
        return (
            f"SELECT '{operator}' AS operator, {subject} AS subject, {finding} AS finding, "
            f"{_FINDING.format(value=value, detail=detail)} FROM {source} WHERE {where}"
        )

    parts = [
        row("missing_values", "c", "'most affected'", "round(100 * m / n, 2)", "m",
            "(SELECT * FROM missing WHERE m > 0 ORDER BY m DESC, c LIMIT 3)"),
        row("statistics", '"column"', "'right skewed'", "skewness", "NULL", "stats", "skewness > 1"),
        row("statistics", '"column"', "'left skewed'", "skewness", "NULL", "stats", "skewness < -1"),
        row("statistics", '"column"', "'high variability'", "coefficient_of_variation", "NULL", "stats",
            "coefficient_of_variation > 1"),
        row("statistics", '"column"', "'limited data'", "count", "NULL", "stats", "count < 3"),
        row("outlier_analysis", '"column"', "'outliers'", "outlier_count", "outlier_percentage",
            '(SELECT * FROM outside WHERE outlier_count > 0 ORDER BY outlier_count DESC, "column" LIMIT 3)'),
        row("correlation_analysis", "column_1 || ' & ' || column_2", "'strongest positive'", "round(r, 3)", "NULL",
            "(SELECT * FROM pairs WHERE r > 0 ORDER BY r DESC, p LIMIT 1)"),
        row("correlation_analysis", "column_1 || ' & ' || column_2", "'strongest negative'", "round(r, 3)", "NULL",
            "(SELECT * FROM pairs WHERE r < 0 ORDER BY r, p LIMIT 1)"),
        row("time_analysis", "'price'", "'trend direction'", "NULL", "trend_direction", "summary", "total_periods >= 2"),
        row("time_analysis", "'price'", "'best period'", "best_value", "best_period", "summary"),
        row("time_analysis", "'price'", "'worst period'", "worst_value", "worst_period", "summary",
            "worst_period <> best_period"),
        row("time_analysis", "'price'", "'overall change'", "overall_change", "overall_percentage_change", "summary",
            "total_periods >= 2"),
        row("time_analysis", "'price'", "'limited data'", "total_periods", "NULL", "summary", "total_periods < 3"),
        row("percentage_change", "'price'", "'largest increase'", "percentage_change", "current_period",
            "(SELECT * FROM steps WHERE percentage_change IS NOT NULL ORDER BY percentage_change DESC, b LIMIT 1)"),
        row("percentage_change", "'price'", "'largest decrease'", "percentage_change", "current_period",
            "(SELECT * FROM steps WHERE percentage_change IS NOT NULL ORDER BY percentage_change, b LIMIT 1)"),
        row("percentage_change", "'price'", "'overall change across all periods'", "round(l - f, 2)",
            "round(100 * (l - f) / f, 2)",
            "(SELECT arg_min(previous_value, b) AS f, arg_max(current_value, b) AS l FROM steps)", "f <> 0"),
        row("groupby_analysis", "'price'", "'best group'", "value", '"group"', "ranked", "rank = 1"),
        row("groupby_analysis", "'price'", "'worst group'", "value", '"group"',
            '(SELECT * FROM ranked ORDER BY value, "group" LIMIT 1)', "rank <> 1"),
        row("groupby_analysis", "'price'", "'rank ' || CAST(rank AS VARCHAR)", "value", '"group"', "ranked", "rank <= 3"),
        row("groupby_analysis", "'price'", "'absolute difference'", "round(abs(b.value - a.value), 2)",
            "a.\"group\" || ' vs ' || b.\"group\"", 'ranked a JOIN ranked b ON a."group" < b."group"',
            "(SELECT count(*) FROM ranked) = 2"),
    ]
    return f"""
WITH {_GAPS},
missing AS ({' UNION ALL '.join(f"SELECT '{c}' AS c, count(*) - count({c}) AS m, count(*) AS n FROM gaps" for c in (*numeric, 'o_orderdate', 'is_large', 'priority'))}),
stats AS ({_statistics({c: c for c in numeric}, 'gaps')}),
outside AS ({_outliers(numeric, 'gaps', 1.5)}),
pairs AS ({_correlations(_pairs(numeric), 'gaps')}),
summary AS ({_summary(mean, 'month')}),
steps AS ({_changes(total, 'month')}),
ranked AS (SELECT *, row_number() OVER (ORDER BY value DESC, "group") AS rank
           FROM ({_groupby('priority', 'price', 'mean', 'gaps')}))
{' UNION ALL '.join(parts)}"""


_URGENT = "o_orderpriority = '1-URGENT'"

_QUERIES: dict[str, str] = {
    **{f"groupby_{a}": _groupby("o_orderpriority", "o_totalprice", a, "orders") for a in _SQL_AGGREGATES},
    "groupby_datetime": _groupby("o_orderdate", "o_totalprice", "sum", "orders"),
    "groupby_with_gaps": f"WITH {_GAPS} {_groupby('priority', 'price', 'mean', 'gaps')}",
    "groupby_median_many_groups": f"{_groupby('o_custkey', 'cents', 'median', _CENTS)}",
    "groupby_filtered": _groupby("l_linenumber", "l_extendedprice", "sum", "lineitem", "l_linenumber IN (1, 3, 7)"),
    "groupby_filtered_text": _groupby(
        "o_orderpriority", "o_totalprice", "mean", "orders", "o_orderpriority IN ('1-URGENT', '2-HIGH')"
    ),
    "groupby_filtered_boolean": f"WITH {_GAPS} {_groupby('is_large', 'o_custkey', 'count', 'gaps', 'is_large')}",
    "groupby_top_n": _groupby(
        "c_nationkey", "c_acctbal", "sum", "customer", tail='ORDER BY value DESC NULLS LAST, "group" LIMIT 10'
    ),
    "groupby_bottom_n": _groupby(
        "c_nationkey", "c_acctbal", "sum", "customer", tail='ORDER BY value NULLS LAST, "group" LIMIT 10'
    ),
    "groupby_all": _groupby("o_custkey", "o_totalprice", "sum", "orders"),
    "groupby_best_worst_many": f"""
SELECT arg_min("group", (-value, "group")) AS best_group, max(value) AS best_value,
       arg_min("group", (value, "group")) AS worst_group, min(value) AS worst_value
FROM ({_groupby('o_custkey', 'o_totalprice', 'sum', 'orders')})""",
    "groupby_ranking_many": f"""
SELECT CAST(row_number() OVER (ORDER BY value DESC, "group") AS INTEGER) AS rank, "group", value
FROM ({_groupby('o_custkey', 'o_totalprice', 'max', 'orders')})""",
    "groupby_capped_50": _groupby(
        "o_custkey", "o_totalprice", "sum", "orders", tail='ORDER BY value DESC NULLS LAST, "group" LIMIT 50'
    ),
    "groupby_best_worst": f"""
SELECT arg_min("group", (-value, "group")) AS best_group, max(value) AS best_value,
       arg_min("group", (value, "group")) AS worst_group, min(value) AS worst_value
FROM ({_groupby('l_returnflag', 'l_extendedprice', 'sum', 'lineitem')})""",
    "groupby_ranking": f"""
SELECT CAST(row_number() OVER (ORDER BY value DESC, "group") AS INTEGER) AS rank, "group", value
FROM ({_groupby('p_brand', 'p_retailprice', 'mean', 'part')})""",
    "groupby_two_way_comparison": f"""
WITH g AS ({_groupby('l_linestatus', 'l_quantity', 'sum', 'lineitem')})
SELECT a."group" AS group_1, a.value AS value_1, b."group" AS group_2, b.value AS value_2,
       round(abs(b.value - a.value), 2) AS absolute_difference,
       round(100 * round(abs(b.value - a.value), 2) / ((a.value + b.value) / 2), 2) AS percentage_difference,
       round(100 * (b.value - a.value) / a.value, 2) AS percentage_change
FROM g a JOIN g b ON a."group" < b."group" WHERE (SELECT count(*) FROM g) = 2""",
    **{
        f"series_{p}": _labelled(_series("o_orderdate", "cents", p, a, _CENTS), p)
        for p, a in (("day", "sum"), ("week", "mean"), ("month", "sum"), ("quarter", "median"), ("year", "std"))
    },
    "series_year_filter": _labelled(
        _series("o_orderdate", "o_totalprice", "month", "max", "orders", "year(o_orderdate) = 1997"), "month"
    ),
    "series_date_range": _labelled(
        _series("ts", "value", "day", "sum", "events", "ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-20'"),
        "day",
    ),
    "series_by_group": _labelled(
        _series("ts", "value", "week", "mean", "events", "event_type IN ('click', 'error', 'signup')", "event_type"),
        "week",
        by=True,
    ),
    "series_by_group_wide": f"""
SELECT period_start, period, max(value) FILTER ("group" = 'click') AS click,
       max(value) FILTER ("group" = 'error') AS error, max(value) FILTER ("group" = 'purchase') AS purchase,
       max(value) FILTER ("group" = 'signup') AS signup, max(value) FILTER ("group" = 'view') AS view
FROM ({_labelled(_series('ts', 'value', 'week', 'count', 'events', by='event_type'), 'week', by=True)})
GROUP BY period_start, period""",
    "period_buckets": f"""
SELECT o_orderkey, b AS period_start, {_LABELS['quarter'].format(b='b')} AS period
FROM (SELECT o_orderkey, {_bucket('o_orderdate', 'quarter')} AS b FROM orders)""",
    "series_best_worst": "SELECT best_period, best_value, worst_period, worst_value, total_periods FROM ("
    + _summary(_series("o_orderdate", "o_totalprice", "month", "sum", "orders"), "month")
    + ")",
    "series_trend": "SELECT trend_direction, total_periods FROM ("
    + _summary(_series("ts", "value", "week", "sum", "events"), "week")
    + ")",
    "series_overall_change": "SELECT overall_change, overall_percentage_change FROM ("
    + _summary(_series("o_orderdate", "o_totalprice", "year", "mean", "orders"), "year")
    + ")",
    "change_period_over_period": f"SELECT {_CHANGE_COLUMNS} FROM ("
    + _changes(_series("o_orderdate", "o_totalprice", "month", "sum", "orders"), "month")
    + ")",
    "change_latest_24": f"SELECT {_CHANGE_COLUMNS} FROM ("
    + _changes(_series("o_orderdate", "o_totalprice", "month", "sum", "orders"), "month")
    + ") ORDER BY b DESC LIMIT 24",
    "change_filtered": f"SELECT {_CHANGE_COLUMNS} FROM ("
    + _changes(_series("o_orderdate", "o_totalprice", "quarter", "mean", "orders", _URGENT), "quarter")
    + ")",
    "change_largest": f"""
WITH c AS ({_changes(_series('o_orderdate', 'o_totalprice', 'month', 'sum', 'orders'), 'month')})
SELECT kind, {_CHANGE_COLUMNS} FROM (
  SELECT 'latest_change' AS kind, * FROM (SELECT * FROM c ORDER BY b DESC LIMIT 1)
  UNION ALL SELECT 'largest_increase', * FROM
    (SELECT * FROM c WHERE percentage_change IS NOT NULL ORDER BY percentage_change DESC, b LIMIT 1)
  UNION ALL SELECT 'largest_decrease', * FROM
    (SELECT * FROM c WHERE percentage_change IS NOT NULL ORDER BY percentage_change, b LIMIT 1))""",
    "change_overall": f"""
WITH c AS ({_changes(_series('o_orderdate', 'o_totalprice', 'month', 'sum', 'orders'), 'month')})
SELECT total_periods_compared, first_value, last_value, round(last_value - first_value, 2) AS overall_change,
       CASE WHEN first_value <> 0 THEN round(100 * (last_value - first_value) / first_value, 2) END
         AS overall_percentage_change
FROM (SELECT count(*) AS total_periods_compared, arg_min(previous_value, b) AS first_value,
             arg_max(current_value, b) AS last_value FROM c)""",
    "change_year_vs_year": _years("o_totalprice", "sum", 1996, 1997),
    "change_year_vs_year_median": _years("o_totalprice", "median", 1998, 1999),
    "table_shape": "SELECT count(*) AS num_rows, 6 AS num_columns FROM orders",
    "table_numeric_columns": f"WITH {_GAPS} SELECT o_orderkey, o_custkey, price, constant FROM gaps",
    "missing_values": f"""
WITH {_GAPS}, m AS (
  SELECT 'price' AS "column", count(*) - count(price) AS missing_count, count(*) AS n FROM gaps
  UNION ALL SELECT 'priority', count(*) - count(priority), count(*) FROM gaps)
SELECT "column", missing_count, round(missing_count / n * 100, 2) AS missing_percentage FROM m WHERE missing_count > 0""",
    "missing_totals": f"""
WITH {_GAPS}
SELECT count(*) AS total_rows, 2 * count(*) - count(price) - count(priority) AS total_missing_values,
       2 * count(*) - count(price) - count(priority) > 0 AS has_missing_values FROM gaps""",
    "statistics_all": _statistics({c: c for c in _LINEITEM}, "lineitem"),
    "statistics_column": f"WITH {_GAPS} {_statistics({'price': 'price'}, 'gaps')}",
    "statistics_boolean": f"WITH {_GAPS} {_statistics({'is_large': 'CAST(is_large AS INTEGER)'}, 'gaps')}",
    "outliers_all": _outliers(_LINEITEM, "lineitem", 0.25),
    "outliers_column": _outliers(["value"], "events", 1.5),
    "outliers_constant": f"WITH {_GAPS} " + _outliers(["constant"], "gaps", 1.5),
    "outlier_examples": _outlier_examples(["p_partkey", "p_size", "p_retailprice"], "part", 0.25),
    "correlation_target": _strongest(_pairs(_LINEITEM, "l_quantity"), "lineitem", 5),
    "correlation_pairs": _strongest(_pairs(_LINEITEM), "lineitem", 20),
    "correlation_all_pairs": _strongest(_pairs(_LINEITEM), "lineitem", 1000),
    "correlation_with_infinity": """WITH finite AS (
  SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS price FROM orders) """
    + _strongest(_pairs(["o_orderkey", "o_custkey", "price"]), "finite", 1000),
    "correlation_subset": _strongest(
        _pairs(["l_discount", "l_tax", "l_extendedprice"], "l_quantity"), "lineitem", 10
    ),
    "correlation_with_gaps": f"WITH {_GAPS} "
    + _strongest(_pairs(["o_orderkey", "o_custkey", "price", "constant"]), "gaps", 10),
    "correlation_extremes": f"""
WITH c AS ({_correlations(_pairs(_LINEITEM), 'lineitem')})
SELECT kind, column_1, column_2, round(r, 3) AS correlation FROM (
  SELECT 'strongest_positive' AS kind, * FROM (SELECT * FROM c WHERE r > 0 ORDER BY r DESC, p LIMIT 1)
  UNION ALL SELECT 'strongest_negative', * FROM (SELECT * FROM c WHERE r < 0 ORDER BY r, p LIMIT 1))""",
    "correlation_constant_columns": f"""
WITH {_GAPS}, f AS (
  SELECT 'o_orderkey' AS "column", count(DISTINCT o_orderkey) AS n FROM gaps
  UNION ALL SELECT 'o_custkey', count(DISTINCT o_custkey) FROM gaps
  UNION ALL SELECT 'price', count(DISTINCT price) FROM gaps
  UNION ALL SELECT 'constant', count(DISTINCT constant) FROM gaps)
SELECT "column" FROM f WHERE n <= 1""",
    "profile": _profile("customer", _CUSTOMER),
    "profile_events": _profile("events", _EVENTS),
    "profile_lineitem": _profile("lineitem", _LINEITEM_COLUMNS),
    "profile_texts": f"WITH {_TEXT} SELECT * FROM ({_profile('texts', _ORDER_TEXTS, _ORDER_FORMATS)})",
    "profile_nothing": f"WITH none AS (SELECT * FROM orders WHERE o_orderkey IS NULL) SELECT * FROM ({_profile('none', _ORDERS)}) WHERE row_count > 0",
    "profile_documents": _profile("documents", _DOCUMENTS),
    "profile_identifiers": 'SELECT "column", identifier_status AS status, uniqueness_ratio, unique_count FROM ('
    + _profile("customer", _CUSTOMER)
    + ") WHERE identifier_status IS NOT NULL",
    "profile_group_candidates": 'SELECT "column", unique_count FROM ('
    + _profile("events", _EVENTS)
    + ") WHERE is_candidate_group",
    "profile_samples": """
SELECT "column", CAST(rank AS INTEGER) AS rank, value FROM (
  SELECT "column", value, row_number() OVER (PARTITION BY "column" ORDER BY value) AS rank FROM (
    SELECT DISTINCT 'text' AS "column", text AS value FROM documents
    UNION ALL SELECT DISTINCT 'lang', lang FROM documents
    UNION ALL SELECT DISTINCT 'source', source FROM documents) WHERE value IS NOT NULL) WHERE rank <= 5""",
    "type_inference": _type_inference(),
    "typed_columns": f"""
WITH {_TEXT}
SELECT CAST(key AS BIGINT) AS key, CAST(nullif(customer, 'NA') AS BIGINT) AS customer, CAST(price AS DOUBLE) AS price,
       large = 'True' AS large, CAST(NULL AS DOUBLE) AS nothing, strptime(iso_date, '%Y-%m-%d') AS iso_date,
       strptime(us_date, '%m/%d/%Y') AS us_date, strptime(day_first, '%d-%m-%Y') AS day_first,
       partly, strptime(ordered, '%Y-%m-%d') AS ordered, priority FROM texts""",
    "date_detection": _date_detection(),
    "date_conversion": f"""
WITH {_TEXT}
SELECT key, customer, price, large, nothing, partly, strptime(iso_date, '%Y-%m-%d') AS iso_date, strptime(us_date, '%m/%d/%Y') AS us_date,
       strptime(day_first, '%d-%m-%Y') AS day_first, strptime(ordered, '%Y-%m-%d') AS ordered, priority FROM texts""",
    "join_inner": """
SELECT * FROM orders JOIN customer ON o_custkey = c_custkey""",
    "join_left": """
SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "join_left_one_to_many": """
SELECT * FROM customer LEFT JOIN orders ON c_custkey = o_custkey""",
    "join_right": """
SELECT d.*, quality, toxic FROM labels l RIGHT JOIN documents d ON d.doc_id = l.doc_id""",
    "join_right_one_to_many": """
SELECT s_nationkey AS nationkey, n_name AS name_x, s_name AS name_y, s_suppkey
FROM nation RIGHT JOIN supplier ON n_nationkey = s_nationkey""",
    "join_outer": """
SELECT coalesce(l.doc_id, d.doc_id) AS doc_id, quality, toxic, text, lang, source, n_chars
FROM labels l FULL JOIN documents d ON l.doc_id = d.doc_id""",
    "join_outer_null_keys": """
SELECT o.o_custkey, o_orderkey, o_totalprice, c.*
FROM (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey, o_orderkey, o_totalprice FROM orders) o
FULL JOIN customer c ON o.o_custkey = c.c_custkey""",
    "join_viability": """
SELECT CASE WHEN lu AND ru THEN '1:1' WHEN lu THEN '1:N' WHEN ru THEN 'N:1' ELSE 'N:N' END AS cardinality,
       left_rows, right_rows, left_missing_keys, right_missing_keys, lu OR ru AS safe_to_join
FROM (SELECT count(*) AS left_rows, count(*) - count(c_custkey) AS left_missing_keys,
             count(*) = count(DISTINCT c_custkey) AS lu FROM customer),
     (SELECT count(*) AS right_rows, count(*) - count(o_custkey) AS right_missing_keys,
             count(*) = count(DISTINCT o_custkey) AS ru FROM orders)""",
    "join_projected_rows": """
SELECT CASE WHEN lu AND ru THEN '1:1' WHEN lu THEN '1:N' WHEN ru THEN 'N:1' ELSE 'N:N' END AS cardinality,
       lu OR ru AS safe_to_join,
       (SELECT count(*) FROM customer JOIN supplier ON c_nationkey = s_nationkey) AS inner_rows,
       (SELECT count(*) FROM customer LEFT JOIN supplier ON c_nationkey = s_nationkey) AS left_join_rows,
       (SELECT count(*) FROM customer RIGHT JOIN supplier ON c_nationkey = s_nationkey) AS right_join_rows,
       (SELECT count(*) FROM customer FULL JOIN supplier ON c_nationkey = s_nationkey) AS outer_rows
FROM (SELECT count(*) = count(DISTINCT c_nationkey) AS lu FROM customer),
     (SELECT count(*) = count(DISTINCT s_nationkey) AS ru FROM supplier)""",
    "join_refusals": """
WITH repeated AS (SELECT (SELECT count(*) > count(DISTINCT c_nationkey) FROM customer) AS cn, (SELECT count(*) > count(DISTINCT s_nationkey) FROM supplier) AS sn,
                         (SELECT count(*) > count(DISTINCT c_custkey) FROM customer) AS cc, (SELECT count(*) > count(DISTINCT o_custkey) FROM orders) AS oc)
SELECT 'c_nationkey' AS left_on, 's_nationkey' AS right_on, CASE WHEN cn AND sn THEN 'many_to_many' END AS refused FROM repeated
UNION ALL SELECT 'c_custkey', 'o_custkey', CASE WHEN cc AND oc THEN 'many_to_many' END FROM repeated
UNION ALL SELECT 'o_orderpriority', 'c_custkey', 'incompatible_types'""",
    "join_key_counts": """
SELECT key, CAST(sum(l) AS BIGINT) AS in_left, CAST(sum(r) AS BIGINT) AS in_right
FROM (SELECT c_custkey AS key, 1 AS l, 0 AS r FROM customer UNION ALL SELECT o_custkey, 0, 1 FROM orders)
GROUP BY key""",
    "join_then_groupby": _groupby(
        "n_name", "c_acctbal", "sum", "customer JOIN nation ON c_nationkey = n_nationkey"
    ),
    "value_overlap": """
WITH l AS (SELECT DISTINCT c_custkey AS v FROM customer), r AS (SELECT DISTINCT user_id AS v FROM events)
SELECT left_values, right_values, shared_values,
       round(shared_values / (left_values + right_values - shared_values), 3) AS value_overlap
FROM (SELECT (SELECT count(*) FROM l) AS left_values, (SELECT count(*) FROM r) AS right_values,
             (SELECT count(*) FROM l JOIN r ON l.v = r.v) AS shared_values)""",
    "name_similarity": f"""
SELECT p_partkey, CAST({_similarity('p_name', 'p_type')} AS DOUBLE) AS name_type,
       CAST({_similarity('p_type', 'p_brand')} AS DOUBLE) AS type_brand,
       CAST({_similarity('p_name', 'p_brand')} AS DOUBLE) AS name_brand FROM part""",
    "score_key_pair": "WITH "
    + _edges({"customer": [("c_custkey", "n")], "orders": [("o_custkey", "n")]})
    + """
SELECT left_column, right_column, name_similarity, value_overlap, confidence, cardinality, safe_to_join FROM edges""",
    "relationships": f"WITH {_edges(_RELATED)} SELECT {_EDGE_COLUMNS} FROM edges WHERE confidence >= 0.1",
    "relationships_of_one": f"""WITH {_edges(_RELATED)} SELECT {_EDGE_COLUMNS} FROM edges
WHERE confidence >= 0.4 AND 'nation' IN (left_dataset, right_dataset)""",
    "schema_graph": f"""WITH {_edges(_RELATED)}
SELECT left_dataset, left_column, right_dataset, right_column, cardinality,
       CAST(floor(confidence * 100) AS INTEGER) AS match_percentage
FROM edges WHERE confidence >= 0.5""",
    "findings": _findings(),
    "chart_category": 'SELECT "group" AS x, value AS y FROM ('
    + _groupby("p_brand", "p_retailprice", "mean", "part")
    + ') ORDER BY value DESC, "group" LIMIT 5',
    "chart_time": f"""
SELECT b AS x, round(value, 4) AS y
FROM ({_series('o_orderdate', 'cents', 'quarter', 'mean', _CENTS)})""",
    "chart_points": f"""
WITH {_GAPS} SELECT o_custkey AS x, price AS y FROM gaps WHERE o_custkey IS NOT NULL AND price IS NOT NULL""",
    "chart_points_by_date": "SELECT o_orderdate AS x, o_totalprice AS y FROM orders WHERE o_orderdate IS NOT NULL AND o_totalprice IS NOT NULL",
    "chart_visible_line": _visible_line("orders", "o_orderdate", "epoch_us(o_orderdate)", "o_totalprice", 300),
    "chart_visible_line_of_numbers": "SELECT x, y FROM ("
    + _visible_line("lineitem", "l_extendedprice", "l_extendedprice", "l_orderkey", 100) + ")",
    "chart_histogram": """
SELECT CAST(bin AS INTEGER) AS bin, round(lo + bin * w, 4) AS lower,
       round(CASE WHEN bin = 19 THEN hi ELSE lo + (bin + 1) * w END, 4) AS upper, count
FROM (SELECT least(floor((o_totalprice - lo) / w), 19) AS bin, lo, hi, w, count(*) AS count
      FROM orders, (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi,
                           (max(o_totalprice) - min(o_totalprice)) / 20 AS w FROM orders)
      GROUP BY bin, lo, hi, w)""",
    "chart_histogram_categories": """
SELECT o_orderpriority AS x, count(*) AS count FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY x""",
    "chart_box": """
WITH b AS (SELECT l_returnflag AS x, quantile_cont(l_extendedprice, 0.25) AS q25,
                  quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.75) AS q75
           FROM lineitem GROUP BY x),
r AS (SELECT b.*, l_extendedprice AS v, l_extendedprice BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25) AS ok
      FROM lineitem JOIN b ON l_returnflag = x)
SELECT x, count(*) AS count, round(min(v), 4) AS min, round(max(q25), 4) AS q25, round(max(median), 4) AS median,
       round(max(q75), 4) AS q75, round(max(v), 4) AS max, round(min(v) FILTER (ok), 4) AS lower_whisker,
       round(max(v) FILTER (ok), 4) AS upper_whisker, count(*) FILTER (NOT ok) AS outlier_count
FROM r GROUP BY x""",
    "chart_multi_series": """
SELECT 'customer: c_acctbal' AS series, CAST(c_nationkey AS VARCHAR) AS x, c_acctbal AS y FROM customer
UNION ALL SELECT 'suppliers', CAST(s_nationkey AS VARCHAR), s_acctbal FROM supplier""",
}


ORACLE: dict[str, str] = dict(_QUERIES)
