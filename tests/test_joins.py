import itertools
import random

import pytest
from pyspark.sql import functions as F

import tabscope as ts
from conftest import one, records, refused
from tabscope.functions.names import similar_names
from tabscope.operators import joins, values
from tabscope.operators.joins import join_tables
from tabscope.operators.relationships import schema_graph


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(
        [(1, "Alice", "New York"), (2, "Bob", "London"), (3, "Charlie", "Paris")],
        "customer_id bigint, name string, city string",
    )


@pytest.fixture(scope="module")
def profiles(spark):
    return spark.createDataFrame([(1, "Gold"), (2, "Silver"), (3, "Bronze")], "customer_id bigint, loyalty_tier string")


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame(
        [(101, 1, 50.0), (102, 1, 75.0), (103, 2, 120.0), (104, 3, 200.0)],
        "order_id bigint, customer_id bigint, amount double",
    )


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "Widget"), (1, "Gadget"), (2, "Doohickey"), (2, "Thingamajig")]
    return spark.createDataFrame(rows, "customer_id bigint, item_name string")


def test_cardinalities(customers, profiles, orders, items):
    def cardinality(left, right):
        facts = one(ts.inspect_join_viability(left, right, "customer_id", "customer_id"))
        return facts["cardinality"], facts["safe_to_join"]

    assert cardinality(customers, profiles) == ("1:1", True)
    assert cardinality(customers, orders) == ("1:N", True)
    assert cardinality(orders, customers) == ("N:1", True)
    assert cardinality(orders, items) == ("N:N", False)


def test_join_sizes(customers, profiles, orders):
    assert ts.execute_join(customers, profiles, "customer_id", "customer_id").columns == [
        "customer_id", "name", "city", "loyalty_tier",
    ]
    assert ts.execute_join(customers, orders, "customer_id", "customer_id").count() == 4
    assert ts.execute_join(orders, customers, "customer_id", "customer_id").count() == 4


def test_refused_joins(spark, customers, orders, items):
    other = spark.createDataFrame([("1", "A")], "customer_id string, notes string")
    checks = [
        ((orders, items, "customer_id", "customer_id"), {}, "many_to_many"),
        ((customers, orders, "customer_id", "customer_id"), {"max_rows": 2}, "too_many_rows"),
        ((customers, orders, "customer_id", "customer_id", "diagonal"), {}, "bad_join_type"),
        ((customers, other, "customer_id", "customer_id"), {}, "incompatible_types"),
        ((customers, orders, "nope", "customer_id"), {}, "unknown_column"),
        ((customers, orders, "customer_id", "nope"), {}, "unknown_column"),
    ]
    for args, options, message in checks:
        with refused(message):
            ts.execute_join(*args, **options)
    with refused("incompatible_types"):
        ts.inspect_join_viability(customers, other, "customer_id", "customer_id")


def test_integer_widths_are_compatible(spark, customers):
    narrow = spark.createDataFrame([(1, "x")], "customer_id int, y string")
    assert ts.execute_join(customers, narrow, "customer_id", "customer_id").count() == 1


def merged(left, right, how):
    """Brute force: missing keys match each other."""
    out = []
    for a in left:
        hits = [b for b in right if a[0] == b[0]]
        out += [(a[0], a[1], b[1]) for b in hits]
        if not hits and how in ("left", "outer"):
            out.append((a[0], a[1], None))
    if how in ("right", "outer"):
        out += [(b[0], None, b[1]) for b in right if all(a[0] != b[0] for a in left)]
    return sorted(out, key=str)


ONE = [(1, "a"), (2, "b"), (None, "n"), (5, "e")]
MANY = [(1, "p"), (1, "q"), (3, "r"), (None, "s"), (None, "t")]


@pytest.mark.parametrize("how", ["inner", "left", "right", "outer"])
@pytest.mark.parametrize("left, right", [(ONE, MANY), (MANY, ONE), (ONE, ONE)])
def test_joins_against_brute_force(spark, how, left, right):
    l = spark.createDataFrame(left, "k bigint, v string")
    r = spark.createDataFrame(right, "k bigint, v string")
    joined = ts.execute_join(l, r, "k", "k", how)
    assert joined.columns == ["k", "v_x", "v_y"]
    want = merged(left, right, how)
    assert sorted(records(joined), key=str) == want
    facts = one(ts.inspect_join_viability(l, r, "k", "k"))
    assert facts["inner_rows" if how == "inner" else "outer_rows" if how == "outer" else f"{how}_join_rows"] == len(want)


def test_different_key_names_both_stay(spark):
    l = spark.createDataFrame([(1, 10), (2, 20)], "id bigint, ref bigint")
    r = spark.createDataFrame([(10, 7)], "ref bigint, id bigint")
    joined = ts.execute_join(l, r, "ref", "ref", "outer")
    assert joined.columns == ["id_x", "ref", "id_y"]
    crossed = ts.execute_join(l, r, "ref", "id", "outer")
    assert crossed.columns == ["id_x", "ref_x", "ref_y", "id_y"]
    assert sorted(records(crossed), key=str) == [(1, 10, None, None), (2, 20, None, None), (None, None, 10, 7)]


def test_float_keys_treat_nan_as_missing(spark):
    l = spark.createDataFrame([(1.0, "a"), (float("nan"), "b")], "k double, v string")
    r = spark.createDataFrame([(None, "c"), (2.0, "d")], "k double, w string")
    rows = records(ts.execute_join(l, r, "k", "k"), "v", "w")
    assert rows == [("b", "c")]


def test_many_side_is_the_streamed_side(spark):
    """A hot key is on the side that adaptive execution may split, for every kind of join."""
    one_side, many = spark.range(50).toDF("k"), spark.range(500).select((F.col("id") % 50).alias("k"), "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how, (cardinality, left, right) in itertools.product(
            ("left", "right", "outer"), (("1:N", one_side, many), ("N:1", many, one_side))
        ):
            plan = join_tables(left, right, "k", "k", how, cardinality)._jdf.queryExecution().optimizedPlan().toString()
            assert "FullOuter" not in plan
            if cardinality == "1:N":
                assert "LeftOuter" not in plan
            else:
                assert "RightOuter" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("how", ["inner", "left", "right", "outer"])
def test_a_stated_cardinality_is_checked(spark, how):
    once = spark.createDataFrame(ONE, "k bigint, v string")
    often = spark.createDataFrame(MANY, "k bigint, w string")
    missing = spark.createDataFrame([(3, "x"), (None, "y"), (None, "z")], "k bigint, v string")
    for left, right, given in ((once, often, "1:N"), (often, once, "N:1")):
        stated = sorted(records(ts.execute_join(left, right, "k", "k", how, cardinality=given)), key=str)
        assert stated == sorted(records(ts.execute_join(left, right, "k", "k", how)), key=str)
    for left, right, given in ((once, often, "N:1"), (often, once, "1:N"), (once, often, "1:1"), (missing, often, "1:N")):
        with pytest.raises(Exception, match="many_to_many: 'k' repeats"):
            ts.execute_join(left, right, "k", "k", how, cardinality=given).collect()


@pytest.mark.parametrize("how", ["inner", "left", "right", "outer"])
@pytest.mark.parametrize("turned", [False, True])
def test_hot_keys_are_not_shuffled(spark, monkeypatch, how, turned):
    """Half the rows have one key, a quarter none: no task has over twice the rows of the median one."""
    monkeypatch.setattr(joins, "HOT_ROWS", 500)
    settings = {"spark.sql.shuffle.partitions": "8", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        many = spark.range(0, 8000, numPartitions=8).selectExpr("CASE WHEN id % 4 < 2 THEN 7 WHEN id % 4 = 2 THEN NULL ELSE id END AS k", "id AS n")
        few = spark.range(0, 6000).selectExpr("IF(id = 3, NULL, id) AS k", "id AS m")
        joined = ts.execute_join(few, many, "k", "k", how) if turned else ts.execute_join(many, few, "k", "k", how)
        sizes = sorted(r["count"] for r in joined.where("n IS NOT NULL").groupBy(F.spark_partition_id()).count().collect())
        hot = [x for x in sizes if x > 100]
        assert max(hot) <= 2 * hot[len(hot) // 2]
        got = {(r.k, r.n, r.m) for r in joined.collect()}
        rows = [(7 if n % 4 < 2 else None if n % 4 == 2 else n, n) for n in range(8000)]
        keys = {None if m == 3 else m: m for m in range(6000)}
        want = {(k, n, keys[k]) for k, n in rows if k in keys}
        kept = "right" if turned else "left"
        if how in ("outer", kept):
            want |= {(k, n, None) for k, n in rows if k not in keys}
        if how in ("outer", "left" if turned else "right"):
            want |= {(k, None, m) for k, m in keys.items() if k not in {key for key, _ in rows}}
        assert got == want and joined.count() == len(want)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_join_then_analyse(customers, orders):
    joined = ts.execute_join(customers, orders, "customer_id", "customer_id")
    facts = one(ts.statistics(joined, "amount"))
    assert (facts["count"], facts["min"], facts["max"]) == (4, 50.0, 200.0)
    assert ts.groupby_analysis(joined, "city", "amount", "sum").count() == 3


# --- relationships -------------------------------------------------------------


@pytest.fixture(scope="module")
def people(spark):
    rows = [(1, "Alice", "London"), (2, "Bob", "Paris"), (3, "Carol", "New York"), (4, "Dave", "Berlin"), (5, "Eve", "Tokyo")]
    return spark.createDataFrame(rows, "customer_id bigint, name string, city string")


@pytest.fixture(scope="module")
def sales(spark):
    rows = [(i, p, r) for i, p, r in zip(range(1, 6), ("Widget", "Gadget", "Doohickey", "Thing", "Gizmo"), (100.0, 250.0, 180.0, 320.0, 90.0))]
    return spark.createDataFrame(rows, "Cust_ID bigint, product string, revenue double")


def similarity(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    return df.select(ts.name_similarity(F.col("a"), F.col("b"))).first()[0]


def test_normalized_names(spark):
    names = {"id_customer": "customer", "customer_id": "customer", "cust_num": "cust", "Customer_ID": "customer"}
    for raw, want in names.items():
        df = spark.createDataFrame([(raw,)], "n string")
        assert df.select(ts.normalized_name(F.col("n"))).first()[0] == want


def test_name_similarity(spark):
    assert similarity(spark, "customer_id", "customer_id") == 1.0
    assert similarity(spark, " Customer_ID", "customer_id") == 1.0
    assert similarity(spark, "id_customer", "customerkey") == 0.95
    assert similarity(spark, "customer_id", "Cust_ID") == 0.75
    assert similarity(spark, "id", "key") == 0.0
    assert similarity(spark, "revenue", "birthday") < 0.5
    assert similarity(spark, "a", "b") == 0.0
    assert similarity(spark, "a", "ab") == 0.0
    assert similarity(spark, "night", "nacht") == 0.143


def overlap(spark, left, right, kinds=("bigint", "bigint"), **options):
    l = spark.createDataFrame([(v,) for v in left], f"a {kinds[0]}")
    r = spark.createDataFrame([(v,) for v in right], f"b {kinds[1]}")
    return one(ts.value_overlap(l, r, "a", "b", **options))["value_overlap"]


def test_value_overlap(spark):
    assert overlap(spark, [1, 2, 3, 3], [3, 2, 1]) == 1.0
    assert overlap(spark, [1, 2, 3], [100, 200]) == 0.0
    assert overlap(spark, [1, 2, None], [2, 3, 4]) == 0.25
    assert overlap(spark, [], [1, 2, 3]) == 0.0
    assert overlap(spark, ["a ", "b", ""], ["a", "b ", "c"], ("string", "string")) == 0.667
    assert overlap(spark, ["1", "2"], [1, 2], ("string", "bigint")) == 1.0
    long = "x" * 1000
    assert overlap(spark, [long + "a", "c"], [long + "b", "c"], ("string", "string")) == 0.333


def test_key_pair(people, sales, spark):
    pair = one(ts.score_key_pair(people, sales, "customer_id", "Cust_ID"))
    assert pair["confidence"] == 0.9 and pair["cardinality"] == "1:1" and pair["safe_to_join"]
    texts = spark.createDataFrame([("1",), ("2",)], "customer_id string")
    assert ts.score_key_pair(people, texts, "customer_id", "customer_id").isEmpty()
    constant = spark.createDataFrame([(1,), (1,)], "key bigint")
    assert ts.score_key_pair(constant, people, "key", "customer_id").isEmpty()
    with pytest.raises(ts.AnalysisError):
        ts.score_key_pair(people, sales, "nonexistent", "Cust_ID")


def test_uniqueness_of_keys(spark):
    def cardinality(left, right, kind="bigint"):
        l = spark.createDataFrame([(v,) for v in left], f"key {kind}")
        r = spark.createDataFrame([(v,) for v in right], f"key {kind}")
        return one(ts.score_key_pair(l, r, "key", "key"))["cardinality"]

    assert cardinality([1, 2, None], [1, 2, 3]) == "1:1"
    assert cardinality([1, 2, None, None], [1, 2, 3]) == "N:1"
    assert cardinality([1, 2], [1, 2, 2]) == "1:N"
    # Equal after trimming, but different keys.
    assert cardinality(["a", "a ", "b"], ["a", "b", "b"], "string") == "1:N"


NUMBERS = {
    "bigint": "id", "int": "CAST(id AS INT)", "double": "CAST(id AS DOUBLE)", "float": "CAST(id AS FLOAT)",
    "decimal": "CAST(id AS DECIMAL(20,4))", "whole": "CAST(id AS DECIMAL(30,0))",
}


@pytest.mark.parametrize("left,right", [("bigint", "double"), ("decimal", "int"), ("float", "whole"), ("double", "decimal")])
def test_equal_numbers_of_unlike_types(spark, left, right):
    ids = spark.range(-50, 50)
    a, b = ids.selectExpr(f"{NUMBERS[left]} AS key"), ids.selectExpr(f"{NUMBERS[right]} AS other")
    assert one(ts.value_overlap(a, b, "key", "other"))["value_overlap"] == 1.0
    assert one(ts.score_key_pair(a, b, "key", "other")) == {
        "left_column": "key", "right_column": "other", "name_similarity": 0.0, "value_overlap": 1.0, "confidence": 0.6, "cardinality": "1:1", "safe_to_join": True,
    }


def test_numbers_with_decimals(spark):
    decimals = spark.sql("SELECT CAST(v AS DECIMAL(36,16)) AS x FROM VALUES (0.1), (2.5), (0), (1000), (0.1234567891), (12345678901234567890.1) AS t(v)")
    doubles = spark.sql("SELECT CAST(v AS DOUBLE) AS y FROM VALUES ('0.1'), ('2.50'), ('-0.0'), ('1e3'), ('Infinity'), ('NaN'), ('0.1234567891'), ('12345678901234567890.1') AS t(v)")
    got = one(ts.value_overlap(decimals, doubles, "x", "y"))
    # The last decimal has more digits than a double; NaN is missing.
    assert (got["left_values"], got["right_values"], got["shared_values"]) == (6, 7, 5)


def test_times_meet_dates(spark):
    days = spark.sql("SELECT DATE'2024-03-01' + CAST(id AS INT) AS day FROM range(30)")
    times = spark.sql("SELECT CAST(DATE'2024-03-01' + CAST(id AS INT) AS TIMESTAMP_NTZ) AS at FROM range(30) UNION ALL SELECT TIMESTAMP_NTZ'2024-03-01 00:00:00.000001'")
    got = one(ts.value_overlap(days, times, "day", "at"))
    assert (got["left_values"], got["right_values"], got["shared_values"]) == (30, 31, 30)


def overlaps(datasets):
    """All pairs of columns that share a value, by trying each in plain Python."""
    frames = {n: [(f.name, values.comparable_family(f.dataType)) for f in df.schema.fields] for n, df in datasets.items()}
    cells = {n: [tuple(r) for r in df.collect()] for n, df in datasets.items()}

    def column(n, k):
        raw = [r[k] for r in cells[n] if r[k] is not None and r[k] == r[k]]
        return raw, {v.strip() if isinstance(v, str) else v for v in raw} - {""}

    out = set()
    order = list(datasets)
    for i, x in enumerate(order):
        for y in order[i + 1 :]:
            for a, (left, kind) in enumerate(frames[x]):
                for b, (right, other) in enumerate(frames[y]):
                    (ra, va), (rb, vb) = column(x, a), column(y, b)
                    if kind != other or len(set(ra)) < 2 or len(set(rb)) < 2:
                        continue
                    if va & vb:
                        out.add((x, left, y, right, round(len(va & vb) / len(va | vb), 3)))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_pruning_loses_no_shared_value(spark, seed):
    """Columns with few or no values in common, of mixed types: every pair that shares one is found."""
    r = random.Random(seed)

    def frame(n):
        kinds = [("bigint", lambda lo, w: r.randrange(lo, lo + w)), ("double", lambda lo, w: r.choice([float(r.randrange(lo, lo + w)), lo + r.randrange(8) / 8])), ("string", lambda lo, w: r.choice(["", " "]) + chr(97 + lo % 26) + str(r.randrange(w)))]
        chosen = [(*r.choice(kinds), r.randrange(0, 400, 40), r.choice([3, 30, 300])) for _ in range(7)]
        rows = [tuple(make(lo, w) if r.random() > 0.1 else None for _, make, lo, w in chosen) for _ in range(40)]
        return spark.createDataFrame(rows, ", ".join(f"{'qzxjkvw'[k]}{n} {kind}" for k, (kind, *_) in enumerate(chosen)))

    datasets = {f"t{n}": frame(n) for n in range(3)}
    found = ts.discover_relationships(datasets, min_confidence=0.0).collect()
    got = {(x.left_dataset, x.left_column, x.right_dataset, x.right_column, x.value_overlap) for x in found if x.value_overlap}
    assert {x for x in overlaps(datasets) if x[4]} == got


def test_disjoint_columns_are_not_read(spark):
    left = spark.sql("SELECT id AS a, 'left ' || id AS b, IF(id % 2 = 0, 'open', 'shut') AS c, 5000.5 + id AS d FROM range(100)")
    right = spark.sql("SELECT id + 1000 AS x, 'right ' || id AS y, IF(id % 2 = 0, 'blue', 'red') AS z, id + 50 AS a FROM range(100)")
    datasets = {"l": left, "r": right}
    catalog = values.catalog_of(datasets)
    found = values.sketches(datasets, catalog)
    chosen = values.with_partners(catalog, found)
    assert {(c.dataset, c.name) for c in catalog if c.number in chosen} == {("l", "a"), ("r", "a")}
    assert not any(found[c.number].surely_repeats for c in catalog)
    repeated = {"l": spark.sql("SELECT id % 7 AS a FROM range(100)"), "r": spark.sql("SELECT IF(id < 2, NULL, id) AS b FROM range(9)")}
    assert all(x.surely_repeats for x in values.sketches(repeated, values.catalog_of(repeated)).values())


@pytest.mark.parametrize("seed", range(2))
def test_names_meet_in_the_index(spark, seed):
    r = random.Random(seed)
    parts = ["id", "cust", "customer", "num", "key", "code", "order", "a", "b", "x1", "name", "_", "Total", "amt"]
    names = sorted({"".join(r.choice(parts) for _ in range(r.randrange(1, 4))) for _ in range(60)})
    rows = [(k, f"t{k % 3}", n, "text") for k, n in enumerate(names)]
    columns = spark.createDataFrame(rows, "number int, dataset string, name string, family string")
    met = {tuple(x) for x in similar_names(columns, 0.3).collect()}
    two = columns.alias("l").join(columns.alias("r"), F.expr("l.number < r.number AND l.dataset != r.dataset"))
    near = two.where(ts.name_similarity(F.col("l.name"), F.col("r.name")) >= 0.3).select("l.number", "r.number").collect()
    assert {tuple(x) for x in near} <= met and len(met) < 60 * 59 / 2


def test_wide_schemas(spark):
    """Columns by the hundreds: no list of pairs, masks of several words."""
    left = spark.range(4).select(*[(F.col("id") + 10 * i).alias(f"left{i:03d}q") for i in range(150)])
    right = spark.range(4).select(*[(F.col("id") + 10 * i).alias(f"zz{i:03d}") for i in range(150)])
    found = ts.discover_relationships({"a": left, "b": right}, min_confidence=0.5)
    assert {(r["left_column"], r["right_column"]) for r in found.collect()} == {(f"left{i:03d}q", f"zz{i:03d}") for i in range(150)}


def test_discovery(people, sales):
    tables = {"customers.csv": people, "sales.csv": sales}
    found = records(ts.discover_relationships(tables))
    assert found[0][:5] == ("customers.csv", "customer_id", "sales.csv", "Cust_ID", 0.9)
    low = [r[4] for r in records(ts.discover_relationships(tables, min_confidence=0.0))]
    assert low == sorted(low, reverse=True) and len(low) >= len(found)
    assert ts.discover_relationships(tables, min_confidence=0.99).isEmpty()
    with refused("too_few_datasets"):
        ts.discover_relationships({"customers.csv": people})
    with refused("unknown_dataset"):
        ts.discover_relationships(tables, target_dataset="other.csv")


def test_discovery_of_one_dataset(people, sales, profiles):
    tables = {"customers": people, "sales": sales, "profiles": profiles}
    found = records(ts.discover_relationships(tables, target_dataset="profiles", min_confidence=0.3))
    assert found and all("profiles" in (r[0], r[2]) for r in found)


def test_schema_graph(people, sales):
    edges = records(schema_graph({"c": people, "s": sales}))
    assert edges == [("c", "customer_id", "s", "Cust_ID", "1:1", 90)]


def test_discovery_over_many_columns(spark):
    """More columns than one bit mask holds."""
    left = spark.range(20).select(*[(F.col("id") + 1000 * i).alias(f"l{i}") for i in range(70)])
    right = spark.range(20).select(*[(F.col("id") + 1000 * i).alias(f"r{i}") for i in range(70)])
    found = ts.discover_relationships({"a": left, "b": right}, min_confidence=0.6)
    assert {(r["left_column"], r["right_column"]) for r in found.collect()} == {(f"l{i}", f"r{i}") for i in range(70)}
