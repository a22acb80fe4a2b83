"""Values of several columns, reduced to the sets of columns that they occur in."""

from __future__ import annotations

import io
from collections import Counter, defaultdict
from contextlib import redirect_stdout

from tabscope.operators import values

EDGES = [-(2**63), 2**63 - 1, -65, -64, -1, 0, 63, 64, None]


def test_integers_are_grouped_as_bits_of_blocks(spark):
    one = spark.createDataFrame([(x, x % 7 if x is not None else None, float((x or 0) % 1000)) for x in [*EDGES, *range(-90, 90, 3)]], "a bigint, b int, c double")
    two = spark.createDataFrame([(x, 2.5) for x in [*EDGES, *range(-10, 200, 2)]], "d bigint, e double")
    datasets = {"one": one, "two": two}
    catalog = values.catalog_of(datasets)
    found = values.signatures(datasets, catalog)
    where = defaultdict(set)
    for c in catalog:
        for (x,) in datasets[c.dataset].select(c.name).dropna().collect():
            where[x].add(c.number)
    want = Counter(tuple(sorted(numbers)) for numbers in where.values())
    assert {tuple(r.members): r.n for r in found.collect()} == dict(want)
    assert all(r.members == r.plain for r in found.collect())
    with redirect_stdout(io.StringIO()) as plan:
        found.explain()
    assert "shiftright" in plan.getvalue()  # no row for each integer is shuffled where they are dense
