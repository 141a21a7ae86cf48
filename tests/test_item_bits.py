"""Bitmap itemsets against counting subsets; closed and maximal by definition."""

import itertools
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import affinity as A
from quarry.operators import item_bits as I
from quarry.session import cut_lineage

SCHEMA = "basket string, item string, extra int"


def plain(rows, least):
    baskets: dict = {}
    for b, i, *_ in rows:
        if b is not None and i is not None:
            baskets.setdefault(b, set()).add(i)
    n = Counter(s for items in baskets.values() for k in range(1, len(items) + 1)
                for s in itertools.combinations(sorted(items), k))
    return {s: c for s, c in n.items() if c >= least}


def rows_of(seed):
    rng = np.random.default_rng(seed)
    rows = [(f"b{b}", f"i{i}", 1) for b in range(80) for i in range(9) if rng.random() < 0.4 + 0.05 * i]
    rows += [(f"b{b}", "always-with-i8", 2) for b, i, _ in ((r[0][1:], r[1], 0) for r in rows) if i == "i8"]
    return rows + rows[:20] + [(None, "i1", 1), ("b1", None, 1), ("big", None, 1)] + [("big", f"i{i}", 3) for i in range(9)]


@pytest.mark.parametrize("least", [8, 25])
def test_itemsets_and_closure(spark, least):
    rows = rows_of(4)
    sets = I.itemsets_bits(spark.createDataFrame(rows, SCHEMA), least)
    expect = plain(rows, least)
    assert {tuple(r["items"]): (r["k"], r["n"]) for r in sets.collect()} == {s: (len(s), n) for s, n in expect.items()}
    assert max(map(len, expect)) > 3
    got = I.closed(sets).collect()
    assert len(got) == len({tuple(r["items"]) for r in got})
    above = {s: [n for t, n in expect.items() if set(s) < set(t)] for s in expect}
    assert {(tuple(r["items"]), r["n"], r["maximal"]) for r in got} == {
        (s, n, not above[s]) for s, n in expect.items() if n not in above[s]}
    assert len(got) < len(expect)


def test_hot_prefixes_are_split(spark):
    rows = rows_of(5)
    got = I.itemsets_bits(spark.createDataFrame(rows, SCHEMA), 20, hot_rows=2)
    assert {tuple(r["items"]): r["n"] for r in got.collect()} == plain(rows, 20)


def test_more_baskets_than_a_part(spark):
    """Intersections over several parts of 32,768 baskets, one item absent from a part."""
    b = spark.range(70_000).selectExpr("id AS basket", "explode(filter(array('a', if(id % 2 = 0, 'b', null), "
                                       "if(id % 3 = 0, 'c', null), if(id > 40000, 'd', null)), x -> x IS NOT NULL)) AS item")
    got = {tuple(r["items"]): r["n"] for r in I.itemsets_bits(b, 1).collect()}
    late = [i for i in range(40001, 70000)]
    assert got[("a", "b", "c")] == len(range(0, 70_000, 6)) and len(got) == 15
    assert got[("a", "b", "c", "d")] == sum(i % 6 == 0 for i in late) and got[("b", "d")] == sum(i % 2 == 0 for i in late)


def test_empty_and_bounds(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert I.itemsets_bits(none, 1).count() == 0 and I.closed(I.itemsets_bits(none, 1)).count() == 0
    with pytest.raises(ValueError):
        I.itemsets_bits(none, 0)
    one = spark.createDataFrame([("b", "x", 1)], SCHEMA)
    assert [tuple(r) for r in I.closed(A.itemsets(A.baskets(one, "basket", "item"), 1)).collect()] == [(["x"], 1, 1, True)]


def test_bitmaps_are_dealt_by_part(spark):
    """A task holds a few parts, however well their bitmaps compress."""
    sets = spark.createDataFrame([(["a", "b"], ["a"], ["b"])], "items array<string>, left array<string>, right array<string>")
    bits = spark.range(300).select(F.explode(F.array(F.array(F.lit("a")), F.array(F.lit("b")))).alias("items"), F.col("id").alias("part"),
                                   F.lit(b"\x01" + bytes(4095)).alias("bits"))
    got = I.intersect(cut_lineage(sets), bits, 300)
    assert got.count() == 300
    assert "hashpartitioning(part" in (plan := got._jdf.queryExecution().executedPlan().toString())
    assert any("hashpartitioning(part" in line and ", 300)" in line for line in plan.splitlines())
    assert not any("Exchange hashpartitioning(items" in line for line in plan.splitlines())
