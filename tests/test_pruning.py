"""Cost-complexity pruning against the weakest link taken one at a time."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from quarry.operators import pruning as P
from quarry.operators import tree as T


def weakest_links(errors, inner):
    """[(alpha, leaves as a set)]: collapse every node of the least price per leaf saved, over and over."""
    inner = set(inner)

    def leaves(n):
        return leaves(2 * n) + leaves(2 * n + 1) if n in inner else [n]

    def price(n):
        under = leaves(n)
        return Fraction(errors[n] - sum(errors[i] for i in under), len(under) - 1)

    def cut(n):
        inner.discard(n)
        for i in [i for i in inner if bin(i).startswith(bin(n))]:
            inner.discard(i)

    out = {}
    while True:
        while inner and min(map(price, inner)) <= 0:  # from the bottom, so that nothing of use is lost
            cut(max(n for n in inner if price(n) <= 0))
        if not out:
            out[Fraction(0)] = set(leaves(1))
        if not inner:
            return sorted(out.items())
        alpha = min(map(price, inner))
        while inner and min(map(price, inner)) <= alpha:
            cut(max(n for n in inner if price(n) <= alpha))
        out[alpha] = set(leaves(1))


@pytest.fixture(scope="module")
def grown(spark):
    rng = random.Random(4)
    rows = [(i, rng.randrange(12) * 1.0, rng.randrange(12) * 1.0) for i in range(600)]
    rows = [(i, a, b, int((a > 5) != (b > 7)) if rng.random() < 0.8 else rng.randrange(2)) for i, a, b in rows]
    df = spark.createDataFrame(rows, "id long, a double, b double, y int")
    train, test = df.where("id % 3 <> 0").cache(), df.where("id % 3 = 0").cache()
    nodes = T.fit_levelwise(train, ["a", "b"], 5, "gini", [0, 1])
    return train, test, P.cut_lineage(nodes)


def test_sequence_is_that_of_the_weakest_links(spark, grown):
    train, test, nodes = grown
    leaf_train, leaf_test = (T.route(d, nodes, ["a", "b"]).select("node", "y").cache() for d in (train, test))
    table = {r["node"]: r for r in nodes.collect()}

    def errors(rows):
        return {n: sum(r["y"] != table[n]["prediction"] for r in rows if bin(r["node"]).startswith(bin(n))) for n in table}

    on_train, on_test = errors(leaf_train.collect()), errors(leaf_test.collect())
    expect = weakest_links(on_train, [n for n, r in table.items() if r["feature"] is not None])
    got = sorted(tuple(r) for r in P.prune_sequence(nodes, leaf_train, leaf_test).collect())
    assert len(expect) > 3
    assert [g[0] for g in got] == [float(a) for a, _ in expect]
    assert [g[1:4] for g in got] == [(len(s), sum(on_train[n] for n in s), sum(on_test[n] for n in s)) for _, s in expect]
    best = min(got, key=lambda g: (g[3], -g[0]))
    assert [g for g in got if g[4]] == [best]

    cut = P.pruned(nodes, leaf_train, best[0])
    assert {r["node"] for r in cut.where("feature IS NULL").collect()} == dict((float(a), s) for a, s in expect)[best[0]]
    wrong = T.route(test, cut, ["a", "b"]).where(F.col("y") != F.col("prediction")).count()
    assert wrong == best[3]


def test_stump_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 1.0, 0), (2, 2.0, 0), (3, 3.0, 1), (4, None, 1)], "id long, x double, y int")
    nodes = T.fit_levelwise(df, ["x"], 0, "gini", [0, 1])
    routed = T.route(df, nodes, ["x"]).select("node", "y")
    assert [tuple(r) for r in P.prune_sequence(nodes, routed, routed.where("false")).collect()] == [(0.0, 1, 2, 0, True)]
    assert P.prune_sequence(nodes.where("false"), routed, routed).count() == 0
    unlabelled = routed.unionByName(spark.createDataFrame([(None, 1), (1, None)], "node long, y int"))
    assert P.prune_sequence(nodes, unlabelled, routed).first()["train_errors"] == 2
