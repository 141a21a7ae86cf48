"""Split search and distinct counts from mergeable sketches, against the exact ones."""

import math

from pyspark.sql import functions as F

from quarry.operators import distinct as D
from quarry.operators import tree as T
from quarry.plans import movie_sql
from tests.conftest import SF001

TOLD = 2 * 0.004  # rank error of a sketch of size 800, on both sides


def test_sketched_splits_are_exact_between_near_thresholds(spark):
    n = 12_000
    rows = spark.range(0, n, 1, 16).select(
        F.lit(1).cast("long").alias("node"), F.rand(5).alias("even"), F.exp(F.randn(6) * 3).alias("long_tail"),
        (F.col("id") % 3).cast("double").alias("few"))
    rows = T.cut_lineage(rows.withColumn("y", ((F.col("even") > 0.37) & (F.col("long_tail") < 20)).cast("int")))
    features = ["even", "long_tail", "few"]
    exact = {(r["feature"], r["threshold"]): r for r in T.split_scores(rows, features, "gini", [0, 1]).collect()}
    got = T.sketched_scores(rows, features, "gini", [0, 1]).collect()
    for r in got:  # every score is the exact one of its threshold
        assert r.asDict() == exact[r["feature"], r["threshold"]].asDict()
    assert sorted(r["threshold"] for r in got if r["feature"] == "few") == [0.0, 1.0]
    for f in ("even", "long_tail"):
        ranks = sorted([0, n, *(r["n_left"] for r in got if r["feature"] == f)])
        assert len(ranks) <= T.BINS + 1
        assert max(b - a for a, b in zip(ranks, ranks[1:])) <= (1 / T.BINS + TOLD) * n
        best = max((r for r in exact.values() if r["feature"] == f), key=lambda r: r["gain"])
        near = max((r for r in got if r["feature"] == f), key=lambda r: r["gain"])
        within = [r["gain"] for r in exact.values() if r["feature"] == f and abs(r["n_left"] - best["n_left"]) <= (1 / T.BINS + TOLD) * n]
        assert min(within) <= near["gain"] <= best["gain"]


def test_sketched_tree_with_nulls_and_nothing(spark):
    rows = [(i, float(i) if i % 5 else None, int(i % 5 > 0 and i < 40)) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, x double, y int").withColumn("none", F.lit(None).cast("double"))
    fits = [T.fit_levelwise(df, ["x", "none"], 2, "gini", [0, 1], s).collect() for s in (T.split_scores, T.sketched_scores)]
    roots = [next(r for r in f if r["node"] == 1) for f in fits]
    assert roots[0]["feature"] == roots[1]["feature"] == "x"
    assert abs(roots[0]["threshold"] - roots[1]["threshold"]) <= 3  # 80 values, 64 thresholds
    root = df.withColumn("node", F.lit(1).cast("long"))
    assert T.sketched_scores(root.where("false"), ["x"], "gini", [0, 1]).count() == 0
    odd = root.where("id < 6").withColumn("x", F.when(F.col("id") == 3, F.lit(float("nan"))).otherwise(F.col("x")))
    sides = [sorted((r["n_left"], r["n_right"]) for r in s(odd, ["x"], "gini", [0, 1]).collect()) for s in (T.split_scores, T.sketched_scores)]
    assert sides[0] == sides[1]


def test_raters_roll_up(spark):
    got = {(r["level"], r["item"], r["month"]): r["n_raters"] for r in movie_sql.q_raters_rollup(spark, SF001).collect()}
    ev = movie_sql._with_item(spark, SF001, movie_sql._events(spark, SF001)).select("user", "item", F.date_format("rated_at", "yyyy-MM").alias("month"))
    exact = {}
    for level in (["item", "month"], ["item"], ["month"], []):
        for r in ev.groupBy(*level).agg(F.count_distinct("user").alias("n")).collect():
            exact[",".join(level), *(r[c] if c in level else None for c in ("item", "month"))] = r["n"]
    assert set(got) == set(exact)
    assert all(abs(got[k] - n) <= max(1, 4 * 0.0163 * n) for k, n in exact.items())


def test_roll_up_beyond_the_exact_range_and_odd_rows(spark):
    df = spark.range(60_000).select((F.col("id") % 20_000).alias("u"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("a"), F.col("id").alias("sketch"))
    cells = D.sketches(df, ["a"], "u")
    got = {(r["a"], r["level"]): r["n_distinct"] for r in D.roll_up(cells, [["a"], []], ["a"]).collect()}
    assert set(got) == {(None, "a"), (1, "a"), (2, "a"), (None, "")}
    assert all(math.isclose(n, 20_000, rel_tol=4 * 0.0163) for n in got.values())
    nobody = D.sketches(spark.createDataFrame([("x", None)], "a string, u string"), ["a"], "u")
    assert [tuple(r) for r in D.roll_up(nobody, [["a"]], ["a"]).collect()] == [("x", "a", 0)]
    assert D.roll_up(D.sketches(df.where("false"), ["a"], "u"), [["a"], []], ["a"]).count() == 0
