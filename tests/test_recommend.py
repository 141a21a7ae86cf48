from tests.conftest import SF001
from pyspark.sql import functions as F
import pytest

from quarry.operators import recommend as M
from quarry.operators import evaluate as V


@pytest.fixture
def r(spark):
    data = [(1, "a", 5.0), (1, "b", 3.0), (2, "a", 4.0), (2, "c", 2.0), (3, "b", 1.0), (3, "c", 5.0)]
    return spark.createDataFrame(data, "user long, item string, rating double")


def test_cosine_uses_full_norms(r):
    s = {(x["item_a"], x["item_b"]): x["similarity"] for x in M.item_similarity(r).collect()}
    # a = (5, 4, 0), b = (3, 0, 1): dot 15, norms sqrt(41), sqrt(10)
    assert s[("a", "b")] == pytest.approx(15 / (41 ** 0.5 * 10 ** 0.5))


def test_recommendations_unseen_only(spark, r):
    recs = M.recommend_by_items(r, M.item_similarity(r), 5).collect()
    seen = {(x["user"], x["item"]) for x in r.collect()}
    assert recs and all((x["user"], x["item"]) not in seen for x in recs)
    # an item nobody rated is never recommended
    assert "zzz" not in {x["item"] for x in recs}


def test_hot_user_split_same_similarity(r):
    want = sorted(M.item_similarity(r).collect())
    assert sorted(M.item_similarity(r, hot_rows=1).collect()) == want


def test_metrics_zero_division(spark):
    pred = spark.createDataFrame([(1, 0, 0), (2, 0, 0)], "id long, actual int, predicted int")
    m = {x["label"]: x for x in V.class_metrics(pred).collect()}
    assert m[0]["precision"] == 1.0 and m[0]["accuracy"] == 1.0
    reg = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, 2.0)], "id long, actual double, predicted double")
    x = V.regression(reg).first()
    assert (x["rmse"], x["mae"], x["r2"]) == (1.0, 1.0, 0.0)


def test_all_zero_item_and_empty_holdout(spark):
    r = spark.createDataFrame([(1, "a", 0.0), (1, "b", 5.0), (2, "a", 0.0), (2, "b", 4.0)], "user long, item string, rating double")
    assert [x["similarity"] for x in M.item_similarity(r).collect()] == [0.0]
    recs = spark.createDataFrame([(1, "a", 1)], "user long, item string, rank int")
    got = M.hit_rate(recs, recs.where("false").select("user", "item"), 5).first()
    assert (got["users"], got["hits"], got["precision_at_n"], got["recall_at_n"]) == (0, 0, 0.0, 0.0)


def test_als_recommends_unseen_items(spark):
    from quarry.plans import recommend as PM

    r = PM._ratings(spark, SF001)
    big = r.select((F.col("user") + 2 ** 40).alias("user"), "item", "rating")  # beyond the int range
    recs = M.fit_als(big, n=3)
    assert recs.join(big, ["user", "item"], "left_semi").count() == 0
    got = recs.groupBy("user").agg(F.count("*").alias("n"), F.max("rank").alias("last")).collect()
    n_items = r.select("item").distinct().count()
    rated = {x["user"]: x["n"] for x in big.groupBy("user").agg(F.count("*").alias("n")).collect()}
    assert {x["user"]: x["n"] for x in got} == {u: min(3, n_items - k) for u, k in rated.items() if k < n_items}
    assert all(x["n"] == x["last"] for x in got)
