"""Movie affinity and recommendation from ratings (M1-M9).

Ratings are (user, item, rating).  Item-item similarity is a self-join of
ratings on the user followed by a sum per item pair (partially aggregated
before the shuffle); recommendations join a user's ratings to the
similarity (or rule) table on the item, remove seen items with an anti-join
and keep the top n per user with ``row_number`` directly above the window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.operators import affinity as A
from quarry.operators.prefix import dense_index
from quarry.operators.skew import HOT_KEY_ROWS, hot_split_join
from quarry.session import cut_lineage, partition_for_expansion

TIE_DIGITS = 9


def ratings(facts: DataFrame, user: str = "user", item: str = "item", value: str = "rating",
            extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """M1: one rating per (user, item [, extra keys]): the mean of its events."""
    return facts.groupBy(F.col(user).alias("user"), F.col(item).alias("item"), *extra_keys) \
        .agg(F.avg(value).alias("rating"))


def favourites(r: DataFrame, min_rating: float) -> DataFrame:
    """M2: ratings above ``min_rating`` as baskets (basket = user)."""
    return A.baskets(r.where(F.col("rating") > min_rating), "user", "item")


def item_similarity(r: DataFrame, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """M5: cosine similarity of item rating vectors over co-rating users.

    Norms are over every rating of the item (not only co-rated users); an
    item with zero ratings only has similarity 0 to all others.
    The self-join on the user runs on one hash partitioning by user; a user
    with more than ``hot_rows`` ratings is salted (see ``skew``).
    Output: item_a < item_b, n_common, similarity.
    """
    r = partition_for_expansion(r.select("user", "item", "rating"), "user")
    # one row per item, materialised: feeds the denominators and bounds the
    # ratings any single user can have (one per item)
    norms = cut_lineage(r.groupBy("item").agg(F.sqrt(F.sum(F.col("rating") * F.col("rating"))).alias("norm")))
    x = r.select("user", F.col("item").alias("item_a"), F.col("rating").alias("ra"))
    y = r.select("user", F.col("item").alias("item_b"), F.col("rating").alias("rb"))
    dots = (hot_split_join(x, y, "user", lambda c, l, rr: c(f"{l}.item_a") < c(f"{rr}.item_b"),
                           "item_a", "item_b", hot_rows, norms.count())
            .groupBy("item_a", "item_b")
            .agg(F.count("*").alias("n_common"), F.sum(F.col("ra") * F.col("rb")).alias("dot")))
    na = norms.select(F.col("item").alias("item_a"), F.col("norm").alias("norm_a"))
    nb = norms.select(F.col("item").alias("item_b"), F.col("norm").alias("norm_b"))
    return (dots.join(na, "item_a").join(nb, "item_b")
            .select("item_a", "item_b", "n_common",
                    F.coalesce(F.try_divide("dot", F.col("norm_a") * F.col("norm_b")), F.lit(0.0)).alias("similarity")))


def _top_n(df: DataFrame, score: str, n: int) -> DataFrame:
    w = Window.partitionBy("user").orderBy(F.round(score, TIE_DIGITS).desc(), F.col("item").asc())
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def recommend_by_rules(fav: DataFrame, rules: DataFrame, seen: DataFrame, n: int) -> DataFrame:
    """M6: top n unseen consequents per user by best rule confidence.

    fav: (basket=user, item); rules: (antecedent, consequent, confidence);
    seen: (user, item) already rated.
    """
    cand = (fav.join(rules, fav.item == rules.antecedent)
            .select(F.col("basket").alias("user"), F.col("consequent").alias("item"), "confidence"))
    cand = cand.join(seen.select("user", "item"), ["user", "item"], "left_anti")
    best = cand.groupBy("user", "item").agg(F.max("confidence").alias("confidence"))
    return _top_n(best, "confidence", n)


def recommend_by_items(r: DataFrame, sims: DataFrame, n: int) -> DataFrame:
    """M7: score(u, i) = Σ_j sim(i, j)·r(u, j) / Σ_j |sim(i, j)| over the items j
    the user rated; unseen items only; top n per user (ties by item).

    ``r`` should be hash-partitioned by user.  The similarity table is
    materialised: AQE broadcasts it by its measured size, or joins on the item
    and splits hot items.  The user's own ratings enter the scoring aggregate
    flagged as seen, in place of an anti-join.
    """
    both = cut_lineage(sims).select(F.explode(F.array(
        F.struct(F.col("item_a").alias("j"), F.col("item_b").alias("i"), "similarity"),
        F.struct(F.col("item_b").alias("j"), F.col("item_a").alias("i"), "similarity"))).alias("s")
    ).select("s.*")
    rated = r.select("user", F.col("item").alias("j"), "rating")
    contrib = rated.join(both, "j").select(
        "user", F.col("i").alias("item"),
        (F.col("similarity") * F.col("rating")).alias("num"),
        F.abs("similarity").alias("den"), F.lit(0).alias("seen"))
    own = r.select("user", "item", F.lit(0.0).alias("num"), F.lit(0.0).alias("den"), F.lit(1).alias("seen"))
    agg = (contrib.unionByName(own).groupBy("user", "item")
           .agg(F.sum("num").alias("num"), F.sum("den").alias("den"), F.max("seen").alias("seen")))
    sc = agg.where((F.col("seen") == 0) & (F.col("den") > 0)) \
        .select("user", "item", (F.col("num") / F.col("den")).alias("score"))
    return _top_n(sc, "score", n)


def hit_rate(recs: DataFrame, holdout: DataFrame, n: int) -> DataFrame:
    """M8: hits of the top-n lists in the holdout favourites.

    Users with at least one holdout favourite are evaluated; precision@n =
    hits / (users × n), recall@n = hits / holdout favourites, both 0 if the
    holdout is empty.
    """
    hold = cut_lineage(holdout.select("user", "item").distinct())
    users = hold.select("user").distinct()
    hits = recs.join(hold, ["user", "item"]).join(users, "user", "left_semi")
    n_users = users.select(F.count("*")).scalar()
    n_hold = hold.select(F.count("*")).scalar()
    return hits.agg(F.count("*").alias("hits")).select(
        n_users.alias("users"), "hits",
        F.coalesce(F.try_divide(F.col("hits"), n_users * n), F.lit(0.0)).alias("precision_at_n"),
        F.coalesce(F.try_divide(F.col("hits"), n_hold), F.lit(0.0)).alias("recall_at_n"))


def fit_als(r: DataFrame, rank: int = 5, iters: int = 3, n: int = 5, seed: int = 42) -> DataFrame:
    """M9: ALS factor model; top n unseen items per user (user, item, rank, score).

    ALS needs int ids, so users and items are numbered densely by joins; no
    label list reaches the driver.  The model is asked for n items more than
    any user has rated, and rated ones are removed before the top n.
    """
    from pyspark.ml.recommendation import ALS

    users = cut_lineage(dense_index(r, "user", "uid"))
    items = cut_lineage(dense_index(r, "item", "iid"))
    data = cut_lineage(r.join(users, "user").join(items, "item").select(
        F.col("uid").cast("int").alias("uid"), F.col("iid").cast("int").alias("iid"), "rating"))
    als = ALS(rank=rank, maxIter=iters, seed=seed, userCol="uid", itemCol="iid", ratingCol="rating",
              coldStartStrategy="drop", nonnegative=True)
    most = data.groupBy("uid").count().agg(F.max("count")).first()[0] or 0
    recs = (als.fit(data).recommendForAllUsers(n + most)
            .select("uid", F.explode("recommendations").alias("rec"))
            .select("uid", F.col("rec.iid").alias("iid"), F.col("rec.rating").alias("score"))
            .join(data.select("uid", "iid"), ["uid", "iid"], "left_anti"))
    named = (recs.join(users.withColumn("uid", F.col("uid").cast("int")), "uid")
             .join(items.withColumn("iid", F.col("iid").cast("int")), "iid").select("user", "item", "score"))
    return _top_n(named, "score", n).select("user", "item", "rank", "score")
