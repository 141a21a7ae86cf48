"""Recommendation plans: user = o_custkey, item = part title, rating = mean
line quantity of the user's order lines for that title (1..50)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import affinity as A
from quarry.operators import cosine_join as C
from quarry.operators import recommend as M
from quarry.session import cut_lineage, partition_for_expansion
from quarry.sources.tables import read_table

FAV_MIN = 40.0          # favourite = mean rating above 40 (five stars)
RULE_MIN_CONFIDENCE = 0.1
TOP_N = 5
MIN_COSINE = 0.2
FOLDS = 5


def _facts(spark, sf_dir, hold_out=False):
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_quantity"])
    od = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name"])
    extra = [(F.pmod(F.col("l_orderkey"), F.lit(FOLDS)) == 0).alias("hold")] if hold_out else []
    return (li.join(od, li.l_orderkey == od.o_orderkey).join(part, li.l_partkey == part.p_partkey)
            .select(F.col("o_custkey").alias("user"), F.col("p_name").alias("item"),
                    F.col("l_quantity").alias("rating"), *extra))


def _ratings(spark, sf_dir, materialise=False):
    r = M.ratings(_facts(spark, sf_dir))
    # rating cells feed norms, the user self-join, scoring and the seen
    # filter: materialise them once, then hash-partition by user (a checkpoint
    # does not keep partitioning); every consumer shares that one exchange
    return partition_for_expansion(cut_lineage(r), "user") if materialise else r


def q_ratings(spark, sf_dir):
    return _ratings(spark, sf_dir).select("user", "item", F.round("rating", 6).alias("rating"))


def q_favourites(spark, sf_dir):
    return M.favourites(_ratings(spark, sf_dir), FAV_MIN).withColumnRenamed("basket", "user")


def _favourites(spark, sf_dir):
    """Favourites for several consumers: read and aggregated once."""
    return cut_lineage(M.favourites(_ratings(spark, sf_dir), FAV_MIN))


def q_pairs(spark, sf_dir):
    return A.pair_counts(_favourites(spark, sf_dir))


def _part_facts(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_quantity"])
    od = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"), F.col("l_quantity").alias("rating"))


def _part_ratings(spark, sf_dir):
    """Ratings of single parts; a part belongs to one title."""
    return M.ratings(_part_facts(spark, sf_dir))


def q_part_pairs(spark, sf_dir):
    """M3 at part granularity: users favouring both parts (item = l_partkey).

    The part vocabulary exceeds the hot-key threshold, so this is the pair
    count that runs through the salted hot-key split path.
    """
    return A.pair_counts(cut_lineage(M.favourites(_part_ratings(spark, sf_dir), FAV_MIN)))


def _rules(fav):
    return A.pair_rules(fav, min_confidence=RULE_MIN_CONFIDENCE)


def q_rules(spark, sf_dir):
    return _rules(_favourites(spark, sf_dir))


def q_item_cosine(spark, sf_dir):
    s = M.item_similarity(_ratings(spark, sf_dir, materialise=True))
    return s.select("item_a", "item_b", "n_common", F.round("similarity", 6).alias("similarity"))


def q_similar_items(spark, sf_dir):
    """M5 at part granularity: the pairs of a cosine of ``MIN_COSINE`` or more."""
    # dealt by part once: means, lengths and heads are of a part's rows
    return C.similar_items(M.ratings(partition_for_expansion(_part_facts(spark, sf_dir), "item")), MIN_COSINE).select(
        "item_a", "item_b", "n_common", F.round("similarity", 6).alias("similarity"))


def q_recommend_rules(spark, sf_dir):
    r = _ratings(spark, sf_dir, materialise=True)
    fav = cut_lineage(M.favourites(r, FAV_MIN))
    recs = M.recommend_by_rules(fav, _rules(fav), r, TOP_N)
    return recs.select("user", "item", "confidence", "rank")


def q_recommend_items(spark, sf_dir):
    r = _ratings(spark, sf_dir, materialise=True)
    return M.recommend_by_items(r, M.item_similarity(r), TOP_N).select("user", "item", F.round("score", 6).alias("score"), "rank")


def q_hit_rate(spark, sf_dir):
    """Train on order lines with orderkey mod 5 != 0; holdout = favourites
    from the other lines that the user had not rated in training.  Both
    rating tables come from one scan and one aggregate keyed by the fold."""
    both = cut_lineage(M.ratings(_facts(spark, sf_dir, hold_out=True), extra_keys=("hold",)))
    train_r = partition_for_expansion(both.where(~F.col("hold")).drop("hold"), "user")
    recs = M.recommend_by_items(train_r, M.item_similarity(train_r), TOP_N)
    hold = both.where(F.col("hold") & (F.col("rating") > FAV_MIN)).drop("hold")
    hold = hold.join(train_r.select("user", "item"), ["user", "item"], "left_anti")
    return M.hit_rate(recs, hold, TOP_N)


def q_als(spark, sf_dir):
    return M.fit_als(_ratings(spark, sf_dir), n=TOP_N)


QUERIES = {
    "mov_ratings": q_ratings,
    "mov_favourites": q_favourites,
    "mov_pairs": q_pairs,
    "mov_part_pairs": q_part_pairs,
    "mov_rules": q_rules,
    "mov_item_cosine": q_item_cosine,
    "mov_similar_items": q_similar_items,
    "mov_recommend_rules": q_recommend_rules,
    "mov_recommend_items": q_recommend_items,
    "mov_hit_rate": q_hit_rate,
    "mov_als": q_als,
}


def _r_sql(name="r", where="TRUE"):
    return (f"{name} AS (SELECT o_custkey AS \"user\", p_name AS item, avg(l_quantity) AS rating "
            f"FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey "
            f"WHERE {where} GROUP BY 1, 2)")


_FAV = f"fav AS (SELECT DISTINCT \"user\" AS basket, item FROM r WHERE rating > {FAV_MIN})"
_RULES = f"""nb AS (SELECT count(DISTINCT basket) AS n FROM fav),
  it AS (SELECT item, count(*) AS n_item FROM fav GROUP BY item),
  pr AS (SELECT x.item AS antecedent, y.item AS consequent, count(*) AS n_ab FROM fav x JOIN fav y
         ON x.basket = y.basket AND x.item <> y.item GROUP BY 1, 2),
  rules AS (SELECT antecedent, consequent, n_ab, n_ab / nb.n AS support, n_ab / a.n_item AS confidence,
            n_ab * nb.n / (a.n_item * c.n_item) AS lift FROM pr JOIN it a ON pr.antecedent = a.item
            JOIN it c ON pr.consequent = c.item CROSS JOIN nb WHERE n_ab / a.n_item >= {RULE_MIN_CONFIDENCE})"""


def _sim_sql(r="r", name="sim"):
    return f"""{name}_n AS (SELECT item, sqrt(sum(rating * rating)) AS norm FROM {r} GROUP BY item),
  {name} AS (SELECT x.item AS item_a, y.item AS item_b, count(*) AS n_common,
    CASE WHEN na.norm * nb.norm = 0 THEN 0.0 ELSE sum(x.rating * y.rating) / (na.norm * nb.norm) END AS similarity
    FROM {r} x JOIN {r} y ON x."user" = y."user" AND x.item < y.item
    JOIN {name}_n na ON na.item = x.item JOIN {name}_n nb ON nb.item = y.item
    GROUP BY x.item, y.item, na.norm, nb.norm)"""


def _item_recs_sql(r="r", sim="sim", name="recs"):
    return f"""{name}_b AS (SELECT item_a AS j, item_b AS i, similarity FROM {sim}
    UNION ALL SELECT item_b AS j, item_a AS i, similarity FROM {sim}),
  {name}_s AS (SELECT "user", i AS item, sum(similarity * rating) / sum(abs(similarity)) AS score
    FROM {r} JOIN {name}_b ON {r}.item = {name}_b.j GROUP BY "user", i HAVING sum(abs(similarity)) > 0),
  {name} AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY "user" ORDER BY round(score, 9) DESC, item)
    AS INTEGER) AS rank FROM {name}_s s WHERE NOT EXISTS (SELECT 1 FROM {r} WHERE {r}."user" = s."user"
    AND {r}.item = s.item)) WHERE rank <= {TOP_N})"""


_PART_RATINGS = """rp AS (SELECT o_custkey AS "user", l_partkey AS item, avg(l_quantity) AS rating
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""

ORACLE = {
    "mov_ratings": f"WITH {_r_sql()} SELECT \"user\", item, round(rating, 6) AS rating FROM r",
    "mov_favourites": f"WITH {_r_sql()}, {_FAV} SELECT basket AS \"user\", item FROM fav",
    "mov_pairs": f"""WITH {_r_sql()}, {_FAV} SELECT x.item AS item_a, y.item AS item_b, count(*) AS n_ab
  FROM fav x JOIN fav y ON x.basket = y.basket AND x.item < y.item GROUP BY 1, 2""",
    "mov_part_pairs": f"""WITH {_PART_RATINGS},
  fav AS (SELECT DISTINCT "user" AS basket, item FROM rp WHERE rating > {FAV_MIN})
  SELECT x.item AS item_a, y.item AS item_b, count(*) AS n_ab
  FROM fav x JOIN fav y ON x.basket = y.basket AND x.item < y.item GROUP BY 1, 2""",
    "mov_rules": f"WITH {_r_sql()}, {_FAV}, {_RULES} SELECT * FROM rules",
    "mov_item_cosine": f"""WITH {_r_sql()}, {_sim_sql()} SELECT item_a, item_b, n_common,
  round(similarity, 6) AS similarity FROM sim""",
    "mov_similar_items": f"""WITH {_PART_RATINGS}, {_sim_sql('rp')} SELECT item_a, item_b, n_common,
  round(similarity, 6) AS similarity FROM sim WHERE similarity >= {MIN_COSINE}""",
    "mov_recommend_rules": f"""WITH {_r_sql()}, {_FAV}, {_RULES},
  cand AS (SELECT fav.basket AS "user", consequent AS item, max(confidence) AS confidence
    FROM fav JOIN rules ON fav.item = rules.antecedent
    WHERE NOT EXISTS (SELECT 1 FROM r WHERE r."user" = fav.basket AND r.item = rules.consequent)
    GROUP BY 1, 2)
  SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY "user" ORDER BY round(confidence, 9) DESC, item)
    AS INTEGER) AS rank FROM cand) WHERE rank <= {TOP_N}""",
    "mov_recommend_items": f"""WITH {_r_sql()}, {_sim_sql()}, {_item_recs_sql()}
  SELECT "user", item, round(score, 6) AS score, rank FROM recs""",
    "mov_hit_rate": f"""WITH {_r_sql('r', f'l_orderkey % {FOLDS} <> 0')}, {_r_sql('h', f'l_orderkey % {FOLDS} = 0')},
  {_sim_sql()}, {_item_recs_sql()},
  hold AS (SELECT DISTINCT "user", item FROM h WHERE rating > {FAV_MIN}
    AND NOT EXISTS (SELECT 1 FROM r WHERE r."user" = h."user" AND r.item = h.item)),
  hits AS (SELECT count(*) AS hits FROM recs JOIN hold USING ("user", item))
  SELECT (SELECT count(DISTINCT "user") FROM hold) AS users, hits,
    hits / ((SELECT count(DISTINCT "user") FROM hold) * {TOP_N}) AS precision_at_n,
    hits / (SELECT count(*) FROM hold) AS recall_at_n FROM hits""",
}
