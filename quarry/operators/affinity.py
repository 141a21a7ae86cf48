"""Affinity analysis: item support, pair rules, frequent itemsets (A1-A10).

Scale notes
-----------
* ``baskets`` removes duplicates by (basket, item) first, with a combine on
  the map side: a basket holding a third of all rows spreads over its items,
  and afterwards holds at most one row per item.
* A basket with many items would put its size² pairs in one task;
  ``hot_split_join`` salts such baskets while cold baskets join on the basket
  alone.  The split is skipped only when the (materialised) item table proves
  that no basket can exceed the threshold on either side.
  Items below the support threshold are removed *before* the self-join
  (support is anti-monotone), which bounds the pairs a hot basket can emit
  by the frequent-item count.
* The basket exchange of a self-join uses a fixed partition count: it
  multiplies rows, so AQE must not coalesce its small input into few tasks.
* The basket total N is a scalar subquery, evaluated once and inlined; no
  cross join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.operators.prefix import dense_index
from quarry.operators.skew import HOT_KEY_ROWS, hot_split_join
from quarry.session import cut_lineage, partition_for_expansion

# Separator used when an itemset is shown as one string (items sorted).  Only
# for output: itemsets are keyed by their arrays.
ITEM_SEP = "|"


def baskets(df: DataFrame, basket: str, item: str) -> DataFrame:
    """A1: distinct (basket, item) pairs; null items dropped."""
    return (df.select(F.col(basket).alias("basket"), F.col(item).alias("item"))
            .where(F.col("item").isNotNull() & F.col("basket").isNotNull())
            .dropDuplicates(["basket", "item"]))


def basket_total(b: DataFrame) -> Column:
    """Number of distinct baskets as a lazily evaluated scalar subquery."""
    return b.select(F.count_distinct("basket")).scalar()


def item_support(b: DataFrame) -> DataFrame:
    """A2: baskets per item and their share of all baskets."""
    n = basket_total(b)
    return (b.groupBy("item").agg(F.count("*").alias("n_item"))
            .select("item", "n_item",
                    (F.col("n_item") / n).alias("support")))


def frequent_items(b: DataFrame, min_count: int) -> DataFrame:
    counts = b.groupBy("item").agg(F.count("*").alias("n_item"))
    return counts.where(F.col("n_item") >= min_count) if min_count > 1 else counts


def item_counts(b: DataFrame, min_count: int = 1) -> DataFrame:
    """Items with their basket counts (>= min_count), materialised once.

    The table has one row per distinct item; it feeds the rule measures and
    its size bounds the rows any basket can hold after de-duplication.
    """
    return cut_lineage(frequent_items(b, min_count))


def basket_pairs(b: DataFrame, hot_rows: int = HOT_KEY_ROWS,
                 max_basket_rows: int | None = None) -> DataFrame:
    """(basket, item_a, item_b) for every unordered pair a < b of one basket."""
    b = partition_for_expansion(b, "basket")
    x = b.select("basket", F.col("item").alias("item_a"))
    y = b.select("basket", F.col("item").alias("item_b"))
    return hot_split_join(x, y, "basket", lambda c, l, r: c(f"{l}.item_a") < c(f"{r}.item_b"),
                          "item_a", "item_b", hot_rows, max_basket_rows)


def pair_counts(b: DataFrame, min_count: int = 1, hot_rows: int = HOT_KEY_ROWS,
                items: DataFrame | None = None) -> DataFrame:
    """A3: unordered pairs (a < b) in the same basket, with basket counts.

    Only items with at least ``min_count`` baskets can be in such a pair
    (support is anti-monotone), so the others are removed before the join.
    """
    items = items if items is not None else item_counts(b, min_count)
    if min_count > 1:
        items = items.where(F.col("n_item") >= min_count)
        b = b.join(items.select("item"), "item", "left_semi")
    pairs = (basket_pairs(b, hot_rows, max_basket_rows=items.count())
             .groupBy("item_a", "item_b").agg(F.count("*").alias("n_ab")))
    return pairs.where(F.col("n_ab") >= min_count) if min_count > 1 else pairs


def directed(pc: DataFrame) -> DataFrame:
    """Both directions of every unordered pair, from one pass (no union)."""
    return pc.select(F.explode(F.array(
        F.struct(F.col("item_a").alias("antecedent"), F.col("item_b").alias("consequent"), "n_ab"),
        F.struct(F.col("item_b").alias("antecedent"), F.col("item_a").alias("consequent"), "n_ab"))).alias("r")
    ).select("r.*")


def pair_rules(b: DataFrame, min_support: float = 0.0,
               min_confidence: float = 0.0, min_count: int = 1,
               hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """A4: directed rules a -> c with support, confidence and lift.

    All three are ratios of integer counts, computed as one IEEE division
    (no rounding), so they are exact to the last bit in any engine.
    """
    n = basket_total(b)
    items = item_counts(b)
    both = directed(pair_counts(b, min_count, hot_rows, items))
    ia = items.select(F.col("item").alias("antecedent"), F.col("n_item").alias("n_a"))
    ic = items.select(F.col("item").alias("consequent"), F.col("n_item").alias("n_c"))
    rules = (both.join(ia, "antecedent").join(ic, "consequent")
             .select("antecedent", "consequent", "n_ab",
                     (F.col("n_ab") / n).alias("support"),
                     (F.col("n_ab") / F.col("n_a")).alias("confidence"),
                     (F.col("n_ab") * n / (F.col("n_a") * F.col("n_c"))).alias("lift")))
    if min_support > 0:
        rules = rules.where(F.col("support") >= min_support)
    if min_confidence > 0:
        rules = rules.where(F.col("confidence") >= min_confidence)
    return rules


def top_rules(rules: DataFrame, k: int, by: str = "confidence") -> DataFrame:
    """A5: the k best rules by ``by``; ties by (antecedent, consequent)."""
    return rules.orderBy(F.col(by).desc(), "antecedent", "consequent").limit(k)


def _itemset_string(items: Column) -> Column:
    return F.concat_ws(ITEM_SEP, F.array_sort(items))


def itemsets(b: DataFrame, min_count: int, max_k: int = 3,
             checkpoint_from: int = 4, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Level-wise (Apriori) frequent itemsets of size 1..max_k.

    Level k extends each basket's frequent (k-1)-itemsets by a larger item
    from the same basket, counts, and keeps survivors.  Only frequent items
    enter, and occurrences of infrequent sets are dropped before the next
    level, so each level's join input shrinks with the threshold.  Levels
    from ``checkpoint_from`` on are checkpointed to cut the growing lineage.
    Output: itemset (items joined by '|', for show), k, n, items (sorted).
    """
    f1 = item_counts(b, min_count)
    n_frequent = f1.count()  # bounds the rows of any basket in b1
    b1 = partition_for_expansion(b.join(f1.select("item"), "item", "left_semi"), "basket")
    levels = [f1.select(F.array("item").alias("items"), F.lit(1).alias("k"), F.col("n_item").alias("n"))]
    # occurrences of frequent (k-1)-itemsets: (basket, items, last)
    occ = b1.select("basket", F.array("item").alias("items"), F.col("item").alias("last"))
    for k in range(2, max_k + 1):
        ext = b1.select("basket", F.col("item").alias("nxt"))
        cand = (hot_split_join(occ, ext, "basket", lambda c, l, r: c(f"{r}.nxt") > c(f"{l}.last"),
                               "items", "nxt", hot_rows, math.comb(n_frequent, k - 1) if k > 2 else n_frequent)
                .select("basket", F.concat("items", F.array("nxt")).alias("items"),
                        F.col("nxt").alias("last")))
        counts = cand.groupBy("items").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)
        if k >= checkpoint_from:
            counts = cut_lineage(counts)
        levels.append(counts.select("items", F.lit(k).alias("k"), "n"))
        if k < max_k:
            occ = cand.join(counts.select("items"), "items", "left_semi")
            if k + 1 >= checkpoint_from:
                occ = cut_lineage(occ)
    out = levels[0]
    for lv in levels[1:]:
        out = out.unionByName(lv)
    return out.select(_itemset_string(F.col("items")).alias("itemset"), "k", "n", "items")


def itemsets_fp(b: DataFrame, min_count: int, n_baskets: int | None = None) -> DataFrame:
    """Frequent itemsets of any size by parallel FP-growth.

    FPGrowth needs one item array per basket; infrequent items go first, so the
    array holds the basket's distinct frequent items only, and baskets without one
    aren't read.  The share threshold is placed half-way between integer counts of
    the baskets that are left, so it selects exactly ``n >= min_count``.
    ``n_baskets`` may tell that there are no baskets at all.
    """
    from pyspark.ml.fpm import FPGrowth

    frequent = cut_lineage(b.groupBy("item").agg(F.count("*").alias("n")).where(F.col("n") >= min_count).select("item"))
    txn = cut_lineage(b.join(frequent, "item", "left_semi").groupBy("basket").agg(F.collect_set("item").alias("items")))
    n_read = 0 if n_baskets == 0 else txn.count()
    if not n_read:
        return b.sparkSession.createDataFrame([], f"itemset string, k int, n bigint, items array<{dict(b.dtypes)['item']}>")
    # the conditional trees are spread over the shuffle partition count, not
    # over the (AQE-coalesced) partitions of the grouped input
    fp = FPGrowth(itemsCol="items", minSupport=(min_count - 0.5) / n_read,
                  minConfidence=1.0,
                  numPartitions=int(b.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sets = fp.fit(txn).freqItemsets
    return sets.select(_itemset_string(F.col("items")).alias("itemset"),
                       F.size("items").alias("k"), F.col("freq").alias("n"),
                       F.array_sort("items").alias("items"))


def multi_rules(sets: DataFrame, min_confidence: float = 0.0) -> DataFrame:
    """Rules (itemset minus c) -> c for every frequent itemset of size >= 2.

    ``sets`` is an itemset table (k, n, items) closed under subsets, as A6
    and A7 return.  Output: antecedent (for show), ante_items, consequent, n, measures
    confidence = n / n(antecedent) and lift = confidence * N / n(consequent),
    where N comes from the caller via the size-1 counts' basket total.
    """
    full = sets.where(F.col("k") >= 2).select("n", "items", F.explode("items").alias("consequent"))
    with_ante = full.select("n", "consequent", F.array_sort(F.array_except("items", F.array("consequent"))).alias("ante_items"))
    ante = sets.select(F.col("items").alias("ante_items"), F.col("n").alias("n_ante"))
    single = sets.where(F.col("k") == 1).select(F.col("items")[0].alias("consequent"), F.col("n").alias("n_cons"))
    rules = (with_ante.join(ante, "ante_items").join(single, "consequent")
             .select(_itemset_string(F.col("ante_items")).alias("antecedent"), "consequent", "n",
                     (F.col("n") / F.col("n_ante")).alias("confidence"),
                     F.col("n_ante"), F.col("n_cons"), "ante_items"))
    if min_confidence > 0:
        rules = rules.where(F.col("confidence") >= min_confidence)
    return rules


def with_lift(rules: DataFrame, n_baskets: Column) -> DataFrame:
    """Add lift = n * N / (n_ante * n_cons) to A8's rules."""
    return rules.withColumn(
        "lift", F.col("n") * n_baskets / (F.col("n_ante") * F.col("n_cons")))


def apply_rules(b: DataFrame, rules: DataFrame) -> DataFrame:
    """Per basket, the best unheld consequent of the rules that fire.

    ``rules`` has consequent, confidence, and ante_items (array) or else
    antecedent, a single item.  A rule fires when the basket holds every
    antecedent item.  Best confidence wins, ties by consequent: rules get
    their place in that order as a number, and each antecedent one row with
    its consequents, best first.  A basket is one row with its items; it meets
    the antecedents that begin with one of them, which are tested and reduced
    to their first unheld consequent as the rows pass, so only the least
    number per basket is aggregated.  No row per basket and rule is shuffled.
    The rule table is materialised, so AQE broadcasts it by its size or else
    splits a hot item.
    """
    ante = F.col("ante_items") if "ante_items" in rules.columns else F.array("antecedent")
    # nulls last, then by falling confidence
    order = F.struct(F.col("confidence").isNull().alias("unknown"), (-F.col("confidence")).alias("down"), F.col("consequent").alias("item"))
    rt = cut_lineage(rules.select(F.array_sort(F.array_distinct(ante)).alias("ante_items"), order.alias("order")))
    places = cut_lineage(dense_index(rt, "order", "place"))
    lists = cut_lineage(rt.join(places, rt["order"].eqNullSafe(places["order"]))
                        .select("ante_items", F.struct("place", rt["order"]["item"].alias("item")).alias("then"))
                        .groupBy("ante_items").agg(F.sort_array(F.collect_set("then")).alias("then"))
                        .select(F.get("ante_items", F.lit(0)).alias("item"), "ante_items", "then"))
    held = b.groupBy("basket").agg(F.collect_set("item").alias("held"))
    met = held.select("basket", "held", F.explode("held").alias("item")).join(lists, "item")
    fired = met.where(F.forall("ante_items", lambda x: F.array_contains("held", x)))
    unheld = F.filter("then", lambda x: ~F.coalesce(F.array_contains("held", x["item"]), F.lit(False)))
    best = (fired.select("basket", F.try_element_at(unheld, F.lit(1))["place"].alias("place"))
            .groupBy("basket").agg(F.min("place").alias("place")))
    return best.join(places, "place").select("basket", F.col("order")["item"].alias("item"), (-F.col("order")["down"]).alias("confidence"))


def rule_holdout(b: DataFrame, folds: int = 5, min_count: int = 1) -> DataFrame:
    """A10: pair rules learnt on baskets with basket % folds != 0, re-measured
    on the held-out baskets (basket % folds == 0).  Rules whose antecedent
    never occurs in the holdout get test_confidence null."""
    test_mask = F.pmod(F.col("basket"), F.lit(folds)) == 0
    train, test = b.where(~test_mask), b.where(test_mask)
    learnt = pair_rules(train, min_count=min_count).select(
        "antecedent", "consequent", F.col("confidence").alias("train_confidence"))
    t_counts = item_counts(test)
    t_both = directed(pair_counts(test, items=t_counts))
    t_items = t_counts.select(F.col("item").alias("antecedent"), F.col("n_item").alias("n_a"))
    return (learnt.join(t_both, ["antecedent", "consequent"], "left")
            .join(t_items, "antecedent", "left")
            .select("antecedent", "consequent", "train_confidence",
                    F.coalesce(F.col("n_ab"), F.lit(0)).alias("test_n_ab"),
                    (F.coalesce(F.col("n_ab"), F.lit(0)) / F.col("n_a")).alias("test_confidence")))
