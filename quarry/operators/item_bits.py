"""Frequent itemsets by transaction bitmaps, and their closed and maximal ones.

Baskets get dense numbers; each frequent item has one bitmap of 32,768 baskets
per (item, part).  The support of an itemset is the bit count of the
intersection of its two parents' bitmaps, part by part, so a level reads the
bitmaps of the level before instead of the baskets, and the work of one itemset
spreads over its parts.  Bitmaps are dealt by part over at least as many partitions as
there are parts: they compress so well that partitions sized by bytes would hold
far more than a task's memory, and a part's sets meet where they lie.

An itemset is closed if no larger set has its support, and maximal if no larger
set is frequent.  Supersets with one item more decide both: support never rises
as items are added.

Defined results: rows with a null basket or item take no part; repeated rows
count once; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators import affinity as A
from quarry.operators.prefix import dense_index
from quarry.operators.skew import HOT_KEY_ROWS, hot_split_join
from quarry.session import cut_lineage, partition_for_expansion


def by_part(rows: DataFrame, parts: int) -> DataFrame:
    """``rows`` dealt by part, one or a few of the ``parts`` to a task."""
    return rows.repartition(max(parts, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "part")


def item_bitmaps(b: DataFrame) -> tuple[DataFrame, int]:
    """(items, part, bits): the baskets of every item of ``b`` (basket, item), ``items`` an array of one; and the greatest part."""
    numbers = cut_lineage(dense_index(b, "basket", "nth"))
    nth = F.col("nth") + 1  # bit 0 of part 1 is the first basket
    parts = numbers.select(F.max(F.bitmap_bucket_number(nth))).first()[0] or 1
    places = b.join(numbers, "basket").select(F.array("item").alias("items"), F.bitmap_bucket_number(nth).alias("part"),
                                              F.bitmap_bit_position(nth).alias("bit"))
    return by_part(places, parts).groupBy("items", "part").agg(F.bitmap_construct_agg("bit").alias("bits")), parts


def intersect(pairs: DataFrame, bitmaps: DataFrame, parts: int) -> DataFrame:
    """(items, part, bits) of every ``items`` of ``pairs`` (items, left, right), from both parents' bitmaps.

    Parts in which a parent has no basket hold none of the itemset.
    """
    sides = pairs.select("items", F.explode(F.array("left", "right")).alias("parent"))
    parents = by_part(bitmaps.withColumnRenamed("items", "parent"), parts)
    return (sides.join(parents, "parent").groupBy("items", "part")
            .agg(F.bitmap_and_agg("bits").alias("bits"), F.count("*").alias("sides"))
            .where("sides = 2").drop("sides"))


def _extended(sets: DataFrame, k: int, hot_rows: int) -> DataFrame:
    """(items, left, right): unions of two sets of k-1 items that share all but the last one."""
    x = sets.select(F.slice("items", 1, k - 2).alias("head"), F.col("items").alias("left"))
    y = sets.select(F.slice("items", 1, k - 2).alias("head"), F.col("items").alias("right"))
    x, y = partition_for_expansion(x, "head"), partition_for_expansion(y, "head")

    def later(c, left, right):
        return F.element_at(c(f"{left}.left"), -1) < F.element_at(c(f"{right}.right"), -1)

    return hot_split_join(x, y, "head", later, "left", "right", hot_rows).select(
        F.concat("left", F.array(F.element_at("right", -1))).alias("items"), "left", "right")


def _all_parts_frequent(pairs: DataFrame, sets: DataFrame, k: int) -> DataFrame:
    """``pairs`` whose every subset with one item less is in ``sets``; the parents are already."""
    if k < 3:
        return pairs
    others = pairs.select("items", F.explode(F.sequence(F.lit(1), F.lit(k - 2))).alias("gone"))
    without = F.filter("items", lambda x, i: i != F.col("gone") - 1)
    kept = (others.select("items", without.alias("part")).join(sets.select(F.col("items").alias("part")), "part", "left_semi")
            .groupBy("items").agg(F.count("*").alias("found")).where(F.col("found") == k - 2))
    return pairs.join(kept.select("items"), "items", "left_semi")


def itemsets_bits(b: DataFrame, min_count: int, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """(items, k, n): itemsets of any size in at least ``min_count`` baskets (``min_count`` >= 1).

    Pairs are counted from the baskets, as most pairs of frequent items may never
    meet; from three items on, sets that share all but the last item are joined,
    kept if all their parts are frequent, and counted by intersection.  A level's
    sets and bitmaps are written once; the loop ends at a level without any.
    """
    if min_count < 1:
        raise ValueError("min_count must be at least 1")
    b = b.select("basket", "item").where(F.col("basket").isNotNull() & F.col("item").isNotNull()).distinct()
    one = cut_lineage(A.item_counts(b, min_count).select(F.array("item").alias("items"), F.col("n_item").alias("n")))
    b1 = cut_lineage(b.join(one.select(F.col("items")[0].alias("item")), "item", "left_semi"))
    two = cut_lineage(A.pair_counts(b1).where(F.col("n_ab") >= min_count)
                      .select(F.array("item_a", "item_b").alias("items"), F.col("n_ab").alias("n")))
    levels = [one.withColumn("k", F.lit(1)), two.withColumn("k", F.lit(2))]
    sets, bitmaps, parts, k = two, None, 1, 3
    while sets.count() >= k:  # a set of k items has k frequent parts
        pairs = cut_lineage(_all_parts_frequent(_extended(sets, k, hot_rows), sets, k))
        if pairs.isEmpty():
            break
        if bitmaps is None:
            halves = two.select("items", F.array(F.col("items")[0]).alias("left"), F.array(F.col("items")[1]).alias("right"))
            single, parts = item_bitmaps(b1)
            bitmaps = cut_lineage(intersect(halves, cut_lineage(single), parts))
        met = cut_lineage(intersect(pairs, bitmaps, parts))
        sets = cut_lineage(met.groupBy("items").agg(F.sum(F.bitmap_count("bits")).alias("n")).where(F.col("n") >= min_count))
        bitmaps = met.join(sets.select("items"), "items", "left_semi")
        levels.append(sets.withColumn("k", F.lit(k)))
        k += 1
    return reduce(DataFrame.unionByName, levels).select("items", "k", "n")


def closed(sets: DataFrame) -> DataFrame:
    """The closed itemsets of ``sets`` (items sorted, k, n; closed under subsets), with ``maximal``.

    Every set tells its support to the sets with one item less, aggregated by
    set; a set keeps its place if none of these supports equals its own.
    """
    sets = cut_lineage(sets.select("items", "k", "n"))
    up = sets.where(F.col("k") > 1).select("n", "items", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("gone"))
    without = F.filter("items", lambda x, i: i != F.col("gone"))
    above = up.select(without.alias("items"), "n").groupBy("items").agg(F.max("n").alias("n_above"))
    return (sets.join(above, "items", "left")
            .where(F.col("n_above").isNull() | (F.col("n_above") < F.col("n")))
            .select("items", "k", "n", F.col("n_above").isNull().alias("maximal")))
