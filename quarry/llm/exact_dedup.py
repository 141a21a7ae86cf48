"""Exact duplicates by deterministic block naming.

Texts are cut into blocks of ``BLOCK`` bytes.  All distinct blocks are sorted
and numbered: a block's number is its name.  Then adjacent names are paired
and the distinct pairs numbered in turn, level by level, until each document
has one name.  Documents are equal if and only if they end at the same level
with the same name: no step relies on a hash being free of collisions.  (Rows
find their block's name by a 128-bit key; that no two blocks share a key is
checked on all blocks, and another seed is taken if two do.)

Each text is shuffled once, as blocks, in the sort; everything after carries
names.  Shared blocks combine before the shuffle.  All joins are on plain
exchanges, which Spark splits if a block or group is hot.

Defined results: null text equals empty text; of a group the row with the
largest doc_id stays (null is smallest; of repeated rows one stays); an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import common

BLOCK = 4096


def _blocks(data: str):
    last = F.greatest(F.ceil(F.octet_length(data) / BLOCK) - 1, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last.cast("int")),
                       lambda i: F.substring(F.col(data), i * BLOCK + 1, F.lit(BLOCK)))


def _numbered(distinct: DataFrame, *cols: str) -> DataFrame:
    """Names for distinct rows: their numbers in the order of each partition's sort."""
    return distinct.sortWithinPartitions(*cols).withColumn("name", F.monotonically_increasing_id())


def exact_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_key (64-bit row key), text_sha256 per row."""
    data = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("data"),
                       common.row_key().alias("text_key"))
    for seed in itertools.count():
        key = [F.xxhash64(F.lit(s), "block").alias(k) for s, k in ((2 * seed, "k1"), (2 * seed + 1, "k2"))]
        distinct = data.select(F.explode(_blocks("data")).alias("block")).distinct()
        names = common.materialise(_numbered(distinct, "block").select(*key, "name"), "block-names")
        if names.groupBy("k1", "k2").count().filter("count > 1").isEmpty():
            break
    keys = F.transform(_blocks("data"), lambda b: F.struct(F.xxhash64(F.lit(2 * seed), b).alias("k1"),
                                                           F.xxhash64(F.lit(2 * seed + 1), b).alias("k2")))
    rows = common.materialise(
        data.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text_key",
                    F.sha2("data", 256).alias("text_sha256"), keys.alias("keys")), "block-rows")
    level = common.materialise(
        rows.select("row", F.size("keys").alias("n"), F.posexplode("keys").alias("pos", "k"))
        .select("row", "n", "pos", F.col("k.k1").alias("k1"), F.col("k.k2").alias("k2"))
        .join(names, ["k1", "k2"]).select("row", "n", "pos", "name"), "block-level")
    longest = rows.agg(F.max(F.size("keys"))).first()[0] or 0
    whole, depth = [], 0
    while True:
        whole.append(level.filter("n = 1").select("row", F.lit(depth).alias("level"), "name"))
        if longest <= 1:
            break
        pairs = (level.filter("n > 1").groupBy("row", "n", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
                 .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
                      F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b")))
        named = common.materialise(_numbered(pairs.select("a", "b").distinct(), "a", "b"), "block-names")
        level = common.materialise(
            pairs.join(named, ["a", "b"])
            .select("row", F.ceil(F.col("n") / 2).cast("int").alias("n"), "pos", "name"), "block-level")
        longest, depth = -(-longest // 2), depth + 1
    ident = whole[0]
    for w in whole[1:]:
        ident = ident.unionByName(w)
    ident = common.materialise(
        ident.join(rows.drop("keys"), "row")
        .select("row", "doc_id", "text_key", "text_sha256", "level", "name"), "block-identity")
    groups = common.materialise(
        ident.groupBy("level", "name").agg(F.max(F.struct("doc_id", "row")).alias("keep"),
                                           F.count("*").alias("group_size")), "block-groups")
    return ident.join(groups, ["level", "name"]).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"), "text_key", "text_sha256")


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept."""
    groups = common.materialise(exact_groups(docs), "copies")
    repeated = not (groups.filter("group_size > 1").groupBy("doc_id", "text_key").count()
                    .filter("count > 1").isEmpty())
    return common.keep_rows(docs, groups.filter("kept"), one_per_key=repeated)
