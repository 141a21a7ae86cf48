"""Prefix trie of conversations by truncation peeling.

Turns are put in order, and each prefix of a conversation gets a key: the sum of
120-bit hashes of (place, role, text) over its turns.  Sums over ordered rows
need no group in one place, so a conversation of any length is no burden.

The trie is then peeled from the greatest depth down.  Below the last prefix
that a conversation shares with any other its nodes are a chain of one member,
cut off in one step whatever its length.  From the greatest shared depth on, a
round a depth: the conversations that end there, or lost such a tail, join the
nodes that survived from below; each survivor strips its last turn, which leaves
the key of its smallest member's shorter prefix, and all are regrouped by that
key.  Regrouping adds up members, children, leaves and saved tokens, so a depth's
nodes are found and finished in one pass.  There are as many rounds as the longest
prefix that two conversations share has turns.

``rebuild`` makes the conversations: the first h turns of the conversation
that opens a block of 100 ids, then the own turns after the first h, with h the
unsigned CRC32 of the decimal id modulo 6.

Defined results: null role or text is empty; turns of the same number follow by
role, then text, nulls first; repeated rows are turns of their own; rows without
a conv_id take no part; a conversation left without turns is a member of the
root only; an empty table gives no rows, not even a root; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quarry.llm import common
from quarry.operators.prefix import running_totals
from quarry.session import cut_lineage, partition_for_expansion

BLOCK = 100
SHARED = 6
#: Characters of ids that a row holds at most on their way to a hash.
PIECE = 1 << 16


def placed(turns: DataFrame) -> DataFrame:
    """conv, place (from 1), role, text: turns in order, without a window over a whole conversation."""
    named = turns.filter("conv_id is not null").select(
        F.col("conv_id").alias("conv"), "turn", F.col("role").alias("said_by"), F.col("text").alias("said"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = ["turn", "said_by", "said"]
    # the ranges come from a sample, so they are fixed once
    dealt = cut_lineage(named.repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id()))
    sizes = dealt.groupBy("conv", "part").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offset = sizes.select("conv", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order))
    return (dealt.withColumn("nth", nth).join(offset, ["conv", "part"])
            .select("conv", (F.col("before") + F.col("nth")).alias("place"), "role", "text"))


def rebuild(turns: DataFrame, block: int = BLOCK, shared: int = SHARED) -> tuple[DataFrame, DataFrame]:
    """(conv, length) of every conversation, and (conv, place, role, text) of their rebuilt turns."""
    own = cut_lineage(placed(turns))
    convs = own.groupBy("conv").agg(F.max("place").alias("own")).select(
        "conv", "own", (F.col("conv") - F.col("conv") % block).alias("base"),
        (F.crc32(F.col("conv").cast("string").cast("binary")) % shared).alias("cut"))
    sizes = convs.select(F.col("conv").alias("base"), F.col("own").alias("base_own"))
    convs = cut_lineage(convs.join(sizes, "base", "left").select(
        "conv", "base", "cut", F.least("cut", F.coalesce("base_own", F.lit(0))).alias("given"), "own"))
    opening = own.filter((F.col("place") < shared) & (F.col("conv") % block == 0)).select(
        F.col("conv").alias("base"), "place", "role", "text")
    head = (convs.select("conv", "base", "given").join(opening, "base").filter("place <= given")
            .select("conv", "place", "role", "text"))
    tail = (own.join(convs.select("conv", "cut", "given"), "conv").filter("place > cut")
            .select("conv", (F.col("place") - F.col("cut") + F.col("given")).alias("place"), "role", "text"))
    lengths = convs.select("conv", (F.col("given") + F.greatest(F.col("own") - F.col("cut"), F.lit(0))).alias("length"))
    return lengths, head.unionByName(tail)


def _hash(first: int) -> Column:
    """60 bits of a turn's digest, as a number whose sums stay exact."""
    return F.conv(F.substring("digest", first, 15), 16, 10).cast("decimal(20,0)")


def prefixes(lengths: DataFrame, turns: DataFrame) -> DataFrame:
    """conv, depth, k1, k2, up1, up2, chars, length: a row per turn, with the keys of the prefix and the one before."""
    hashed = (turns.withColumn("digest", F.sha2(F.concat_ws(":", "place", F.length("role"), "role", "text"), 256))
              .select("conv", "place", _hash(1).alias("h1"), _hash(16).alias("h2"), F.length("text").cast("bigint").alias("chars")))
    hashed = cut_lineage(hashed)
    summed = running_totals(hashed.select("conv", "place", "h1", "h2"), ["conv"], "place", ["h1", "h2"])
    return (summed.select("conv", "place", "L_h1", "L_h2").join(hashed, ["conv", "place"]).join(lengths, "conv")
            .select("conv", F.col("place").alias("depth"), F.col("L_h1").alias("k1"), F.col("L_h2").alias("k2"),
                    (F.col("L_h1") - F.col("h1")).alias("up1"), (F.col("L_h2") - F.col("h2")).alias("up2"), "chars", "length"))


def peel(lengths: DataFrame, prefix: DataFrame) -> DataFrame:
    """Nodes (depth, k1, k2, up1, up2, conv_id, n_convs, n_children, n_leaves, saved_tokens), root included."""
    keys = ["depth", "k1", "k2"]
    company = prefix.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    # prefixes of a shared prefix are shared: a conversation is alone from one depth on
    last = prefix.select("conv", *keys).join(company, keys, "left_semi").groupBy("conv").agg(F.max("depth").alias("shared"))
    last = cut_lineage(lengths.join(last, "conv", "left").select("conv", "length", F.coalesce("shared", F.lit(0)).alias("shared")))
    rows = cut_lineage(prefix.join(last.select("conv", "shared"), "conv"))
    tails = rows.filter("depth > shared").select(
        *keys, "up1", "up2", "conv", F.lit(1).cast("bigint").alias("n_convs"),
        (F.col("depth") < F.col("length")).cast("bigint").alias("n_children"),
        F.lit(1).cast("bigint").alias("n_leaves"), F.lit(0).cast("bigint").alias("saved"))
    path = common.scratch(prefix.sparkSession, "trie-prefixes")
    # ranges of (depth, conv): a round opens only its own depth's files
    (rows.filter("depth <= shared").withColumn("at", F.col("depth")).repartitionByRange("depth", "conv")
     .write.partitionBy("at").parquet(path))
    stored = prefix.sparkSession.read.schema(StructType([*rows.schema.fields, StructField("at", LongType())])).parquet(path)
    deepest = stored.agg(F.max("depth")).first()[0] or 0
    zero = F.lit(0).cast("decimal(38,0)")
    root = last.select("conv", F.lit(0).cast("bigint").alias("depth"), *[zero.alias(c) for c in ("k1", "k2", "up1", "up2")],
                       F.lit(0).cast("bigint").alias("chars"), "length", "shared")
    below = F.col("length") > F.col("depth")  # a tail of its own hangs there
    counted = {"n_convs": F.lit(1), "n_children": below, "n_leaves": below, "saved": F.lit(0)}
    nodes, survivors = tails, None
    for depth in range(deepest, -1, -1):
        here = (stored.filter(F.col("at") == depth).drop("at") if depth else root).select(
            "conv", "depth", *[F.col(c).cast("decimal(38,0)").alias(c) for c in ("k1", "k2", "up1", "up2")], "chars", "length", "shared")
        met = here.filter(F.col("shared") == depth).select(
            *[c for c in here.columns if c not in ("length", "shared")], *[v.cast("bigint").alias(c) for c, v in counted.items()])
        if survivors is not None:
            met = met.unionByName(here.drop("length", "shared").join(survivors, "conv"))
        found = met.groupBy("depth", "k1", "k2", "up1", "up2", "chars").agg(
            F.min("conv").alias("conv"), *[F.sum(c).alias(c) for c in counted])
        found = common.materialise(found.select(
            "depth", "k1", "k2", "up1", "up2", "conv", "n_convs", "n_children",
            F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("bigint").alias("n_leaves"),
            (F.col("saved") + (F.col("n_convs") - 1) * F.col("chars")).alias("saved")), "trie-nodes")
        survivors = found.select("conv", "n_convs", F.lit(1).cast("bigint").alias("n_children"), "n_leaves", "saved")
        nodes = nodes.unionByName(found)
    return nodes.withColumnsRenamed({"conv": "conv_id", "saved": "saved_tokens"})


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (k1, k2, conv), sorted, to rows of joined ids of one key: (k1, k2, first, ids)."""
    now, ids, size = None, [], 0

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"k1": [now[0]], "k2": [now[1]], "first": [ids[0]], "ids": [",".join(map(str, ids))]})

    for b in batches:
        for k1, k2, conv in zip(*(b.column(c).to_pylist() for c in ("k1", "k2", "conv"))):
            if ids and ((k1, k2) != now or size > PIECE):
                yield row()
                ids, size = [], 0
            now = (k1, k2)
            ids.append(conv)
            size += 20
    if ids:
        yield row()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (k1, k2, ids) in order of key and first id, to the digest of each key's joined ids."""
    now, digest = None, None
    for b in batches:
        done = []
        for k1, k2, ids in zip(*(b.column(c).to_pylist() for c in ("k1", "k2", "ids"))):
            if (k1, k2) != now:
                if now:
                    done.append((*now, digest.hexdigest()))
                now, digest = (k1, k2), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if done:
            yield pa.RecordBatch.from_pydict(dict(zip(("k1", "k2", "ends_sha256"), map(list, zip(*done)))))
    if now:
        yield pa.RecordBatch.from_pydict({"k1": [now[0]], "k2": [now[1]], "ends_sha256": [digest.hexdigest()]})


def ends(last: DataFrame) -> DataFrame:
    """k1, k2, ends_sha256 of the conversations (conv) that end at each key.

    Ids are joined to pieces within ranges of (key, id) first, so that what one
    task reads for a key that very many conversations share is a few rows.
    """
    key = "k1 string, k2 string"
    ranged = (last.select(F.col("k1").cast("string").alias("k1"), F.col("k2").cast("string").alias("k2"), "conv")
              .repartitionByRange("k1", "k2", "conv").sortWithinPartitions("k1", "k2", "conv"))
    pieces = common.materialise(ranged.mapInArrow(_chunks, f"{key}, first bigint, ids string"), "trie-ids")
    found = (partition_for_expansion(pieces, "k1", "k2").sortWithinPartitions("k1", "k2", "first").select("k1", "k2", "ids")
             .mapInArrow(_digests, f"{key}, ends_sha256 string"))
    return found.select(F.col("k1").cast("decimal(38,0)").alias("k1"), F.col("k2").cast("decimal(38,0)").alias("k2"), "ends_sha256")


def trie(lengths: DataFrame, turns: DataFrame) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    prefix = cut_lineage(prefixes(lengths, turns))
    nodes = cut_lineage(peel(lengths, prefix))
    zero = F.lit(0).cast("decimal(38,0)")
    last = (prefix.filter("depth = length").select("k1", "k2", "conv")
            .unionByName(lengths.filter("length = 0").select(zero.alias("k1"), zero.alias("k2"), "conv")))
    ended = cut_lineage(ends(last))
    parent = nodes.select(F.col("depth").alias("above"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                          F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(parent, (F.col("depth") - 1 == F.col("above")) & (F.col("up1") == F.col("p1")) & (F.col("up2") == F.col("p2")), "left")
    out = out.join(ended, ["k1", "k2"], "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def conversation_trie(turns: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations of ``turns`` (conv_id, turn, role, text)."""
    return trie(*rebuild(turns))


ORACLE = """
WITH own AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
conv AS (
  SELECT c, c - c % 100 AS base,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
               lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))),
             4294967295::BIGINT) % 6 AS h
  FROM (SELECT DISTINCT c FROM own)),
turns AS (
  SELECT v.c, 0 AS part, o.pos, o.role, o.text FROM conv v JOIN own o ON o.c = v.base AND o.pos <= v.h
  UNION ALL
  SELECT v.c, 1, o.pos, o.role, o.text FROM conv v JOIN own o ON o.c = v.c AND o.pos > v.h),
seqs AS (
  SELECT v.c, coalesce(list({'r': t.role, 't': t.text} ORDER BY t.part, t.pos) FILTER (t.c IS NOT NULL), []) AS seq
  FROM conv v LEFT JOIN turns t ON t.c = v.c GROUP BY v.c),
pre AS (
  SELECT c, len(seq) AS length, unnest(range(len(seq) + 1)) AS depth, seq FROM seqs),
members AS (SELECT c, length, depth, seq[1:depth] AS p FROM pre),
nodes AS (
  SELECT depth, p, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (length = depth), '')) AS ends_sha256
  FROM members GROUP BY depth, p),
kids AS (SELECT p[1:depth - 1] AS p, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
full_nodes AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.p = n.p AND k.depth = n.depth),
up AS (
  SELECT unnest(range(depth + 1)) AS d, p, CASE WHEN n_children = 0 THEN 1 ELSE 0 END AS leaf,
         CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(p[depth].t) END AS saved
  FROM full_nodes),
under AS (SELECT d AS depth, p[1:d] AS p, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM up GROUP BY ALL)
SELECT n.conv_id, n.depth::BIGINT AS depth, q.conv_id AS parent_conv_id, n.n_convs, n.n_children,
       u.n_leaves::BIGINT AS n_leaves, u.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN under u ON u.depth = n.depth AND u.p = n.p
LEFT JOIN nodes q ON q.depth = n.depth - 1 AND q.p = n.p[1:n.depth - 1]
"""
