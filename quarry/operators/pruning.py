"""Cost-complexity pruning of classification trees.

At a price alpha per leaf, the subtree of a node costs its leaves' training
errors plus alpha for each of them, and the node collapses into a leaf from the
alpha on at which that costs no more.  ``critical`` finds these values from the
deepest level up, a join a level: a node carries its subtree's cost as a
function of alpha, (from, errors, leaves) for each stretch on which the best
subtree stays the same.  That is the weakest-link sequence without a round per
link.  Stretches are at most as many as the subtree has leaves.

A node is a leaf of the pruned tree from its own value on, until an ancestor
collapses, so the sizes and errors of all trees of the sequence are running sums over
those beginnings and ends.

The rows are read once, as counts by (leaf, label); everything after that is of
the node table's size.

Defined results: rows without a node or a label count nowhere; a node without
holdout rows has no holdout errors; of trees with equally many holdout errors the
smaller is chosen; an empty node table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.session import cut_lineage

STRETCHES = "array<struct<start: double, errors: double, leaves: bigint>>"
# the node and all nodes above it, from node numbers alone: children of n are 2n and 2n + 1
PATH = "transform(sequence(0, length(bin(node)) - 1), up -> shiftright(node, up))"
ABOVE = f"slice({PATH}, 2, 64)"


def path_errors(routed: DataFrame, nodes: DataFrame, name: str = "errors") -> DataFrame:
    """(node, ``name``): rows of (node, y) at or below each node whose label isn't the node's prediction."""
    counts = routed.groupBy("node", "y").agg(F.count("*").alias("rows"))
    passed = counts.select(F.explode(F.expr(PATH)).alias("node"), "y", "rows")
    wrong = F.when(F.col("y").cast("double") != F.col("prediction"), F.col("rows")).otherwise(0)
    return passed.join(nodes.select("node", "prediction"), "node").groupBy("node").agg(F.sum(wrong).alias(name))


def _at(stretches: str, alpha: Column) -> Column:
    """The stretch that holds at ``alpha``."""
    return F.element_at(F.filter(stretches, lambda s: s["start"] <= alpha), -1)


def critical(nodes: DataFrame) -> DataFrame:
    """(node, alpha) of the inner nodes of ``nodes`` (node, depth, feature, errors): collapsed from alpha on."""
    nodes = cut_lineage(nodes.select("node", "depth", F.col("feature").isNotNull().alias("inner"), F.col("errors").cast("double").alias("errors")))

    def one(start: Column) -> Column:
        return F.array(F.struct(start.alias("start"), F.col("errors"), F.lit(1).cast("long").alias("leaves"))).cast(STRETCHES)

    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    below, found = None, None
    for depth in range(deepest, -1, -1):
        level = nodes.where(F.col("depth") == depth)
        done = level.where(~F.col("inner")).select("node", F.lit(None).cast("double").alias("alpha"), one(F.lit(0.0)).alias("cost"))
        if below is not None:
            kids = below.select(F.shiftright("node", 1).alias("node"), (F.col("node") % 2).alias("side"), "cost")
            left, right = (kids.where(F.col("side") == i).select("node", F.col("cost").alias(c)) for i, c in ((0, "l"), (1, "r")))
            starts = F.array_sort(F.array_union(F.transform("l", lambda s: s["start"]), F.transform("r", lambda s: s["start"])))
            both = F.transform(starts, lambda a: F.struct(
                a.alias("start"), (_at("l", a)["errors"] + _at("r", a)["errors"]).alias("errors"),
                (_at("l", a)["leaves"] + _at("r", a)["leaves"]).alias("leaves")))
            # where a stretch meets the node's own cost; the one that does so before its end
            meets = F.transform("both", lambda s, i: F.struct(
                F.greatest(s["start"], (F.col("errors") - s["errors"]) / (s["leaves"] - 1)).alias("alpha"), F.get("both", i + 1)["start"].alias("end")))
            met = F.filter(meets, lambda m: m["end"].isNull() | (m["alpha"] < m["end"]))
            inner = (level.where("inner").join(left, "node").join(right, "node").withColumn("both", both)
                     .withColumn("alpha", F.array_min(F.transform(met, lambda m: m["alpha"]))))
            kept = F.filter("both", lambda s: s["start"] < F.col("alpha")).cast(STRETCHES)
            done = done.unionByName(inner.select("node", "alpha", F.concat(kept, one(F.col("alpha"))).alias("cost")))
        below = cut_lineage(done)
        alphas = below.where(F.col("alpha").isNotNull()).select("node", "alpha")
        found = alphas if found is None else found.unionByName(alphas)
    return found


def spans(nodes: DataFrame, alphas: DataFrame) -> DataFrame:
    """(node, start, end) of every node of ``nodes`` that is a leaf for start <= alpha < end; no end is null."""
    own = nodes.select("node").join(alphas, "node", "left")
    # an inner join with the nodes above: the root has none
    above = (own.select("node", F.explode(F.expr(ABOVE)).alias("over"))
             .join(alphas.select(F.col("node").alias("over"), F.col("alpha").alias("upper")), "over")
             .groupBy("node").agg(F.min("upper").alias("end")))
    out = own.join(above, "node", "left").select("node", F.coalesce("alpha", F.lit(0.0)).alias("start"), "end")
    return out.where(F.col("end").isNull() | (F.col("start") < F.col("end")))


def prune_sequence(nodes: DataFrame, train: DataFrame, holdout: DataFrame) -> DataFrame:
    """(alpha, leaves, train_errors, holdout_errors, chosen) of every tree of the sequence, alpha from 0 up.

    ``nodes`` is a fitted node table, ``train`` and ``holdout`` are (node, y) rows
    routed to its leaves.  Chosen is the tree of least holdout errors, of those the smallest.
    """
    nodes = cut_lineage(nodes.select("node", "depth", "prediction", "feature"))
    judged = nodes
    for rows, name in ((train, "errors"), (holdout, "holdout_errors")):
        judged = judged.join(path_errors(rows, nodes, name), "node", "left")
    judged = cut_lineage(judged.na.fill(0, ["errors", "holdout_errors"]))
    leaf = spans(judged, critical(judged)).join(judged.select("node", "errors", "holdout_errors"), "node")
    parts = [F.lit(1).cast("long").alias("leaves"), "errors", "holdout_errors"]
    change = leaf.select(F.col("start").alias("alpha"), *parts).unionByName(
        leaf.where(F.col("end").isNotNull()).select(F.col("end").alias("alpha"), -parts[0], *[(-F.col(c)).alias(c) for c in parts[1:]])
        .toDF("alpha", "leaves", *parts[1:]))
    steps = change.groupBy("alpha").agg(*[F.sum(c).alias(c) for c in ("leaves", "errors", "holdout_errors")])
    # windows over one row per tree of the sequence, at most one per inner node and the first
    upto = Window.orderBy("alpha").rowsBetween(Window.unboundedPreceding, 0)
    trees = steps.select("alpha", F.sum("leaves").over(upto).alias("leaves"), F.sum("errors").over(upto).alias("train_errors"),
                         F.sum("holdout_errors").over(upto).alias("holdout_errors"))
    best = F.row_number().over(Window.orderBy("holdout_errors", F.desc("alpha"))) == 1
    return trees.withColumn("chosen", best)


def pruned(nodes: DataFrame, train: DataFrame, alpha: float) -> DataFrame:
    """``nodes`` cut at ``alpha``: collapsed nodes are leaves (their split columns null), what lay below them is gone."""
    nodes = cut_lineage(nodes)
    judged = nodes.join(path_errors(train, nodes), "node", "left").na.fill(0, ["errors"])
    shut = cut_lineage(critical(judged).where(F.col("alpha") <= F.lit(float(alpha))).select("node", F.lit(True).alias("shut")))
    gone = (nodes.select("node", F.explode(F.expr(ABOVE)).alias("over"))
            .join(shut.select(F.col("node").alias("over")), "over").select("node").distinct())
    kept = nodes.join(gone, "node", "left_anti").join(shut, "node", "left")
    split = [c for c in ("feature", "threshold", "categories", "null_left", "gain") if c in nodes.columns]
    return kept.withColumns({c: F.when(F.col("shut").isNull(), F.col(c)) for c in split}).select(*nodes.columns)
