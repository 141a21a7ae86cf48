"""Decision trees for classification and regression.

Split scoring is a histogram: rows are unpivoted to (node, feature, value),
aggregated to one row per distinct value with class counts (or Σy, Σy²),
and running totals over ascending values (``prefix.running_totals``, whose
windows are bounded) give the left side of every threshold.

``fit_levelwise`` grows the tree one level per pass over the data; the
best split of every node of a level comes from one job, is materialised
in the checkpoint folder (at most 2^depth rows) and joined back to route
rows to the children.  Only node statistics ever reach the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.operators.prefix import running_totals
from quarry.session import cut_lineage

# A split must lower its node's impurity by this share, whatever y's unit.
MIN_GAIN = 1e-9
# Thresholds per node and feature that a sketch proposes, and the sketch's size.
BINS = 64
SKETCH_K = 800


# ---------------------------------------------------------------- impurity
def gini(counts: list[Column], n: Column) -> Column:
    return F.lit(1.0) - reduce(lambda a, b: a + b, [(c / n) * (c / n) for c in counts])


def entropy(counts: list[Column], n: Column) -> Column:
    terms = [F.when(c > 0, -(c / n) * F.log2(c / n)).otherwise(F.lit(0.0)) for c in counts]
    return reduce(lambda a, b: a + b, terms)


def variance(s1: Column, s2: Column, n: Column) -> Column:
    """Of values whose sums are taken around a value near their mean."""
    return F.greatest((s2 - s1 * s1 / n) / n, F.lit(0.0))


def _unpivot(df: DataFrame, features: list[str]) -> DataFrame:
    args = []
    for f in features:
        args += [F.lit(f), F.col(f).cast("double")]
    return df.select("node", "y", F.stack(F.lit(len(features)), *args).alias("feature", "value"))


def split_scores(df: DataFrame, features: list[str], criterion: str = "gini",
                 classes: list | None = None) -> DataFrame:
    """Every threshold ``feature <= t`` of every node.

    df: (node, y, features...).  A row whose feature is null lies right of
    every threshold, as ``fit_levelwise`` and ``predict`` route it.  Variance
    is taken around a value near the node's mean, so a large offset of y costs
    no digits; from 1 on it is the whole number below, which keeps the sums
    of whole numbers exact in any order.
    Output: node, feature, threshold, n_left, n_right, impurity
    (size-weighted child impurity), gain.
    """
    if criterion == "variance":
        # one row per node; left to AQE to broadcast
        m = F.avg("y")
        near = F.when(F.abs(m) >= 1, F.floor(m).cast("double")).otherwise(m.cast("float").cast("double"))
        means = cut_lineage(df.groupBy("node").agg(near.alias("_mean")))
        df = df.join(means, "node").withColumn("y", F.col("y") - F.col("_mean"))
    long = _unpivot(df, features)
    if criterion == "variance":
        stats = ["n", "s1", "s2"]
        hist = long.groupBy("node", "feature", "value").agg(
            F.count("*").alias("n"), F.sum("y").alias("s1"), F.sum(F.col("y") * F.col("y")).alias("s2"))
    else:
        stats = [str(c) for c in classes] + ["n"]
        hist = long.groupBy("node", "feature", "value").agg(
            *[F.count(F.when(F.col("y") == c, 1)).alias(str(c)) for c in classes],
            F.count(F.when(F.col("y").isin(*classes), 1)).alias("n"))
    hist = cut_lineage(hist)
    quoted = {s: F.col(f"`{s}`") for s in stats}
    totals = hist.groupBy("node", "feature").agg(*[F.sum(q).alias(f"T_{s}") for s, q in quoted.items()])
    run = running_totals(hist.where(F.col("value").isNotNull()), ["node", "feature"], "value", stats)
    cum = (run.drop(*[f"T_{s}" for s in stats]).join(totals, ["node", "feature"])
           .withColumnRenamed("value", "threshold").where(F.col("L_n") < F.col("T_n")))

    def side(prefix, other=None):
        if other is None:
            get = lambda s: F.col(f"{prefix}_{s}")
        else:
            get = lambda s: F.col(f"T_{s}") - F.col(f"L_{s}")
        if criterion == "variance":
            return variance(get("s1"), get("s2"), get("n")), get("n")
        counts = [get(str(c)) for c in classes]
        f = gini if criterion == "gini" else entropy
        return f(counts, get("n")), get("n")

    (il, nl), (ir, nr), (ip, n) = side("L"), side("L", "R"), side("T")
    weighted = (nl / n) * il + (nr / n) * ir
    return cum.select("node", "feature", "threshold", nl.alias("n_left"), nr.alias("n_right"),
                      weighted.alias("impurity"), (ip - weighted).alias("gain"))


def sketched_scores(df: DataFrame, features: list[str], criterion: str = "gini", classes: list | None = None,
                    bins: int = BINS, k: int = SKETCH_K) -> DataFrame:
    """As ``split_scores``, with thresholds at quantiles from mergeable sketches (KLL).

    One aggregate of sketches per (node, feature), merged before and after the shuffle,
    gives at most ``bins`` thresholds, the greatest value among them; rows are then
    counted exactly between these, so no row per distinct value is shuffled and every
    score is the exact one of its threshold.  Between neighbouring thresholds lie at
    most 1 / bins of the node's rows plus the sketch's rank error on both sides (about
    0.4 % each at k = 800) unless one value holds more.  Sketches choose what to keep at
    random, so thresholds can differ from run to run; they are written once.  Null and
    NaN are as in ``split_scores``: right of every threshold, and the greatest value.
    """
    long = _unpivot(df, features).where(F.col("value").isNotNull() & ~F.isnan("value"))
    ranks = F.array(*[F.lit(i / bins) for i in range(1, bins + 1)])
    sketches = long.groupBy("node", "feature").agg(F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch"))
    cuts = sketches.select("node", "feature", F.array_distinct(F.kll_sketch_get_quantile_double("sketch", ranks)).alias("cuts"))
    # a row per node, materialised: AQE sees its size
    wide = cut_lineage(cuts.groupBy("node").agg(*[
        F.first(F.when(F.col("feature") == f, F.col("cuts")), ignorenulls=True).alias(f"_cuts_{i}") for i, f in enumerate(features)]))

    def raised(i: int, f: str) -> Column:
        v = F.col(f).cast("double")
        return F.when(v.isNotNull(), F.coalesce(F.get(F.filter(f"_cuts_{i}", lambda c: c >= v), F.lit(0)), v)).alias(f)

    binned = df.join(wide, "node", "left").select("node", "y", *[raised(i, f) for i, f in enumerate(features)])
    return split_scores(binned, features, criterion, classes)


def split_scores_categorical(df: DataFrame, feature: str, classes: list) -> DataFrame:
    """T4: one-vs-rest Gini split for every category of ``feature``.

    Null is a category of its own, whatever the feature's type.  As in
    ``split_scores``, rows of a label outside ``classes`` count nowhere.
    """
    cls = [str(c) for c in classes]
    hist = (df.where(F.col("y").isin(*classes)).groupBy("node", F.col(feature).alias("category"))
            .agg(*[F.count(F.when(F.col("y") == c, 1)).alias(str(c)) for c in classes]))
    hist = hist.withColumn("n", reduce(lambda a, b: a + b, [F.col(f"`{c}`") for c in cls]))
    # node totals are an aggregate (one row per node), not a
    # window: a node may have any number of categories
    totals = hist.groupBy("node").agg(*[F.sum(F.col(f"`{c}`")).alias(f"T_{c}") for c in cls],
                                      F.sum("n").alias("T_n"))
    cols = ["node", "category"] + [F.col(f"`{c}`").alias(f"L_{c}") for c in cls] + [F.col("n").alias("L_n")]
    h = (hist.select(*cols).join(totals, "node")
         .where(F.col("L_n") < F.col("T_n")))
    il = gini([F.col(f"L_{c}") for c in cls], F.col("L_n"))
    ir = gini([F.col(f"T_{c}") - F.col(f"L_{c}") for c in cls], F.col("T_n") - F.col("L_n"))
    ip = gini([F.col(f"T_{c}") for c in cls], F.col("T_n"))
    n, nl, nr = F.col("T_n"), F.col("L_n"), F.col("T_n") - F.col("L_n")
    weighted = (nl / n) * il + (nr / n) * ir
    return h.select("node", F.lit(feature).alias("feature"), "category", nl.alias("n_left"),
                    nr.alias("n_right"), weighted.alias("impurity"), (ip - weighted).alias("gain"))


def best_split(scores: DataFrame) -> DataFrame:
    """Best split per node: highest gain, ties by (feature, threshold)."""
    w = Window.partitionBy("node").orderBy(F.col("gain").desc(), "feature", "threshold")
    return scores.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def _node_stats(df: DataFrame, criterion: str) -> DataFrame:
    if criterion == "variance":
        return df.groupBy("node").agg(F.count("*").alias("n"), F.avg("y").alias("prediction"))
    c = df.groupBy("node", "y").agg(F.count("*").alias("c"))
    w = Window.partitionBy("node").orderBy(F.col("c").desc(), F.col("y").asc())
    top = c.withColumn("rn", F.row_number().over(w)).where("rn = 1") \
        .select("node", F.col("y").cast("double").alias("prediction"))
    return c.groupBy("node").agg(F.sum("c").alias("n")).join(top, "node")


def _feature_value(features: list[str]) -> Column:
    expr = None
    for f in features:
        cond = F.col("feature") == f
        expr = F.when(cond, F.col(f).cast("double")) if expr is None else expr.when(cond, F.col(f).cast("double"))
    return expr


def fit_levelwise(df: DataFrame, features: list[str], max_depth: int = 2,
                  criterion: str = "gini", classes: list | None = None, scores=split_scores) -> DataFrame:
    """Exact tree, one pass over the data per level; with ``sketched_scores``, two, and thresholds at quantiles.

    df: (id, y, features...).  Output node table: node (root 1, children
    2n and 2n+1), depth, n, prediction (majority class, ties to the lower
    label; or mean), feature, threshold (null for leaves), gain.
    """
    # The numeric rows are read once per level; materialise them so every
    # level scans a compact table instead of re-deriving the features.
    base = cut_lineage(df.select("id", "y", *features))
    data = base.withColumn("node", F.lit(1).cast("long"))
    levels = []
    for depth in range(max_depth + 1):
        stats = _node_stats(data, criterion).withColumn("depth", F.lit(depth))
        if depth == max_depth:
            levels.append(stats.select("node", "depth", "n", "prediction",
                                       F.lit(None).cast("string").alias("feature"),
                                       F.lit(None).cast("double").alias("threshold"),
                                       F.lit(None).cast("double").alias("gain")))
            break
        best = best_split(scores(data, features, criterion, classes)) \
            .where(F.col("gain") > MIN_GAIN * (F.col("gain") + F.col("impurity"))) \
            .select("node", "feature", "threshold", "gain")
        best = cut_lineage(best)  # <= 2^depth rows; later levels must not re-run this job
        levels.append(stats.join(best, "node", "left")
                      .select("node", "depth", "n", "prediction", "feature", "threshold", "gain"))
        routed = data.join(best, "node")  # a row per node, materialised: AQE sees its size
        data = routed.select(
            "id", "y", *features,
            (F.col("node") * 2 + F.when(_feature_value(features) <= F.col("threshold"), 0).otherwise(1))
            .alias("node"))
    return reduce(DataFrame.unionByName, levels)


def _shared_out(data: DataFrame, categorical: list[str], positive) -> tuple[DataFrame, dict[str, DataFrame]]:
    """``data`` with each category replaced by its node's share of ``positive``, and the shares (node, category, share)."""
    encoded, shares = data, {}
    for c in categorical:
        by = cut_lineage(data.groupBy("node", F.col(c).alias("category"))
                         .agg(F.avg((F.col("y") == positive).cast("double")).alias("share")))
        shares[c] = by
        other = by.select(F.col("node").alias("_node"), F.col("category").alias("_category"), F.col("share").alias("_share"))
        encoded = (encoded.join(other, (F.col("node") == F.col("_node")) & F.col(c).eqNullSafe(F.col("_category")))
                   .withColumn(f"{c}_share", F.col("_share")).drop("_node", "_category", "_share"))
    return encoded, shares


def fit_mixed(df: DataFrame, numeric: list[str], categorical: list[str], max_depth: int = 2,
              criterion: str = "gini", classes: list | tuple = (0, 1)) -> DataFrame:
    """Exact tree of two classes over numeric and categorical features.

    Of all subsets of a node's categories, the best one is a prefix of their order by
    share of the second class, so a level replaces each category by that share in
    its node and scores thresholds on it like any number's; categories of equal
    share go together.  Null is a category of its own.  Rows of other labels are
    left out.  Output: node, depth, n, prediction, feature, threshold (numeric
    splits), categories (those that go left, sorted; categorical splits), null_left
    (whether null goes left), gain.
    """
    if len(classes) != 2:
        raise ValueError("categories are ordered by the share of one of two classes")
    base = cut_lineage(df.where(F.col("y").isin(*classes))
                       .select("id", "y", *numeric, *[F.col(c).cast("string").alias(c) for c in categorical]))
    data = base.withColumn("node", F.lit(1).cast("long"))
    names = {**{f: f for f in numeric}, **{f"{c}_share": c for c in categorical}}
    split_columns = {"feature": "string", "threshold": "double", "categories": "array<string>", "null_left": "boolean", "gain": "double"}
    levels = []
    for depth in range(max_depth + 1):
        stats = _node_stats(data, criterion).withColumn("depth", F.lit(depth))
        if depth == max_depth:
            levels.append(stats.select("node", "depth", "n", "prediction", *[F.lit(None).cast(t).alias(c) for c, t in split_columns.items()]))
            break
        encoded, shares = _shared_out(data, categorical, classes[1])
        encoded = cut_lineage(encoded)
        scores = split_scores(encoded, list(names), criterion, list(classes))
        scores = scores.replace(names, subset=["feature"])
        best = cut_lineage(best_split(scores).where(F.col("gain") > MIN_GAIN * (F.col("gain") + F.col("impurity")))
                           .select("node", "feature", F.col("threshold").alias("bound"), "gain"))
        sets = None
        for c, by in shares.items():
            left = (by.join(best.where(F.col("feature") == c), "node").where(F.col("share") <= F.col("bound"))
                    .groupBy("node").agg(F.array_sort(F.collect_list("category")).alias("categories"),
                                         F.max(F.col("category").isNull()).alias("null_left")))
            sets = left if sets is None else sets.unionByName(left)
        if sets is None:
            best = best.withColumns({"categories": F.lit(None).cast("array<string>"), "null_left": F.lit(None).cast("boolean")})
        else:
            best = best.join(sets, "node", "left")
        best = cut_lineage(best.select(
            "node", "feature", F.when(F.col("categories").isNull(), F.col("bound")).alias("threshold"), "categories",
            F.coalesce("null_left", F.lit(False)).alias("null_left"), "gain"))
        levels.append(stats.join(best, "node", "left").select("node", "depth", "n", "prediction", *split_columns))
        data = _descend(data, best, numeric, categorical, "inner").select(*data.columns)
    return reduce(DataFrame.unionByName, levels)


def _descend(data: DataFrame, splits: DataFrame, numeric: list[str], categorical: list[str], how: str) -> DataFrame:
    """``data`` with ``node`` moved to the child; without a split (``how`` left) it stays."""
    word = F.coalesce(*[F.when(F.col("feature") == c, F.col(c).cast("string")) for c in categorical], F.lit(None).cast("string"))
    number = F.coalesce(*[F.when(F.col("feature") == f, F.col(f).cast("double")) for f in numeric], F.lit(None).cast("double"))
    left = F.when(F.col("categories").isNull(), F.coalesce(number <= F.col("threshold"), F.lit(False))) \
        .when(word.isNull(), F.col("null_left")).otherwise(F.array_contains("categories", word))
    child = F.col("node") * 2 + F.when(left, 0).otherwise(1)
    routed = data.join(splits.select("node", "feature", "threshold", "categories", "null_left"), "node", how)
    return routed.withColumn("node", F.when(F.col("feature").isNull(), F.col("node")).otherwise(child)) \
        .drop("feature", "threshold", "categories", "null_left")


def predict_mixed(df: DataFrame, nodes: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """``df`` with ``node`` and ``prediction`` of ``fit_mixed``'s table, a join a level.

    A category that the node has not seen in training goes right.
    """
    nodes = cut_lineage(nodes)
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    data = df.withColumn("node", F.lit(1).cast("long"))
    for depth in range(deepest):
        data = _descend(data, nodes.where((F.col("depth") == depth) & F.col("feature").isNotNull()), numeric, categorical, "left")
    return data.join(nodes.select("node", "prediction"), "node", "left")


def route(df: DataFrame, nodes: DataFrame, numeric: list[str], categorical: list[str] = ()) -> DataFrame:
    """``df`` with the leaf (``node``) and ``prediction`` that a numeric or mixed node table gives it, a join a level."""
    missing = {c: F.lit(None).cast(t) for c, t in (("categories", "array<string>"), ("null_left", "boolean")) if c not in nodes.columns}
    return predict_mixed(df, nodes.withColumns(missing) if missing else nodes, numeric, list(categorical))


def predict(df: DataFrame, nodes: DataFrame) -> Column:
    """The fitted node table as one ``when`` chain (a Column).

    The node table has at most 2^(depth+1) - 1 rows, so it is collected and
    compiled into a nested CASE expression evaluated inside codegen.
    """
    table = {r["node"]: r for r in nodes.collect()}

    def build(node: int) -> Column:
        r = table[node]
        if r["feature"] is None or (2 * node) not in table:
            return F.lit(float(r["prediction"]))
        return F.when(F.col(r["feature"]).cast("double") <= F.lit(float(r["threshold"])),
                      build(2 * node)).otherwise(build(2 * node + 1))

    return build(1)


def importance(nodes: DataFrame) -> DataFrame:
    """Per-feature share of the total size-weighted impurity decrease."""
    inner = nodes.where(F.col("feature").isNotNull())
    dec = inner.groupBy("feature").agg(F.sum(F.col("gain") * F.col("n")).alias("dec"))
    total = inner.select(F.sum(F.col("gain") * F.col("n"))).scalar()
    return dec.select("feature", (F.col("dec") / total).alias("importance"))


def fit_ml(train: DataFrame, test: DataFrame, features: list[str], max_depth: int,
           task: str = "classification", seed: int = 42) -> DataFrame:
    """Spark ML trees (quantile-binned thresholds); (id, actual, predicted)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import DecisionTreeRegressor

    va = VectorAssembler(inputCols=features, outputCol="features")
    if task == "classification":
        est = DecisionTreeClassifier(labelCol="label", maxDepth=max_depth, seed=seed)
    else:
        est = DecisionTreeRegressor(labelCol="label", maxDepth=max_depth, seed=seed)
    prep = lambda d: d.withColumn("label", F.col("y").cast("double"))
    model = Pipeline(stages=[va, est]).fit(prep(train))
    out = model.transform(prep(test))
    if task == "classification":
        return out.select("id", F.col("y").cast("int").alias("actual"),
                          F.col("prediction").cast("int").alias("predicted"))
    return out.select("id", F.col("y").alias("actual"), F.col("prediction").alias("predicted"))
