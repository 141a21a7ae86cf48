"""Decision-tree plans on labels ⋈ documents.

Classification: y = quality, features letter_share, n_words, n_chars.
Regression: y = n_chars, features letter_share, n_words.
Train = id mod 5 != 0, test = id mod 5 == 0.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import evaluate as V
from quarry.operators import pruning as P
from quarry.operators import tree as T
from quarry.session import cut_lineage
from quarry.sources.fixtures import feature_rows

CLF_FEATURES = ["letter_share", "n_words", "n_chars"]
MIXED_CATEGORIES = ["lang"]
REG_FEATURES = ["letter_share", "n_words"]
CLASSES = [0, 1]
DEPTH = 2
PRUNE_DEPTH = 3
FOLDS = 5


def _rows(spark, sf_dir, task="classification"):
    return feature_rows(spark, sf_dir, task)


def _train_test(spark, sf_dir, task="classification"):
    return V.split(_rows(spark, sf_dir, task), "id", FOLDS)


def _root(df):
    return df.withColumn("node", F.lit(1).cast("long"))


def _scores_out(s):
    return s.select("feature", "threshold", "n_left", "n_right",
                    F.round("impurity", 6).alias("impurity"), F.round("gain", 6).alias("gain"))


def q_features(spark, sf_dir):
    return _rows(spark, sf_dir)


def q_split_gini(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    return _scores_out(T.split_scores(_root(train), CLF_FEATURES, "gini", CLASSES))


def q_split_entropy(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    return _scores_out(T.split_scores(_root(train), CLF_FEATURES, "entropy", CLASSES))


def q_split_categorical(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    s = T.split_scores_categorical(_root(train), "lang", CLASSES)
    return s.select("feature", "category", "n_left", "n_right",
                    F.round("impurity", 6).alias("impurity"), F.round("gain", 6).alias("gain"))


def q_split_variance(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir, "regression")
    return _scores_out(T.split_scores(_root(train), REG_FEATURES, "variance"))


def q_best_split(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    return _scores_out(T.best_split(T.split_scores(_root(train), CLF_FEATURES, "gini", CLASSES)))


def fitted(spark, sf_dir, task="classification"):
    train, test = _train_test(spark, sf_dir, task)
    if task == "classification":
        nodes = T.fit_levelwise(train, CLF_FEATURES, DEPTH, "gini", CLASSES)
    else:
        nodes = T.fit_levelwise(train, REG_FEATURES, DEPTH, "variance")
    return train, test, nodes


def _nodes_out(nodes):
    return nodes.select("node", "depth", "n", F.round("prediction", 6).alias("prediction"),
                        "feature", "threshold", F.round("gain", 6).alias("gain"))


def q_fit_depth2(spark, sf_dir):
    return _nodes_out(fitted(spark, sf_dir)[2])


def q_predict(spark, sf_dir):
    _, test, nodes = fitted(spark, sf_dir)
    return test.select("id", F.col("y").alias("actual"),
                       T.predict(test, nodes).cast("int").alias("predicted"))


def fitted_mixed(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    return test, T.fit_mixed(train, CLF_FEATURES, MIXED_CATEGORIES, DEPTH, "gini", CLASSES)


def q_fit_mixed(spark, sf_dir):
    nodes = fitted_mixed(spark, sf_dir)[1]
    return nodes.select("node", "depth", "n", F.round("prediction", 6).alias("prediction"), "feature", "threshold",
                        F.array_join("categories", ",").alias("categories"), F.round("gain", 6).alias("gain"))


def q_predict_mixed(spark, sf_dir):
    test, nodes = fitted_mixed(spark, sf_dir)
    return T.predict_mixed(test, nodes, CLF_FEATURES, MIXED_CATEGORIES).select(
        "id", F.col("y").alias("actual"), F.col("prediction").cast("int").alias("predicted"))


def q_prune(spark, sf_dir):
    """A deeper tree on fewer features, its weakest-link sequence, and the tree that errs least on the holdout."""
    train, test = (cut_lineage(d) for d in _train_test(spark, sf_dir))
    nodes = cut_lineage(T.fit_levelwise(train, CLF_FEATURES, PRUNE_DEPTH, "gini", CLASSES))
    routed = (T.route(d, nodes, CLF_FEATURES).select("node", "y") for d in (train, test))
    return P.prune_sequence(nodes, *routed).withColumn("alpha", F.round("alpha", 6))


def q_split_sketch(spark, sf_dir):
    """Thresholds from sketches; tests compare their scores with the exact ones."""
    train, _ = _train_test(spark, sf_dir)
    return _scores_out(T.sketched_scores(_root(cut_lineage(train)), CLF_FEATURES, "gini", CLASSES))


def q_fit_sketch(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    return _nodes_out(T.fit_levelwise(train, CLF_FEATURES, DEPTH, "gini", CLASSES, T.sketched_scores))


def q_importance(spark, sf_dir):
    nodes = fitted(spark, sf_dir)[2]
    return T.importance(nodes).select("feature", F.round("importance", 6).alias("importance"))


def q_clf_ml(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    return T.fit_ml(train, test, CLF_FEATURES, DEPTH, "classification")


def q_reg_ml(spark, sf_dir):
    train, test = _train_test(spark, sf_dir, "regression")
    return T.fit_ml(train, test, REG_FEATURES, DEPTH, "regression")


def regression_predictions(spark, sf_dir):
    _, test, nodes = fitted(spark, sf_dir, "regression")
    return test.select("id", F.col("y").alias("actual"), T.predict(test, nodes).alias("predicted"))


def q_eval_regression(spark, sf_dir):
    return V.regression(regression_predictions(spark, sf_dir))


QUERIES = {
    "tree_features": q_features,
    "tree_split_gini": q_split_gini,
    "tree_split_entropy": q_split_entropy,
    "tree_split_categorical": q_split_categorical,
    "tree_split_variance": q_split_variance,
    "tree_best_split": q_best_split,
    "tree_fit_depth2": q_fit_depth2,
    "tree_clf_ml": q_clf_ml,
    "tree_reg_ml": q_reg_ml,
    "tree_predict": q_predict,
    "tree_importance": q_importance,
    "tree_fit_mixed": q_fit_mixed,
    "tree_predict_mixed": q_predict_mixed,
    "tree_prune": q_prune,
    "sketch_tree_split": q_split_sketch,
    "sketch_tree_fit": q_fit_sketch,
    "eval_regression": q_eval_regression,
}


# ------------------------------------------------------------------ DuckDB twins
def _feat_sql(task):
    y = "quality" if task == "classification" else "CAST(n_chars AS DOUBLE)"
    return f"""feat AS (SELECT doc_id AS id,
    floor(length(regexp_replace(text, '\\P{{L}}', '', 'g')) / length(text) * 100 + 0.5) / 100 AS letter_share,
    CAST(len(regexp_extract_all(text, '(\\p{{L}}+)', 1)) AS INTEGER) AS n_words, n_chars, lang, {y} AS y
  FROM labels JOIN documents USING (doc_id)),
  train AS (SELECT * FROM feat WHERE id % {FOLDS} <> 0), test AS (SELECT * FROM feat WHERE id % {FOLDS} = 0)"""


def _plus(terms):
    return "(" + " + ".join(terms) + ")"


def _imp(kind, get, classes):
    if kind == "variance":
        return f"greatest(({get('s2')} - {get('s1')} * {get('s1')} / {get('n')}) / {get('n')}, 0.0)"
    if kind == "gini":
        return "(1.0 - " + _plus([f"({get(f'c{c}')} / {get('n')}) * ({get(f'c{c}')} / {get('n')})"
                                  for c in classes]) + ")"
    return _plus([f"(CASE WHEN {get(f'c{c}')} > 0 THEN -({get(f'c{c}')} / {get('n')}) * "
                  f"log2({get(f'c{c}')} / {get('n')}) ELSE 0.0 END)" for c in classes])


def scores_sql(name, data, features, kind, classes=CLASSES):
    """CTEs ``{name}`` = (node, feature, threshold, n_left, n_right, impurity, gain)."""
    long = " UNION ALL ".join(
        f"SELECT node, y, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM {data}" for f in features)
    if kind == "variance":
        long = (f"SELECT node, y - CASE WHEN abs(m) >= 1 THEN floor(m) ELSE CAST(CAST(m AS FLOAT) AS DOUBLE) END AS y, "
                f"feature, value FROM (SELECT *, avg(y) OVER (PARTITION BY node, feature) AS m FROM ({long}))")
        aggs = "count(*) AS n, sum(y) AS s1, sum(y * y) AS s2"
        stats = ["n", "s1", "s2"]
    else:
        aggs = ", ".join(f"count(*) FILTER (WHERE y = {c}) AS c{c}" for c in classes) + ", count(*) AS n"
        stats = [f"c{c}" for c in classes] + ["n"]
    win = ", ".join(f"sum({s}) OVER (PARTITION BY node, feature ORDER BY value NULLS LAST ROWS BETWEEN UNBOUNDED "
                    f"PRECEDING AND CURRENT ROW) AS L_{s}, sum({s}) OVER (PARTITION BY node, feature) AS T_{s}"
                    for s in stats)
    L = lambda s: f"L_{s}"
    R = lambda s: f"(T_{s} - L_{s})"
    Tt = lambda s: f"T_{s}"
    w = f"(({L('n')} / {Tt('n')}) * {_imp(kind, L, classes)} + ({R('n')} / {Tt('n')}) * {_imp(kind, R, classes)})"
    return f"""{name}_h AS (SELECT node, feature, value, {aggs} FROM ({long}) GROUP BY node, feature, value),
  {name}_c AS (SELECT node, feature, value AS threshold, {win} FROM {name}_h),
  {name} AS (SELECT node, feature, threshold, CAST(L_n AS BIGINT) AS n_left, CAST(T_n - L_n AS BIGINT) AS n_right,
    {w} AS impurity, {_imp(kind, Tt, classes)} - {w} AS gain FROM {name}_c WHERE L_n < T_n AND threshold IS NOT NULL)"""


def _best_sql(name, scores):
    return f"""{name} AS (SELECT node, feature, threshold, gain FROM (SELECT *, row_number() OVER
    (PARTITION BY node ORDER BY gain DESC, feature, threshold) AS rn FROM {scores}) WHERE rn = 1 AND gain > 1e-9 * (gain + impurity))"""


def _route(features, src, best, inner=True):
    val = "CASE b.feature " + " ".join(f"WHEN '{f}' THEN CAST(s.{f} AS DOUBLE)" for f in features) + " END"
    cols = ", ".join(f"s.{c}" for c in ["id", "y"] + features)
    if inner:
        return (f"SELECT {cols}, s.node * 2 + CASE WHEN {val} <= b.threshold THEN 0 ELSE 1 END AS node "
                f"FROM {src} s JOIN {best} b ON s.node = b.node")
    return (f"SELECT {cols}, CASE WHEN b.node IS NULL THEN s.node ELSE s.node * 2 + "
            f"CASE WHEN {val} <= b.threshold THEN 0 ELSE 1 END END AS node "
            f"FROM {src} s LEFT JOIN {best} b ON s.node = b.node")


def _stats_sql(name, data, kind, depth):
    if kind == "variance":
        return (f"{name} AS (SELECT node, {depth} AS depth, count(*) AS n, avg(y) AS prediction "
                f"FROM {data} GROUP BY node)")
    return f"""{name} AS (SELECT node, {depth} AS depth, n, prediction FROM (SELECT node, CAST(y AS DOUBLE) AS prediction,
    CAST(sum(count(*)) OVER (PARTITION BY node) AS BIGINT) AS n,
    row_number() OVER (PARTITION BY node ORDER BY count(*) DESC, y) AS rn FROM {data} GROUP BY node, y) WHERE rn = 1)"""


def tree_sql(task="classification", depth=DEPTH):
    """WITH-body defining feat/train/test, nodes (the fitted table) and pred (test predictions)."""
    features = CLF_FEATURES if task == "classification" else REG_FEATURES
    kind = "gini" if task == "classification" else "variance"
    parts = [_feat_sql(task),
             "d0 AS (SELECT id, y, " + ", ".join(features) + ", CAST(1 AS BIGINT) AS node FROM train)"]
    node_sel = []
    for lv in range(depth + 1):
        parts.append(_stats_sql(f"st{lv}", f"d{lv}", kind, lv))
        if lv == depth:
            node_sel.append(f"SELECT node, depth, n, prediction, CAST(NULL AS VARCHAR) AS feature, "
                            f"CAST(NULL AS DOUBLE) AS threshold, CAST(NULL AS DOUBLE) AS gain FROM st{lv}")
            break
        parts.append(scores_sql(f"sc{lv}", f"d{lv}", features, kind))
        parts.append(_best_sql(f"b{lv}", f"sc{lv}"))
        parts.append(f"d{lv + 1} AS ({_route(features, f'd{lv}', f'b{lv}')})")
        node_sel.append(f"SELECT st{lv}.node, depth, n, prediction, feature, threshold, gain "
                        f"FROM st{lv} LEFT JOIN b{lv} USING (node)")
    parts.append("nodes AS (" + " UNION ALL ".join(node_sel) + ")")
    parts.append("t0 AS (SELECT id, y, " + ", ".join(features) + ", CAST(1 AS BIGINT) AS node FROM test)")
    for lv in range(depth):
        parts.append(f"t{lv + 1} AS ({_route(features, f't{lv}', f'b{lv}', inner=False)})")
    parts.append(f"pred AS (SELECT t.id, t.y AS actual, nodes.prediction AS predicted FROM t{depth} t "
                 f"JOIN nodes USING (node))")
    return ",\n  ".join(parts)


def mixed_sql(depth=DEPTH):
    """As ``tree_sql``, with lang by its node's share of class 1 and the set of languages that go left."""
    cols, scored = ", ".join([*CLF_FEATURES, "lang"]), [*CLF_FEATURES, "lang"]
    parts = [_feat_sql("classification"), f"d0 AS (SELECT id, y, {cols}, CAST(1 AS BIGINT) AS node FROM train)"]
    node_sel = []
    value = "CASE b.feature " + " ".join(f"WHEN '{f}' THEN CAST(s.{f} AS DOUBLE)" for f in CLF_FEATURES) + " END"
    child = (f"s.node * 2 + CASE WHEN (CASE WHEN b.feature = 'lang' THEN list_contains(b.categories, s.lang) "
             f"ELSE {value} <= b.threshold END) THEN 0 ELSE 1 END")
    for lv in range(depth + 1):
        parts.append(_stats_sql(f"st{lv}", f"d{lv}", "gini", lv))
        if lv == depth:
            node_sel.append(f"SELECT node, depth, n, prediction, CAST(NULL AS VARCHAR) AS feature, CAST(NULL AS DOUBLE) AS threshold, "
                            f"CAST(NULL AS VARCHAR[]) AS categories, CAST(NULL AS DOUBLE) AS gain FROM st{lv}")
            break
        parts.append(f"e{lv} AS (SELECT id, y, node, {', '.join(CLF_FEATURES)}, avg(y) OVER (PARTITION BY node, lang) AS lang, lang AS word FROM d{lv})")
        parts.append(scores_sql(f"sc{lv}", f"e{lv}", scored, "gini"))
        parts.append(_best_sql(f"w{lv}", f"sc{lv}"))
        parts.append(f"l{lv} AS (SELECT w.node, list(DISTINCT word ORDER BY word) AS categories FROM w{lv} w JOIN e{lv} e "
                     f"ON e.node = w.node AND w.feature = 'lang' AND e.lang <= w.threshold GROUP BY w.node)")
        parts.append(f"b{lv} AS (SELECT w.node, feature, CASE WHEN feature <> 'lang' THEN threshold END AS threshold, categories, gain "
                     f"FROM w{lv} w LEFT JOIN l{lv} USING (node))")
        parts.append(f"d{lv + 1} AS (SELECT s.id, s.y, {', '.join('s.' + c for c in scored)}, {child} AS node "
                     f"FROM d{lv} s JOIN b{lv} b ON s.node = b.node)")
        node_sel.append(f"SELECT st{lv}.node, depth, n, prediction, feature, threshold, categories, gain FROM st{lv} LEFT JOIN b{lv} USING (node)")
    parts.append("nodes AS (" + " UNION ALL ".join(node_sel) + ")")
    parts.append(f"t0 AS (SELECT id, y, {cols}, CAST(1 AS BIGINT) AS node FROM test)")
    for lv in range(depth):
        parts.append(f"t{lv + 1} AS (SELECT s.id, s.y, {', '.join('s.' + c for c in scored)}, "
                     f"CASE WHEN b.node IS NULL THEN s.node ELSE {child} END AS node FROM t{lv} s LEFT JOIN b{lv} b ON s.node = b.node)")
    parts.append(f"pred AS (SELECT t.id, t.y AS actual, nodes.prediction AS predicted FROM t{depth} t JOIN nodes USING (node))")
    return ",\n  ".join(parts)


def prune_sql(depth=PRUNE_DEPTH):
    """All ways to prune, built level by level; a way is in the sequence if some alpha makes it the cheapest (the smallest at a tie)."""
    parts = [tree_sql(depth=depth), f"u0 AS (SELECT id, y, {', '.join(CLF_FEATURES)}, CAST(1 AS BIGINT) AS node FROM train)"]
    for lv in range(depth):
        parts.append(f"u{lv + 1} AS ({_route(CLF_FEATURES, f'u{lv}', f'b{lv}', inner=False)})")
    below = lambda rows: (f"(SELECT count(*) FROM {rows} r WHERE r.y <> n.prediction AND EXISTS (SELECT 1 FROM range({depth + 1}) k(i) "  # noqa: E731
                          f"WHERE r.node >> CAST(k.i AS INTEGER) = n.node))")
    parts.append(f"judged AS (SELECT node, depth, feature, {below(f'u{depth}')} AS e, {below(f't{depth}')} AS h FROM nodes n)")
    for lv in range(depth, -1, -1):
        ways = f"SELECT node, e, h, 1 AS m FROM judged WHERE depth = {lv}"
        if lv < depth:
            ways += (f" UNION SELECT n.node, l.e + r.e, l.h + r.h, l.m + r.m FROM judged n JOIN way{lv + 1} l ON l.node = 2 * n.node "
                     f"JOIN way{lv + 1} r ON r.node = 2 * n.node + 1 WHERE n.depth = {lv} AND n.feature IS NOT NULL")
        parts.append(f"way{lv} AS ({ways})")
    parts.append("""priced AS (SELECT a.e, a.h, a.m,
      greatest(0.0, coalesce((SELECT max((a.e - b.e) / (b.m - a.m)) FROM way0 b WHERE b.m > a.m), 0.0)) AS alpha,
      (SELECT min((b.e - a.e) / (a.m - b.m)) FROM way0 b WHERE b.m < a.m) AS until,
      (SELECT min(b.e) FROM way0 b WHERE b.m = a.m) AS least FROM way0 a),
  trees AS (SELECT * FROM priced WHERE e = least AND (until IS NULL OR alpha < until))""")
    return ",\n  ".join(parts)


_ROOT_CLF = f"{_feat_sql('classification')}, r AS (SELECT *, 1 AS node FROM train)"
_SCORE_COLS = "feature, threshold, n_left, n_right, round(impurity, 6) AS impurity, round(gain, 6) AS gain"

ORACLE = {
    "tree_features": f"WITH {_feat_sql('classification')} SELECT id, letter_share, n_words, n_chars, lang, y FROM feat",
    "tree_split_gini": f"WITH {_ROOT_CLF}, {scores_sql('s', 'r', CLF_FEATURES, 'gini')} SELECT {_SCORE_COLS} FROM s",
    "tree_split_entropy": f"WITH {_ROOT_CLF}, {scores_sql('s', 'r', CLF_FEATURES, 'entropy')} SELECT {_SCORE_COLS} FROM s",
    "tree_split_categorical": f"""WITH {_ROOT_CLF},
  h AS (SELECT lang AS category, count(*) FILTER (WHERE y = 0) AS c0, count(*) FILTER (WHERE y = 1) AS c1,
        count(*) AS n FROM r GROUP BY lang),
  t AS (SELECT category, c0 AS L_c0, c1 AS L_c1, n AS L_n, sum(c0) OVER () AS T_c0, sum(c1) OVER () AS T_c1,
        sum(n) OVER () AS T_n FROM h),
  s AS (SELECT 'lang' AS feature, category, L_n AS n_left, CAST(T_n - L_n AS BIGINT) AS n_right,
        (L_n / T_n) * {_imp('gini', lambda s: f'L_{s}', CLASSES)} +
        ((T_n - L_n) / T_n) * {_imp('gini', lambda s: f'(T_{s} - L_{s})', CLASSES)} AS impurity,
        {_imp('gini', lambda s: f'T_{s}', CLASSES)} AS parent FROM t WHERE L_n < T_n)
  SELECT feature, category, n_left, n_right, round(impurity, 6) AS impurity, round(parent - impurity, 6) AS gain FROM s""",
    "tree_split_variance": f"""WITH {_feat_sql('regression')}, r AS (SELECT *, 1 AS node FROM train),
  {scores_sql('s', 'r', REG_FEATURES, 'variance')} SELECT {_SCORE_COLS} FROM s""",
    "tree_best_split": f"""WITH {_ROOT_CLF}, {scores_sql('s', 'r', CLF_FEATURES, 'gini')}
  SELECT {_SCORE_COLS} FROM s ORDER BY gain DESC, feature, threshold LIMIT 1""",
    "tree_fit_depth2": f"""WITH {tree_sql()} SELECT node, CAST(depth AS INTEGER) AS depth, n, round(prediction, 6) AS prediction,
  feature, threshold, round(gain, 6) AS gain FROM nodes""",
    "tree_predict": f"WITH {tree_sql()} SELECT id, actual, CAST(predicted AS INTEGER) AS predicted FROM pred",
    "tree_importance": f"""WITH {tree_sql()}, inner_nodes AS (SELECT * FROM nodes WHERE feature IS NOT NULL)
  SELECT feature, round(sum(gain * n) / (SELECT sum(gain * n) FROM inner_nodes), 6) AS importance
  FROM inner_nodes GROUP BY feature""",
    "tree_fit_mixed": f"""WITH {mixed_sql()} SELECT node, CAST(depth AS INTEGER) AS depth, n, round(prediction, 6) AS prediction,
  feature, threshold, array_to_string(categories, ',') AS categories, round(gain, 6) AS gain FROM nodes""",
    "tree_predict_mixed": f"WITH {mixed_sql()} SELECT id, actual, CAST(predicted AS INTEGER) AS predicted FROM pred",
    "tree_prune": f"""WITH {prune_sql()} SELECT round(alpha, 6) AS alpha, CAST(m AS BIGINT) AS leaves, CAST(e AS BIGINT) AS train_errors,
  CAST(h AS BIGINT) AS holdout_errors, row_number() OVER (ORDER BY h, alpha DESC) = 1 AS chosen FROM trees""",
    "eval_regression": f"""WITH {tree_sql('regression')}, m AS (SELECT avg(actual) AS mu FROM pred)
  SELECT count(*) AS n, round(sqrt(sum((actual - predicted) * (actual - predicted)) / count(*)), 6) AS rmse,
    round(sum(abs(actual - predicted)) / count(*), 6) AS mae,
    round(CASE WHEN sum((actual - (SELECT mu FROM m)) * (actual - (SELECT mu FROM m))) = 0 THEN 0.0 ELSE
      1 - sum((actual - predicted) * (actual - predicted)) /
      sum((actual - (SELECT mu FROM m)) * (actual - (SELECT mu FROM m))) END, 6) AS r2 FROM pred""",
}
