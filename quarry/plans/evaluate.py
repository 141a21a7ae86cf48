"""Evaluation plans: measures applied to the Naive Bayes test predictions
(classification), their log-odds (ranking) and the depth-2 regression tree
(regression)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import evaluate as V
from quarry.operators import ranking as R
from quarry.plans import bayes as PB
from quarry.sources.fixtures import labelled_text


def q_split(spark, sf_dir):
    df = labelled_text(spark, sf_dir)
    train, test = V.split(df, "id", PB.FOLDS)
    return (train.select("id", "y", F.lit(False).alias("is_test"))
            .unionByName(test.select("id", "y", F.lit(True).alias("is_test"))))


def q_confusion(spark, sf_dir):
    return V.confusion(PB.nb_predictions(spark, sf_dir))


def q_class_metrics(spark, sf_dir):
    return V.class_metrics(PB.nb_predictions(spark, sf_dir))


def q_majority(spark, sf_dir):
    _, test = V.split(labelled_text(spark, sf_dir), "id", PB.FOLDS)
    return V.majority(test.select(F.col("y").alias("actual")))


def _log_odds(spark, sf_dir):
    """(actual, score) of the test documents: the log-odds of class 1, to 6 digits."""
    test, s = PB.bernoulli_scores(spark, sf_dir)
    signed = F.when(F.col("y") == 1, F.col("score")).otherwise(-F.col("score"))
    odds = s.where(F.col("y").isin(0, 1)).groupBy("id").agg(F.round(F.sum(signed), 6).alias("score"))
    return odds.join(test.select("id", F.col("y").alias("actual")), "id").select("actual", "score")


def q_ranking(spark, sf_dir):
    return R.measures(_log_odds(spark, sf_dir)).select(
        "n", "n_pos", F.round("auc", 6).alias("auc"), F.round("average_precision", 6).alias("average_precision"))


def q_pr_curve(spark, sf_dir):
    return R.precision_recall(_log_odds(spark, sf_dir))


_LOG_ODDS = f"""{PB.FIT}, lo AS (SELECT a.id, round(a.score - b.score, 6) AS score, txt.y AS actual
  FROM sc a JOIN sc b ON a.id = b.id AND a.y = 1 AND b.y = 0 JOIN txt ON txt.id = a.id)"""

QUERIES = {
    "eval_split": q_split,
    "eval_confusion": q_confusion,
    "eval_class_metrics": q_class_metrics,
    "eval_majority": q_majority,
    "eval_ranking": q_ranking,
    "eval_pr_curve": q_pr_curve,
}

ORACLE = {
    "eval_split": f"""SELECT doc_id AS id, toxic AS y, doc_id % {PB.FOLDS} = 0 AS is_test
  FROM labels JOIN documents USING (doc_id)""",
    "eval_confusion": f"WITH {PB.FIT} SELECT actual, predicted, count(*) AS n FROM pa GROUP BY 1, 2",
    "eval_class_metrics": f"""WITH {PB.FIT},
  cm AS (SELECT actual, predicted, count(*) AS n FROM pa GROUP BY 1, 2),
  act AS (SELECT actual AS label, sum(n) AS n_actual FROM cm GROUP BY 1),
  prd AS (SELECT predicted AS label, sum(n) AS n_predicted FROM cm GROUP BY 1),
  tp AS (SELECT actual AS label, n AS tp FROM cm WHERE actual = predicted),
  j AS (SELECT coalesce(act.label, prd.label) AS label, coalesce(n_actual, 0) AS na,
        coalesce(n_predicted, 0) AS np FROM act FULL JOIN prd ON act.label = prd.label)
  SELECT j.label, CAST(na AS BIGINT) AS n_actual, CAST(np AS BIGINT) AS n_predicted,
         CAST(coalesce(tp, 0) AS BIGINT) AS tp,
         CASE WHEN np = 0 THEN 0.0 ELSE coalesce(tp, 0) / np END AS precision,
         CASE WHEN na = 0 THEN 0.0 ELSE coalesce(tp, 0) / na END AS recall,
         CASE WHEN na + np = 0 THEN 0.0 ELSE 2 * coalesce(tp, 0) / (na + np) END AS f1,
         (SELECT sum(n) FROM cm WHERE actual = predicted) / (SELECT sum(n) FROM cm) AS accuracy
  FROM j LEFT JOIN tp ON tp.label = j.label""",
    "eval_majority": f"""WITH t AS (SELECT toxic AS label FROM labels JOIN documents USING (doc_id)
  WHERE doc_id % {PB.FOLDS} = 0), c AS (SELECT label, count(*) AS n_label FROM t GROUP BY label)
  SELECT label AS majority_label, n_label, (SELECT count(*) FROM t) AS n,
         n_label / (SELECT count(*) FROM t) AS accuracy FROM c
  ORDER BY n_label DESC, label LIMIT 1""",
    "eval_ranking": f"""WITH {_LOG_ODDS},
  rk AS (SELECT actual, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS place,
         sum(CASE WHEN actual = 1 THEN 1 ELSE 0 END) OVER (ORDER BY score DESC) / count(*) OVER (ORDER BY score DESC) AS p
         FROM lo),
  s AS (SELECT count(*) AS n, count(*) FILTER (WHERE actual = 1) AS n_pos,
        sum(place) FILTER (WHERE actual = 1) AS places, avg(p) FILTER (WHERE actual = 1) AS ap FROM rk)
  SELECT n, n_pos, round((places - n_pos * (n_pos + 1) / 2) / (n_pos * (n - n_pos)), 6) AS auc,
         round(ap, 6) AS average_precision FROM s""",
    "eval_pr_curve": f"""WITH {_LOG_ODDS},
  t AS (SELECT score, count(*) FILTER (WHERE actual = 1) AS p, count(*) FILTER (WHERE actual <> 1) AS m FROM lo GROUP BY score),
  c AS (SELECT score, CAST(sum(p) OVER w AS BIGINT) AS tp, CAST(sum(m) OVER w AS BIGINT) AS fp,
        (SELECT sum(p) FROM t) AS np, (SELECT sum(m) FROM t) AS nn FROM t WINDOW w AS (ORDER BY score DESC))
  SELECT score AS threshold, tp, fp, tp / (tp + fp) AS precision, tp / np AS recall, fp / nn AS fall_out FROM c""",
}
