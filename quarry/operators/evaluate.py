"""Shared evaluation measures (V1-V5).

Predictions are (id, actual, predicted).  Everything reduces to the
confusion matrix first (at most classes² rows), so the metric arithmetic
runs on a bounded frame whatever the number of predictions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.session import cut_lineage


def split(df: DataFrame, key: str, k: int = 5, test_fold: int = 0) -> tuple[DataFrame, DataFrame]:
    """V1: deterministic split on ``key mod k`` (repeatable by any engine)."""
    is_test = F.pmod(F.col(key), F.lit(k)) == test_fold
    return df.where(~is_test), df.where(is_test)


def confusion(pred: DataFrame) -> DataFrame:
    """V2: counts per (actual, predicted)."""
    return pred.groupBy("actual", "predicted").agg(F.count("*").alias("n"))


def class_metrics(pred: DataFrame) -> DataFrame:
    """V3: per label precision, recall, F1 (0/0 -> 0) and overall accuracy.

    All measures are ratios of integer counts (F1 = 2tp / (2tp + fp + fn)).
    """
    cm = cut_lineage(confusion(pred))  # read by six branches
    act = cm.groupBy(F.col("actual").alias("label")).agg(F.sum("n").alias("n_actual"))
    prd = cm.groupBy(F.col("predicted").alias("label")).agg(F.sum("n").alias("n_predicted"))
    tp = cm.where(F.col("actual") == F.col("predicted")).select(F.col("actual").alias("label"),
                                                                 F.col("n").alias("tp"))
    total = cm.select(F.sum("n")).scalar()
    correct = cm.where(F.col("actual") == F.col("predicted")).select(F.sum("n")).scalar()
    j = act.join(prd, "label", "full").join(tp, "label", "left")
    z = F.lit(0)
    tpc = F.coalesce(F.col("tp"), z)
    na = F.coalesce(F.col("n_actual"), z)
    npd = F.coalesce(F.col("n_predicted"), z)

    def ratio(a, b):
        return F.when(b == 0, F.lit(0.0)).otherwise(a / b)

    return j.select(
        "label", na.cast("bigint").alias("n_actual"), npd.cast("bigint").alias("n_predicted"),
        tpc.cast("bigint").alias("tp"),
        ratio(tpc, npd).alias("precision"), ratio(tpc, na).alias("recall"),
        ratio(2 * tpc, na + npd).alias("f1"),
        (F.coalesce(correct, z) / total).alias("accuracy"))


def regression(pred: DataFrame) -> DataFrame:
    """V4: RMSE, MAE and R² of numeric predictions (one row)."""
    pred = cut_lineage(pred)  # read for the mean and for the sums
    mean_a = pred.select(F.avg("actual")).scalar()
    err = F.col("actual") - F.col("predicted")
    agg = pred.agg(F.count("*").alias("n"),
                   F.sum(err * err).alias("ss_res"),
                   F.sum(F.abs(err)).alias("sae"),
                   F.sum((F.col("actual") - mean_a) ** 2).alias("ss_tot"))
    return agg.select(
        "n",
        F.round(F.sqrt(F.col("ss_res") / F.col("n")), 6).alias("rmse"),
        F.round(F.col("sae") / F.col("n"), 6).alias("mae"),
        F.round(F.when(F.col("ss_tot") == 0, F.lit(0.0))
                .otherwise(1 - F.col("ss_res") / F.col("ss_tot")), 6).alias("r2"))


def majority(labels: DataFrame, col: str = "actual") -> DataFrame:
    """V5: majority-class baseline (ties to the lower label) and its accuracy."""
    counts = labels.groupBy(F.col(col).alias("label")).agg(F.count("*").alias("n_label"))
    total = labels.select(F.count("*")).scalar()
    w = Window.orderBy(F.col("n_label").desc(), F.col("label").asc())  # over <= #classes rows
    return (counts.withColumn("rn", F.row_number().over(w)).where("rn = 1")
            .select(F.col("label").alias("majority_label"), "n_label",
                    total.alias("n"), (F.col("n_label") / total).alias("accuracy")))
