"""Ranking measures of scores (V6): precision-recall sweep, area under the ROC curve, average precision.

Scored rows are (actual, score).  They are counted per distinct score first,
and running totals (``prefix``) go over those counts, so no window holds more
than a range of scores, and rows of equal score stand together: no measure
depends on the order of ties.

Defined results: rows with a null label or a null or NaN score take no part; a
measure whose denominator is zero (no positive, or no negative) is null; an
empty table gives no sweep and one row of measures with n = 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.prefix import running_totals
from quarry.session import cut_lineage


def sweep(scored: DataFrame, positive=1) -> DataFrame:
    """(threshold, n_pos, n_neg, tp, fp, total_pos, total_neg): a row per distinct score.

    ``n_pos``/``n_neg`` have exactly this score, ``tp``/``fp`` this or a higher one.
    """
    used = scored.where(F.col("actual").isNotNull() & F.col("score").isNotNull() & ~F.isnan("score"))
    hit = (F.col("actual") == positive).cast("long")
    own = cut_lineage(used.groupBy((-F.col("score").cast("double")).alias("down"))
                      .agg(F.sum(hit).alias("n_pos"), F.sum(1 - hit).alias("n_neg")))
    totals = running_totals(own, [], "down", ["n_pos", "n_neg"])
    return own.join(totals, "down").select(
        (-F.col("down")).alias("threshold"), "n_pos", "n_neg", F.col("L_n_pos").alias("tp"), F.col("L_n_neg").alias("fp"),
        F.col("T_n_pos").alias("total_pos"), F.col("T_n_neg").alias("total_neg"))


def precision_recall(scored: DataFrame, positive=1) -> DataFrame:
    """(threshold, tp, fp, precision, recall, fall_out) of calling every row at or above a threshold positive."""
    tp, fp = F.col("tp"), F.col("fp")
    return sweep(scored, positive).select(
        "threshold", "tp", "fp", (tp / (tp + fp)).alias("precision"),
        F.try_divide(tp, F.col("total_pos")).alias("recall"), F.try_divide(fp, F.col("total_neg")).alias("fall_out"))


def measures(scored: DataFrame, positive=1) -> DataFrame:
    """One row: n, n_pos, auc, average_precision.

    ``auc`` is the share of (positive, negative) pairs in which the positive
    scores higher, ties counting half: the rank-sum statistic.
    ``average_precision`` is the mean over positives of the precision at their
    own score.
    """
    pos, neg = F.col("n_pos"), F.col("n_neg")
    below = F.col("total_neg") - F.col("fp")
    # counts reach beyond 2^53 only as products; those are summed as decimals
    wins = pos.cast("decimal(19,0)") * (2 * below + neg).cast("decimal(19,0)")
    sums = sweep(scored, positive).agg(
        F.coalesce(F.sum(pos + neg), F.lit(0)).alias("n"), F.coalesce(F.sum(pos), F.lit(0)).alias("n_pos"),
        F.sum(wins).cast("double").alias("wins"),
        F.sum(pos * (F.col("tp") / (F.col("tp") + F.col("fp")))).alias("gained"))
    n_pos = F.col("n_pos").cast("double")
    return sums.select(
        "n", "n_pos", F.try_divide("wins", 2 * n_pos * (F.col("n") - F.col("n_pos"))).alias("auc"),
        F.try_divide("gained", n_pos).alias("average_precision"))
