"""Relational building blocks used by the SQL analysis plans (S group).

Per-group statistics start from counts per (group, value), which combine on
the map side: a group holding a third of all rows has one row per distinct
value from then on.  Ranks and quantiles are running totals over those values
(``prefix``).  A window over a group is used only for top-k per group, where
the ``row_number() <= k`` filter sits directly above it so Spark plans a
partial ``WindowGroupLimit`` before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.operators.prefix import running_totals


def _order(by: list, ties: list) -> list[Column]:
    cols = []
    for c in by:
        if isinstance(c, str):
            cols.append(F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc())
        else:
            cols.append(c)
    return cols + [F.col(t).asc() for t in ties]


def top_k(df: DataFrame, by: list, k: int, ties: list) -> DataFrame:
    """Global top-k (``-col`` = descending); planned as TakeOrderedAndProject."""
    return df.orderBy(*_order(by, ties)).limit(k)


def top_per_group(df: DataFrame, group: list, by: list, k: int, ties: list,
                  rank_col: str = "rnk") -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*_order(by, ties))
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def value_counts(df: DataFrame, group: list, value: str) -> DataFrame:
    """(group, value, n): how often each value occurs; combines before the shuffle.

    Whatever share of the rows a group holds, it has one row per distinct
    value here, and every statistic below is exact on it.
    """
    return df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("n"))


def above_mean(counts: DataFrame, group: list, value: str) -> DataFrame:
    """(group, n_ratings, n_above) from ``value_counts``: rows above their group's mean."""
    v, n = F.col(value), F.col("n")
    means = counts.groupBy(*group).agg((F.sum(v * n) / F.sum(F.when(v.isNotNull(), n))).alias("mean_value"))
    return counts.join(means, group).groupBy(*group).agg(
        F.sum("n").alias("n_ratings"),
        F.coalesce(F.sum(F.when(v > F.col("mean_value"), n)), F.lit(0)).alias("n_above"))


def ranks(df: DataFrame, group: list, value: str) -> DataFrame:
    """Rows of ``df`` with ``rnk`` and ``dense_rnk`` by ``value`` descending within ``group``.

    Ranks come from running totals over the distinct values, not from a
    window over the group.
    """
    hist = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("m"), F.lit(1).cast("bigint").alias("d"))
    run = running_totals(hist, group, value, ["m", "d"]).select(
        *group, value, (F.col("T_m") - F.col("L_m") + 1).cast("int").alias("rnk"),
        (F.col("T_d") - F.col("L_d") + 1).cast("int").alias("dense_rnk"))
    return df.join(run, [*group, value])


def summary(counts: DataFrame, group: list, value: str, probs: dict[str, float]) -> DataFrame:
    """(group, n, mean, sd, quantiles) from materialised ``value_counts`` of non-null values.

    Quantiles interpolate linearly between the two nearest ranks; the value
    at a rank is the least one whose running count exceeds it.  The sum of
    squares is taken around the group's mean.
    """
    v, n = F.col(value), F.col("n")
    mean = counts.groupBy(*group).agg(F.sum("n").alias("n_rows"), (F.sum(v * n) / F.sum("n")).alias("mean"))
    spread = counts.join(mean, group).groupBy(*group, "n_rows", "mean").agg(
        F.sqrt(F.try_divide(F.sum(n * (v - F.col("mean")) * (v - F.col("mean"))), F.col("n_rows") - 1)).alias("sd"))
    run = running_totals(counts, group, value, ["n"])
    aggs = []
    for name, p in probs.items():
        h = (F.col("T_n") - 1) * F.lit(p)
        at = lambda k: F.min(F.when(F.col("L_n") > k, v))
        lo, hi = at(F.floor(h)), at(F.ceil(h))
        aggs.append((lo + (hi - lo) * F.max(h - F.floor(h))).alias(name))
    return spread.join(run.groupBy(*group).agg(*aggs), group)
