"""Exact running totals and dense numbers without unbounded windows.

Rows are range-sorted over the shuffle partitions; totals per range and group
are summed over the ranges (one row per range), and a window runs only inside
a range.  So no window holds more than a range's rows, or one row per range,
however many rows a group has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.session import cut_lineage


def running_totals(rows: DataFrame, keys: list[str], order: str, stats: list[str]) -> DataFrame:
    """Running sums ``L_<s>`` (``order`` values up to the row's) and totals
    ``T_<s>`` of every ``stats`` column within ``keys``.

    ``rows`` has one row per distinct ``order`` value of a group.  Output:
    keys, order, L_*, T_*.
    """
    # the ranges come from a sample, so they are fixed once for both branches
    h = cut_lineage(rows.select(*keys, order, *[F.col(f"`{s}`") for s in stats])
                    .repartitionByRange(*keys, order).withColumn("_range", F.spark_partition_id()))
    by_range = h.groupBy(*keys, "_range").agg(*[F.sum(F.col(f"`{s}`")).alias(f"_b_{s}") for s in stats])
    grp = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = grp.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_range.select(
        *keys, "_range",
        *[F.coalesce(F.sum(f"_b_{s}").over(before), F.lit(0)).alias(f"_o_{s}") for s in stats],
        *[F.sum(f"_b_{s}").over(grp).alias(f"T_{s}") for s in stats])
    run = Window.partitionBy(*keys, "_range").orderBy(order) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = h.select(*keys, "_range", order, *[F.sum(F.col(f"`{s}`")).over(run).alias(f"_r_{s}") for s in stats])
    null_safe = None
    for c in [*keys, "_range"]:
        one = within[c].eqNullSafe(offsets[c])
        null_safe = one if null_safe is None else null_safe & one
    j = within.join(offsets, null_safe).select(*[within[c] for c in [*keys, order]],
                                               *[F.col(f"_{p}_{s}") for p in "ro" for s in stats],
                                               *[F.col(f"T_{s}") for s in stats])
    return j.select(*keys, order, *[(F.col(f"_o_{s}") + F.col(f"_r_{s}")).alias(f"L_{s}") for s in stats],
                    *[F.col(f"T_{s}") for s in stats])


def dense_index(df: DataFrame, col: str, out: str) -> DataFrame:
    """(col, out): the distinct non-null values, numbered 0, 1, ... in order."""
    values = df.select(col).where(F.col(col).isNotNull()).distinct().withColumn("one", F.lit(1).cast("bigint"))
    return running_totals(values, [], col, ["one"]).select(col, (F.col("L_one") - 1).alias(out))
