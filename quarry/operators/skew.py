"""Hot-key handling for joins whose output is quadratic in a key's size.

Pair generation (items of one basket, items of one user) joins a frame with
itself on the group key.  A key holding a large share of all rows would put
size² work in one task, and AQE's skew-join split cannot act here because an
aggregate sits between the shuffle and the join.  So keys are split
explicitly:

* cold keys (at most ``hot_rows`` rows on either side) join on the key alone,
  reusing the existing hash partitioning on the key (no new shuffle);
* hot keys get as many salts per side as it has multiples of ``hot_rows``: a
  left row with salt i is replicated to every (i, j), a right row with salt j
  to every (i, j), and the join on (key, i, j) meets every pair exactly once
  in a task of at most about ``hot_rows``² pairs.

Nothing is dropped or sampled; the union of both paths is the exact join.

When the caller can bound the rows of every key on both sides (after
de-duplication a basket holds at most as many rows as there are distinct
items), and that bound is at most ``hot_rows``, no key can be hot and the
plain co-partitioned join is used (``max_key_rows``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import cut_lineage

# A key with more rows than this on a side is split.
HOT_KEY_ROWS = 10_000


def plain_join(left: DataFrame, right: DataFrame, key: str, cond) -> DataFrame:
    """``left ⋈ right`` on ``key`` plus ``cond``, with the output layout of
    ``hot_split_join``."""
    lcols = [c for c in left.columns if c != key]
    rcols = [c for c in right.columns if c != key]
    on = (F.col(f"l.{key}") == F.col(f"r.{key}")) & cond(F.col, "l", "r")
    return (left.alias("l").join(right.alias("r"), on)
            .select(F.col(f"l.{key}").alias(key), *[F.col(f"l.{c}") for c in lcols],
                    *[F.col(f"r.{c}") for c in rcols]))


def hot_split_join(left: DataFrame, right: DataFrame, key: str, cond,
                   left_hash: str, right_hash: str,
                   hot_rows: int = HOT_KEY_ROWS,
                   max_key_rows: int | None = None) -> DataFrame:
    """Inner join ``left ⋈ right`` on ``key`` plus residual ``cond(col, l, r)``.

    ``left_hash``/``right_hash`` name columns that spread a hot key's rows
    (e.g. the item).  Output columns: key, left's others, right's others.

    Only the hot keys are computed (usually none); AQE broadcasts that set
    when it is small.  Cold rows are an anti-join against it on both sides.
    """
    if max_key_rows is not None and max_key_rows <= hot_rows:
        return plain_join(left, right, key, cond)
    count = F.count(F.lit(1))
    sizes = (left.groupBy(key).agg(count.alias("_left"))
             .join(right.groupBy(key).agg(count.alias("_right")), key)
             .where((F.col("_left") > hot_rows) | (F.col("_right") > hot_rows)))
    hot = cut_lineage(sizes)  # a row per hot key; read by the branches below
    lcols = [c for c in left.columns if c != key]
    rcols = [c for c in right.columns if c != key]

    def joined(lf, rf, extra=None):
        on = (F.col(f"l.{key}") == F.col(f"r.{key}")) & cond(F.col, "l", "r")
        if extra is not None:
            on = on & extra
        return (lf.alias("l").join(rf.alias("r"), on)
                .select(F.col(f"l.{key}").alias(key), *[F.col(f"l.{c}") for c in lcols],
                        *[F.col(f"r.{c}") for c in rcols]))

    names = hot.select(key)
    cold = joined(left.join(names, key, "left_anti"), right.join(names, key, "left_anti"))

    def salts(c):
        return F.ceil(F.col(c) / F.lit(hot_rows)).cast("long")

    def each(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), n - 1))

    i, j = salts("_left"), salts("_right")
    lh = left.join(hot, key).select("*", F.pmod(F.xxhash64(left_hash), i).alias("_i"), each(j).alias("_j"))
    rh = right.join(hot, key).select("*", each(i).alias("_i"), F.pmod(F.xxhash64(right_hash), j).alias("_j"))
    hot_pairs = joined(lh, rh, (F.col("l._i") == F.col("r._i")) & (F.col("l._j") == F.col("r._j")))
    return cold.unionByName(hot_pairs)
