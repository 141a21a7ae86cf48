"""Distinct counts that roll up (S21): a sketch per cell, united for every coarser level.

Distinct counts don't add up over cells, HyperLogLog sketches do: the union of
the cells' sketches is the sketch of all their rows.  So rows are read once, and any level
is a union over the written cells.  The standard error is about
1.04 / sqrt(2 ** lg_k), 1.6 % at the default of 12; small counts are all but exact.  A
sketch takes at most about 2 ** lg_k bytes, whatever it counted, and partial
aggregates merge before the shuffle, so a hot cell sends one sketch a partition.

Defined results: a null ``who`` is not counted, and a cell with no other has 0; a null
key is a cell of its own, told from a rolled-up one by ``level``; repeated rows
change nothing; an empty table gives no rows at any level.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12


def sketches(df: DataFrame, keys: list[str], who: str, lg_k: int = LG_K) -> DataFrame:
    """(keys, sketch): one sketch of the distinct ``who`` of each cell."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(F.col(who).cast("string"), F.lit(lg_k)).alias("sketch"))


def roll_up(cells: DataFrame, levels: list[list[str]], keys: list[str]) -> DataFrame:
    """(keys, level, n_distinct) of every level of ``levels``, keys outside the level null; ``level`` names those in it."""
    out = cells.groupingSets([[F.col(k) for k in level] for level in levels], *keys).agg(
        F.hll_union_agg("sketch").alias("sketch"), F.concat_ws(
            ",", *[F.when(F.grouping(k) == 0, F.lit(k)) for k in keys]).alias("level"))
    return out.select(*keys, "level", F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)).cast("long").alias("n_distinct"))
