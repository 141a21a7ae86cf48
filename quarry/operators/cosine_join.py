"""Item pairs of a cosine similarity above a threshold, from heads of their vectors (M5 thresholded).

Item vectors are scaled to length 1 and their components put in one order of
users, those with few ratings first.  An item's head ends where the length of
the rest falls below the threshold.  Of two items the one whose head ends first
has a rest that meets the other in a product below the threshold, so a pair at
or above it shares a user of both heads.  Components are packed in pieces of a few
bytes each and dealt to blocks of whole items; every two blocks meet in one task,
which reads both and makes pairs from the heads alone, a bounded number at a time.
So neither pairs nor lists of a user's items are shuffled or written: what is stored
grows with the number of components.  A pair carries its product over the shared
heads; the length of that rest, times what the other item has left after the last
shared user, bounds what is missing.  Pairs that can't reach the threshold go, the
others get their whole product, in the same task.

Defined results: ratings that are null or not finite take no part; an item
whose ratings are all zero has no direction and no pairs; of repeated
(user, item) rows the mean counts; the threshold lies above 0 and up to 1.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType
from pyspark.sql.window import Window

from quarry.operators.prefix import running_totals
from quarry.session import cut_lineage

#: Slack of the bounds, above what sums of unit vectors' products lose to rounding.
SLACK = 1e-6
#: Steps that lengths are rounded up to in the blocks, to fit a byte.
STEPS = 126
#: Users are ordered by the ratings of the hash bucket they are in, of so many.
BUCKETS = 1 << 16
#: Components of a block and of a packed piece at most, unless one item has more; and products made at a time,
#: unless one item makes more.
BLOCK_ROWS = 2_000_000
PIECE_ROWS = 1 << 16
PRODUCTS = 1 << 20


def unit_vectors(r: DataFrame) -> DataFrame:
    """(item, place, x, rating, length): components ``x`` of unit length vectors, ``rating`` / ``length``;
    ``place`` orders users, those in buckets with few ratings first.

    ``r`` hash-partitioned by item is not shuffled again.
    """
    finite = F.col("rating").isNotNull() & ~F.isnan("rating") & (F.abs("rating") != float("inf"))
    r = (r.select("user", "item", F.col("rating").cast("double").alias("rating"))
         .where(finite & F.col("user").isNotNull() & F.col("item").isNotNull())
         .groupBy("user", "item").agg(F.avg("rating").alias("rating"))
         .withColumn("bucket", F.pmod(F.xxhash64("user"), F.lit(BUCKETS))))
    sizes = r.groupBy("bucket").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("item").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (r.join(F.broadcast(sizes), "bucket").select("item", F.struct("n", "user").alias("place"), "rating")
            .withColumn("length", F.sqrt(F.sum(F.col("rating") * F.col("rating")).over(whole))).where("length > 0")
            .select("item", "place", (F.col("rating") / F.col("length")).alias("x"), "rating", "length"))


def heads(v: DataFrame, threshold: float, whole: bool = False) -> DataFrame:
    """(item, place, x, rating, length, after): components up to where the rest is shorter than ``threshold``.

    ``after`` is the length of what follows the component.  With ``whole`` the
    components beyond the head stay, and have none.
    """
    xx = F.col("x") * F.col("x")
    upto = F.sum(xx).over(Window.partitionBy("item").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    left = v.withColumn("upto", upto)
    # the length from this component on: it is in the head while that could reach the threshold
    head = F.sqrt(F.greatest(F.lit(0.0), 1 - F.col("upto") + xx)) >= threshold - SLACK
    after = F.sqrt(F.greatest(F.lit(0.0), 1 - F.col("upto")))
    left = left.withColumn("after", F.when(head, after)).drop("upto")
    return left if whole else left.where(F.col("after").isNotNull())


def _packed(values: np.ndarray) -> bytes:
    """Integers and doubles compressed byte place by byte place, other values pickled."""
    plain = values.dtype.kind in "iuf"
    raw = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes() if plain else pickle.dumps(list(values))
    return pickle.dumps((values.dtype.str if plain else None, len(values), len(raw), pa.compress(raw, codec="zstd", asbytes=True)))


def _unpacked(data: bytes) -> np.ndarray:
    kind, n, size, packed = pickle.loads(data)
    raw = pa.decompress(packed, size, codec="zstd", asbytes=True)
    if kind:
        return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(-1, n).T).view(kind).reshape(n)
    out = np.empty(n, object)
    out[:] = pickle.loads(raw)
    return out


def _steps(users: np.ndarray, back: bool = False) -> np.ndarray:
    """Whole numbers as differences (modulo 2^64), which pack better, or these back as numbers."""
    if users.dtype.kind != "i":
        return users
    return np.cumsum(users) if back else np.diff(users.astype(np.int64), prepend=np.int64(0))


def _pack(frames):
    """Pieces of whole items from rows that come item by item: (piece, rows, data)."""
    def piece(f: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        nonlocal done
        f = f.assign(of=np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(f)]))).sort_values(["of", "user"], kind="stable")
        columns = (f["item"].to_numpy()[starts], f["length"].to_numpy()[starts], np.diff(np.r_[starts, len(f)]).astype(np.int32),
                   _steps(f["user"].to_numpy()), f["rating"].to_numpy(), f["after"].to_numpy().astype(np.uint8))
        done += 1
        return pd.DataFrame({"piece": [TaskContext.get().partitionId() << 32 | done], "rows": [len(f)],
                             "data": [pickle.dumps([_packed(np.ascontiguousarray(c)) for c in columns])]})

    held, n, enough, done = [], 0, PIECE_ROWS, 0
    for f in frames:
        held.append(f)
        n += len(f)
        if n >= enough:
            f = pd.concat(held, ignore_index=True)
            items = f["item"].to_numpy()
            starts = np.flatnonzero(np.r_[True, items[1:] != items[:-1]])
            # the last item may go on; one of very many components is looked at again when it has doubled
            held, n, enough = [f[starts[-1]:]], len(f) - starts[-1], max(PIECE_ROWS, 2 * (len(f) - starts[-1]))
            if len(starts) > 1:
                yield piece(f[:starts[-1]], starts[:-1])
    if n:
        f = pd.concat(held, ignore_index=True)
        items = f["item"].to_numpy()
        yield piece(f, np.flatnonzero(np.r_[True, items[1:] != items[:-1]]))


class _Block:
    """The components of a block's items: of each its item's number, user, ``x`` and ``after`` (0 beyond the head)."""

    def __init__(self, pieces: list[bytes]):
        # column by column: few copies at a time
        columns = [pickle.loads(p) for p in pieces]
        column = lambda i, back=lambda x: x: np.concatenate([back(_unpacked(c[i])) for c in columns])
        self.items, length, count = column(0), column(1), column(2)
        self.start = np.r_[0, np.cumsum(count, dtype=np.int64)]
        self.item = np.repeat(np.arange(len(self.items), dtype=np.int32), count)
        self.user = column(3, lambda x: _steps(x, True))
        self.x = column(4) / np.repeat(length, count)
        self.after = column(5)
        head = np.where(self.after > 0, self.after, np.uint8(255))
        self.rest = np.minimum.reduceat(head, self.start[:-1]).astype(np.int32)


def _sorted_users(left: _Block, right: _Block) -> None:
    """Users as whole numbers in both blocks."""
    if left.user.dtype.kind != "i" or right.user.dtype.kind != "i":
        both = pd.factorize(np.concatenate([left.user, right.user]))[0]
        left.user, right.user = both[:len(left.user)], both[len(left.user):]


def _meet(left: _Block, right: _Block, same: bool, threshold: float, whole: bool):
    """Pairs of an item of ``left`` and one of ``right``, as frames (a, b, n_common, similarity).

    Without ``whole``, all that can reach the threshold, with what their heads
    share; else those that reach it, with their products.
    """
    _sorted_users(left, right)
    n_right = len(right.items)
    order = np.argsort(right.user, kind="stable")
    users, in_head = right.user[order], right.after[order] > 0
    first = np.r_[True, users[1:] != users[:-1]]
    # a component of the right block by its user's number and its item
    known, place = users[first], (np.cumsum(first) - 1) * n_right + right.item[order]
    h_order = order[in_head]
    h_users, h_item, h_x, h_after = users[in_head], right.item[h_order], right.x[h_order], right.after[h_order]
    mine = np.flatnonzero(left.after > 0)
    low, high = (np.searchsorted(h_users, left.user[mine], side) for side in ("left", "right"))
    some = high > low
    mine, low, high = mine[some], low[some], high[some]
    # whole items of the left block, as many as make up to ``PRODUCTS`` products
    made = np.r_[0, np.cumsum(high - low)]
    starts = np.flatnonzero(np.r_[True, left.item[mine][1:] != left.item[mine][:-1]]) if len(mine) else np.zeros(0, np.int64)
    at = 0
    while at < len(starts):
        s = starts[at]
        at = max(at + 1, int(np.searchsorted(made[starts], made[s] + PRODUCTS, "right")) - 1) if made[-1] - made[s] > PRODUCTS else len(starts)
        e = starts[at] if at < len(starts) else len(mine)
        n = high[s:e] - low[s:e]
        l = np.repeat(mine[s:e], n)
        r = np.arange(made[e] - made[s]) + np.repeat(low[s:e] - made[s:e] + made[s], n)
        a, b = left.item[l], h_item[r]
        if same:
            keep = a < b
            l, r, a, b = l[keep], r[keep], a[keep], b[keep]
        if not len(a):
            continue
        pair = a.astype(np.int64) * n_right + b
        # whichever head ends first; ``after`` falls along a list's users, so the last shared one has the least
        missing = np.maximum(left.rest[a] * h_after[r], right.rest[b] * left.after[l])
        by = np.argsort(pair, kind="stable")
        pair = pair[by]
        runs = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
        shared = np.add.reduceat((left.x[l] * h_x[r])[by], runs)
        can = shared + np.minimum.reduceat(missing[by], runs) / float((STEPS - 1) ** 2) >= threshold - 2 * SLACK
        pair, shared, common = pair[runs[can]], shared[can], np.diff(np.r_[runs, len(by)])[can]
        if not len(pair):
            continue
        a, b = pair // n_right, pair % n_right
        for p in range(0, len(a) if whole else 0, PRODUCTS // 32):
            yield _products(left, right, a[p:p + PRODUCTS // 32], b[p:p + PRODUCTS // 32], known, place, order, threshold)
        if not whole:
            yield pd.DataFrame({"a": left.items[a], "b": right.items[b], "n_common": common, "similarity": shared})


def _products(left: _Block, right: _Block, a: np.ndarray, b: np.ndarray, known: np.ndarray, place: np.ndarray, order: np.ndarray,
              threshold: float) -> pd.DataFrame:
    """The pairs (a, b) of items whose whole vectors' product reaches the threshold."""
    n = left.start[a + 1] - left.start[a]
    of = np.repeat(np.arange(len(a)), n)
    l = np.arange(n.sum()) + np.repeat(left.start[a] - np.cumsum(n) + n, n)
    u = np.minimum(np.searchsorted(known, left.user[l]), len(known) - 1)
    met = known[u] == left.user[l]
    of, l, u = of[met], l[met], u[met]
    wanted = u * len(right.items) + b[of]
    r = np.minimum(np.searchsorted(place, wanted), len(place) - 1)
    met = place[r] == wanted
    of, l, r = of[met], l[met], order[r[met]]
    similarity = np.bincount(of, left.x[l] * right.x[r], len(a))
    reach = np.flatnonzero(similarity >= threshold)
    return pd.DataFrame({"a": left.items[a[reach]], "b": right.items[b[reach]],
                         "n_common": np.bincount(of, minlength=len(a))[reach], "similarity": similarity[reach]})


def candidates(h: DataFrame, threshold: float, hot_rows: int = BLOCK_ROWS, whole: bool = False) -> DataFrame:
    """(item_a, item_b, n_common, similarity): pairs of items that share a place of both heads and can reach
    the threshold, with what the heads share; with ``whole``, of whole vectors, those that reach it.

    A block has at most ``hot_rows`` components, unless one item has more.
    """
    spark = h.sparkSession

    def up(c):  # up to the next step, past what rounding may have lost
        return F.ceil((F.least(F.col(c), F.lit(1.0)) + SLACK) * (STEPS - 1))

    item = h.schema["item"]
    pieces = cut_lineage(h.select("item", F.col("place.user").alias("user"), "rating", "length",
                                  F.coalesce(up("after"), F.lit(0)).cast("short").alias("after"))
                         .mapInPandas(_pack, "piece long, rows long, data binary"))
    total = pieces.agg(F.sum("rows")).first()[0] or 0
    # enough blocks to keep the tasks busy, with numbers that deal them evenly over the partitions, one to each unless they are tiny
    tasks = max(1, spark.sparkContext.defaultParallelism)
    rows = min(hot_rows, max(PIECE_ROWS, math.ceil(total / math.ceil(math.sqrt(4 * tasks)))))
    block = running_totals(pieces.select("piece", "rows"), [], "piece", ["rows"]).select(
        "piece", F.expr(f"cast((L_rows - 1) div {rows} as int)").alias("block"))
    parts = max(2, min(math.ceil(total / rows), max(16, math.ceil(total / PIECE_ROWS))))
    numbers = spark.range(64 * (math.ceil(total / rows) + parts)).select(F.col("id").alias("a"), F.pmod(F.hash("id"), F.lit(parts)).alias("part"))
    nth = F.row_number().over(Window.partitionBy("part").orderBy("a")) - 1
    numbers = numbers.select("a", (nth * parts + F.col("part")).alias("block"))
    block = cut_lineage(block.join(numbers, "block").select("piece", "a"))
    blocks = (pieces.join(F.broadcast(block), "piece").select("a", "data").repartition(parts, "a")
              .groupBy("a").agg(F.collect_list("data").alias("data"))
              .coalesce(parts))  # every two partitions are a task, also where a session deals by more
    other = blocks.select(F.col("a").alias("z"), F.col("data").alias("z_data"))
    both = blocks.join(other.hint("shuffle_replicate_nl"), F.col("a") <= F.col("z"))

    def meet(frames):
        for f in frames:
            for a, data, z, z_data in f.itertuples(index=False):
                left = _Block(data)
                yield from _meet(left, left if a == z else _Block(z_data), a == z, threshold, whole)

    out = StructType([StructField("a", item.dataType), StructField("b", item.dataType),
                      StructField("n_common", LongType()), StructField("similarity", DoubleType())])
    met = both.select("a", "data", "z", "z_data").mapInPandas(meet, out)
    return met.select(F.least("a", "b").alias("item_a"), F.greatest("a", "b").alias("item_b"), "n_common", "similarity")


def similar_items(r: DataFrame, threshold: float, hot_rows: int = BLOCK_ROWS) -> DataFrame:
    """(item_a, item_b, n_common, similarity): all pairs item_a < item_b of ``r``
    (user, item, rating) with a cosine of at least ``threshold``.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must lie above 0 and up to 1")
    return candidates(heads(unit_vectors(r), threshold, whole=True), threshold, hot_rows, whole=True)
