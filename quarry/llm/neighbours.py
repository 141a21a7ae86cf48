"""Approximate nearest neighbours by an inverted multi-index.

Nearness is the inner product, the index works on distances: an entry v gets
one component more, sqrt(M^2 - |v|^2) with M the greatest length of all, and a
query is scaled to length M and gets a 0.  The squared distance of the two is
then 2 M^2 less twice the scaled product, so rising distance is falling inner
product whatever the lengths.

These vectors are cut in two halves, each quantised by its own codebook, so a
pair of centroids names a cell.  A query ranks each half's centroids by distance
and takes pairs in rising order of summed distance from a heap, until the cells
taken hold ``SHARE`` of the index; the entries of those cells are reranked by
the exact inner product of the original vectors in double precision.

Codebooks are fitted on a bounded sample (``SAMPLE`` vectors); every vector is
indexed.  Equal vectors are one entry with their k + 1 smallest ids, which is
all that a list of k can show of them.  Cells are worked on in blocks: entries
of one first centroid, at most ``BLOCK`` or so at a time, against the queries
that visit them, at most ``BLOCK`` or so at a time; each block gives k rows per
query.  A hot centroid only gets more blocks.

On vectors without structure, as in the test tables, half of the index must be
read for a recall of 0.9 to 0.95, hence the share; clustered vectors need far
less.

Defined results: vectors that are null, empty, all zero, or hold a null, NaN or
infinite component take no part, nor do rows without a vec_id or of another
length than the commonest (the larger at a tie); rows of one vec_id are
candidates of their own but never for that id's query; an id of several distinct
vectors has a list for each, told apart by query_key; fewer candidates give shorter lists; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import common

CENTROIDS = 64  # of each half; masks of visited cells are 64-bit
SAMPLE = 20_000
ROUNDS = 15
SHARE = 0.6
BLOCK = 2048
SEED = 5


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, v (doubles) of the vectors that take part."""
    ok = (F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
          & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
          & F.exists("embedding", lambda x: x != 0))
    rows = vectors.filter(F.coalesce(ok, F.lit(False))).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    common_size = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("v") == (common_size["d"] if common_size else 0))


def codebook(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means; a centroid that loses all its points takes the farthest one."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(ROUNDS):
        d = (c ** 2).sum(axis=1) - 2 * x @ c.T
        near = d.argmin(axis=1)
        n = np.bincount(near, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
        far = np.argsort(-(d[np.arange(len(x)), near] + (x ** 2).sum(axis=1)), kind="stable")
        c[n == 0] = x[far[:(n == 0).sum()]]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c ** 2).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)


def visit(d1: np.ndarray, d2: np.ndarray, sizes: np.ndarray, budget: int) -> dict[int, int]:
    """Cells in rising order of summed distance until they hold ``budget`` entries.

    First centroid -> bit mask of second centroids.
    """
    o1, o2 = np.argsort(d1, kind="stable").tolist(), np.argsort(d2, kind="stable").tolist()
    a, b = d1[o1].tolist(), d2[o2].tolist()
    heap, depth, held = [(a[0] + b[0], 0, 0)], [0] * len(o1), 0
    out: dict[int, int] = {}
    while heap and held < budget:
        _, i, j = heapq.heappop(heap)
        depth[i] = j + 1
        n = int(sizes[o1[i], o2[j]])
        if n:
            held += n
            out[o1[i]] = out.get(o1[i], 0) | 1 << o2[j]
        # a pair enters once both pairs before it are out
        if i + 1 < len(o1) and depth[i + 1] == j and (j == 0 or depth[i + 1] >= j):
            heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
        if j + 1 < len(o2) and (i == 0 or depth[i - 1] >= j + 2):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
    return out


def lifted(v: np.ndarray, longest: float) -> np.ndarray:
    """Entries with the component that brings them all to the length ``longest``."""
    return np.column_stack([v, np.sqrt(np.maximum(longest ** 2 - (v ** 2).sum(axis=1), 0))])


def aimed(v: np.ndarray, longest: float) -> np.ndarray:
    """Queries scaled to the length ``longest``, with a 0 for the entries' further component."""
    return np.column_stack([v * (longest / np.sqrt((v ** 2).sum(axis=1)))[:, None], np.zeros(len(v))])


def _stack(col: pa.Array) -> np.ndarray:
    flat = col.flatten().to_numpy()
    return flat.reshape(len(col), -1) if len(col) else flat.reshape(0, 0)


def _lists(a: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(a) + 1, dtype=np.int32) * a.shape[1]), pa.array(a.reshape(-1)))


def search(vectors: DataFrame, every: int = 20, k: int = 20, share: float = SHARE) -> DataFrame:
    """query_id, rank, vec_id, score, query_key: the k nearest found of each vec_id divisible by ``every``.

    A vec_id with several vectors has a list for each of them, told apart by
    ``query_key``, a hash of the vector.
    """
    spark = vectors.sparkSession
    ranked = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    entries = common.materialise(
        usable(vectors).withColumn("nth", ranked).filter(F.col("nth") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "ann-entries")
    n = entries.count()
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double, query_key bigint")
    if not n:
        return empty
    h = F.pmod(F.xxhash64("v"), F.lit(1 << 30))
    sample = entries.select(h.alias("h"), "v").filter(F.col("h") < min(1.0, 2.0 * SAMPLE / n) * (1 << 30)).orderBy("h").limit(SAMPLE)
    x = np.array([r["v"] for r in sample.toLocalIterator()], dtype=np.float64)
    if not len(x):
        x = np.array([r["v"] for r in entries.select("v").limit(SAMPLE).collect()], dtype=np.float64)
    square = F.aggregate("v", F.lit(0.0), lambda total, c: total + c * c)
    longest = math.sqrt(entries.agg(F.max(square)).first()[0])
    cut = x.shape[1] // 2
    x = lifted(x, longest)
    c1, c2 = (codebook(half, min(CENTROIDS, len(x)), SEED) for half in (x[:, :cut], x[:, cut:]))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                v = lifted(_stack(b.column("v")), longest)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nearest(v[:, :cut], c1).astype(np.int32)), pa.array(nearest(v[:, cut:], c2).astype(np.int32)),
                     b.column("v"), b.column("ids")], names=["i", "j", "v", "ids"])

    index = common.materialise(entries.select("v", "ids").mapInArrow(place, "i int, j int, v array<double>, ids array<bigint>"), "ann-index")
    sizes = np.zeros((len(c1), len(c2)), dtype=np.int64)
    for r in index.groupBy("i", "j").count().collect():  # at most a row for each cell
        sizes[r["i"], r["j"]] = r["count"]
    budget = max(math.ceil(share * n), 4 * k)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            v, ids = aimed(_stack(b.column("v")), longest), b.column("vec_id")
            # squared distances of the halves, without the query's own norm
            d1 = (c1 ** 2).sum(axis=1) - 2 * v[:, :cut] @ c1.T
            d2 = (c2 ** 2).sum(axis=1) - 2 * v[:, cut:] @ c2.T
            row, first, mask = [], [], []
            for r in range(len(v)):
                for i, m in visit(d1[r], d2[r], sizes, budget).items():
                    row.append(r)
                    first.append(i)
                    mask.append(m - (1 << 64) if m >> 63 else m)
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids.take(take), b.column("query_key").take(take), pa.array(first, pa.int32()), pa.array(mask, pa.int64()),
                 b.column("v").take(take)], names=["query_id", "query_key", "i", "mask", "v"])

    queries = usable(vectors).filter(F.col("vec_id") % every == 0).distinct().withColumn("query_key", F.xxhash64("v"))
    n_queries = max(1, queries.count())
    visits = common.materialise(queries.mapInArrow(route, "query_id bigint, query_key bigint, i int, mask bigint, v array<double>"), "ann-visits")

    # blocks: entries of a first centroid in s parts, its queries in t parts
    parts = [max(1, math.ceil(int(s) / BLOCK)) for s in sizes.sum(axis=1)]
    t = max(1, math.ceil(n_queries / BLOCK))
    n_parts = F.element_at(F.array(*[F.lit(p) for p in parts]), F.col("i") + 1)
    left = (index.withColumn("s", F.pmod(F.xxhash64("v"), n_parts).cast("int"))
            .withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(t - 1)))))
    right = (visits.withColumn("t", F.pmod(F.xxhash64("query_id", "query_key"), F.lit(t)).cast("int"))
             .withColumn("s", F.explode(F.sequence(F.lit(0), n_parts - 1))))

    def rerank(entry: pa.Table, query: pa.Table) -> pa.Table:
        out_q, out_key, out_id, out_s = [], [], [], []
        if entry.num_rows and query.num_rows:
            v, j = _stack(entry.column("v").combine_chunks()), entry.column("j").to_numpy()
            members = entry.column("ids").to_pylist()
            qv, qid = _stack(query.column("v").combine_chunks()), query.column("query_id").to_pylist()
            key = query.column("query_key").to_pylist()
            masks = query.column("mask").to_numpy().view(np.uint64)
            for s in range(0, len(qv), 256):
                open_ = (masks[s:s + 256, None] >> j[None, :].astype(np.uint64)) & np.uint64(1)
                scores = np.where(open_ == 1, qv[s:s + 256] @ v.T, -np.inf)
                for r, row in enumerate(scores):
                    if len(row) > k + 1:  # one more: the query's own entry may be among them
                        keep = np.flatnonzero(row >= np.partition(row, -(k + 1))[-(k + 1)])
                    else:
                        keep = np.arange(len(row))
                    own = qid[s + r]
                    found = sorted((-row[e], m) for e in keep.tolist() if row[e] > -np.inf for m in members[e] if m != own)[:k]
                    out_q += [own] * len(found)
                    out_key += [key[s + r]] * len(found)
                    out_id += [m for _, m in found]
                    out_s += [-x for x, _ in found]
        return pa.table({"query_id": pa.array(out_q, pa.int64()), "query_key": pa.array(out_key, pa.int64()), "vec_id": pa.array(out_id, pa.int64()),
                         "score": pa.array(out_s, pa.float64())})

    found = (left.select("i", "s", "t", "j", "v", "ids").groupBy("i", "s", "t")
             .cogroup(right.select("i", "s", "t", "query_id", "query_key", "mask", "v").groupBy("i", "s", "t"))
             .applyInArrow(rerank, "query_id bigint, query_key bigint, vec_id bigint, score double"))
    rank = F.row_number().over(Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id"))
    return (found.withColumn("rank", rank).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", "query_key"))
