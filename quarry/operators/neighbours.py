"""Distances and k-nearest-neighbour classification (K1-K8).

Exact k-NN prunes by pivots.  Every vector belongs to the cell of its nearest
pivot; the references' smallest distances to each pivot bound a query's k-th
distance from above, and triangle inequalities on pivots and rings say which
cells can hold a neighbour.  A query is sent only to the blocks of such cells;
each (query block, reference block) is one co-group that compares a query with a
cell only under the bound it has by then, and emits its top-k per query.  A
final ``row_number`` per query gives the exact answer.  Memory per task is
bounded by the block size; pivots and cell statistics are bounded by
``MAX_PIVOTS``; no per-pair rows are materialised.  Vectors without structure in
many dimensions let nothing be pruned; all pairs are then compared, in blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.functions.vectors import METRICS
from quarry.session import cut_lineage, partition_for_expansion

# Distances are compared after rounding to this many digits; ties then go
# to the smaller id (a total order any engine can reproduce).
TIE_DIGITS = 9
# Largest block (rows per side of one co-group).  Each row is replicated
# once per block of the other side, so larger blocks mean less shuffle;
# memory per co-group is about 2 × MAX_BLOCK_ROWS × dim doubles plus one
# bounded distance chunk.
MAX_BLOCK_ROWS = 16_384
# Components of a block's vectors at most: long vectors get smaller blocks.
MAX_BLOCK_VALUES = 1 << 20
# Pivots at most, references they are chosen from, and rounds of choosing.
MAX_PIVOTS = 512
PIVOT_SAMPLE = 8_192
PIVOT_ROUNDS = 4
# Folds that bounds are kept for, and bounds computed at a time.
MAX_FOLDS = 64
CHUNK = 1_000_000
# Pairs of a block compared at a time, and candidates kept before they are ranked;
# references of a cell compared at a time, and those that start a block.
PAIRS = 1 << 18
PIECE = 2_048
FIRST = 256
# Pairs whose components are summed at a time (they stay in the processor's cache),
# components between two looks at the bounds, and the share of pairs left
# below which they are finished one by one.
TILE = 1 << 16
LOOK = 8
FEW = 0.03
# Steps that a component is cut in to sift pairs, bytes of a tile sifted at a time, queries and references
# from which a piece is sifted, the share of a query's pairs that may be left, how many times PAIRS are compared
# at a time while few are, and how many times the rows and values of a block are met then.
SIFTED = ("manhattan", "chebyshev")
SIFT_STEPS = 64
SIFT_TILE = 1 << 18
SIFT_QUERIES = 256
SIFT_REFS = 32
SIFT_FEW = 0.15
SIFT_PAIRS = 4
SIFT_BLOCKS = 2
# One reference in so many, up to PIVOT_SAMPLE, is compared with every query first, to bound its k-th distance.
SAMPLE_SHARE = 16
# Signs that a probe may flip in a table (all subsets are tried), and vectors
# probed at a time: each gives as many rows as it has probes.
PROBE_BITS = 8
PROBE_ROWS = 512
# Hashed vectors go to blocks where they look in 1 / MEET_SHARE of a table's buckets or more:
# rows and components of such a block at most, buckets of all tables at most, references
# that start a block, and the share (1 / MANY) of a tile's pairs from which buckets are read for all of it.
MEET_SHARE = 8
MEET_ROWS = 65_536
MEET_VALUES = 4 << 20
MEET_BUCKETS = 16_384
MEET_FIRST = 512
MANY = 16


# ---------------------------------------------------------------- K1-K3
def centroids(df: DataFrame, vec: str = "v", label: str = "label") -> DataFrame:
    """(label, centroid array<double>) — per-dimension means per class."""
    ex = df.select(label, F.posexplode(vec).alias("pos", "x"))
    per_dim = ex.groupBy(label, "pos").agg(F.avg("x").alias("m"))
    return (per_dim.groupBy(label)
            .agg(F.array_sort(F.collect_list(F.struct("pos", "m"))).alias("s"))
            .select(label, F.transform("s", lambda e: e["m"]).alias("centroid")))


def distance_to_centroid(df: DataFrame, metrics=("euclidean",), vec: str = "v",
                         label: str = "label") -> DataFrame:
    """K1/K2: distance of every vector to its own class centroid (equi-join on label)."""
    c = centroids(df, vec, label)
    j = df.join(c, label)
    return j.select("id", label, *[METRICS[m](vec, "centroid").alias(m) for m in metrics])


def distance(pairs: DataFrame, metrics=tuple(METRICS), a: str = "a", b: str = "b") -> DataFrame:
    """K1/K2: ``pairs`` with the distances of the two vectors of each row."""
    return pairs.select("*", *[METRICS[m](a, b).alias(m) for m in metrics])


def scale(df: DataFrame, vec: str = "v", how: str = "minmax", out: str | None = None) -> DataFrame:
    """K3: per-dimension rescaling; a constant dimension maps to 0.

    Per-dimension statistics are one aggregate with one row per dimension;
    that frame is bounded by the vector length (not by the row count), so it
    is collected and inlined as literal arrays — no join with the data.
    """
    ex = df.select(F.posexplode(vec).alias("pos", "x"))
    st = sorted(ex.groupBy("pos").agg(F.min("x").alias("lo"), F.max("x").alias("hi"),
                                      F.avg("x").alias("mu"), F.stddev_samp("x").alias("sd"))
                .collect())

    def lit_array(field):
        return F.array(*[F.lit(None if r[field] is None else float(r[field])).cast("double") for r in st])

    if how == "minmax":
        lo, hi = lit_array("lo"), lit_array("hi")
        fn = lambda x, i: F.when(hi[i] == lo[i], F.lit(0.0)).otherwise((x - lo[i]) / (hi[i] - lo[i]))
    else:
        mu, sd = lit_array("mu"), lit_array("sd")
        fn = lambda x, i: F.when(F.coalesce(sd[i], F.lit(0.0)) == 0, F.lit(0.0)).otherwise(
            (x - mu[i]) / sd[i])
    return df.withColumn(out or vec, F.transform(vec, fn))


# ---------------------------------------------------------------- K4
def _spread(v: np.ndarray, metric: str) -> np.ndarray:
    """Vectors in the space where bounds hold: unit length for the cosine, whose
    distance is half the squared Euclidean one there; otherwise as they are."""
    return v / np.sqrt((v * v).sum(axis=1))[:, None] if metric == "cosine" else v


def _paired(q: np.ndarray, r: np.ndarray, metric: str) -> np.ndarray:
    """Distances of paired rows, by differences."""
    if metric == "cosine":
        den = np.sqrt((q * q).sum(axis=1)) * np.sqrt((r * r).sum(axis=1))
        return 1 - (q * r).sum(axis=1) / den
    gap = np.abs(q - r)
    if metric == "euclidean":
        return np.sqrt((gap * gap).sum(axis=1))
    return gap.sum(axis=1) if metric == "manhattan" else gap.max(axis=1)


def _finder(r: np.ndarray, metric: str, origin: np.ndarray, asked: int = 0):
    """A function of (queries, reach) over references ``r``, all spread: the pairs that may be within their
    query's ``reach``, as (query, reference, distance, how far it may be off), sorted by query.

    The Euclidean distances come from one matrix product of vectors taken from
    ``origin``, a point near the references: a common offset of all vectors
    cancels before anything is squared.  What rounding is left is bounded from
    the lengths and the machine's precision.  Sums and maxima of gaps go by ``_by_component``,
    where ``asked`` queries or references are many only for queries that ``_sift`` leaves too many pairs of.
    """
    b = r - origin
    b2 = (b * b).sum(axis=1)
    longest, bt = math.sqrt(b2.max(initial=0)), np.ascontiguousarray(b.T)

    def product(q: np.ndarray, reach: np.ndarray):
        a = q - origin
        a2 = (a * a).sum(axis=1)
        # sqrt(x + e) - sqrt(x) is at most e / sqrt(x) and at most sqrt(e)
        off = np.sqrt(4 * (q.shape[1] + 8) * np.finfo(float).eps * (np.sqrt(a2) + longest) ** 2)
        d2 = (-2 * a) @ bt
        d2 += b2
        i, j = np.nonzero(d2 <= ((reach + off) ** 2 * (1 + 1e-9) - a2 + off * off)[:, None])
        return i, j, np.sqrt(np.maximum(d2[i, j] + a2[i], 0)), off[i]

    def gaps(q: np.ndarray, reach: np.ndarray):
        d, off = _by_component(q - origin, b, metric, reach)
        i, j = np.nonzero(np.isfinite(d) & (d <= (reach + off)[:, None]))
        return i, j, d[i, j].astype(float), off[i]

    def sifted(q: np.ndarray, reach: np.ndarray):
        i, j, crowded = sift(q - origin, reach)
        d, off = np.empty(len(i)), np.zeros(len(i))
        step = max(1, PAIRS // max(1, q.shape[1]))
        for s in range(0, len(i), step):
            x, y = q[i[s:s + step]], r[j[s:s + step]]
            d[s:s + step] = _paired(x, y, metric)
        near = d <= reach[i]
        i, j, d, off = i[near], j[near], d[near], off[near]
        if len(crowded):
            rows, cols, dense, dense_off = gaps(q[crowded], reach[crowded])
            i, j, d, off = (np.concatenate(x) for x in ((i, crowded[rows]), (j, cols), (d, dense), (off, dense_off)))
        order = np.argsort(i, kind="stable")
        return i[order], j[order], d[order], off[order]

    if metric in ("euclidean", "cosine"):
        return product
    sift = _sift(b, metric) if asked >= SIFT_QUERIES and len(r) >= SIFT_REFS else None
    return sifted if sift else gaps


def _true(of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``of``, rows of a multiple of 8, is true: as ``nonzero``, faster where little is."""
    word = np.flatnonzero(of.reshape(-1).view(np.uint64))
    at, byte = np.nonzero(of.reshape(-1, 8)[word])
    return np.divmod(word[at] * 8 + byte, of.shape[1])


def _sift(b: np.ndarray, metric: str):
    """A function of (queries, reach) that gives (query, reference) of the pairs that may be within reach, and the
    queries of which too many are; None if components can't be cut in steps.

    Every component is cut in equal steps.  For the greatest gap, a bit a reference says for every step
    whether the reference is up to it, and from it on: two ands a component leave those within reach.
    For the sum, a byte a reference has the steps between it and every step; their sum, less how
    far query and reference lie from their steps, bounds the distance from below.
    """
    n, dim = b.shape
    low, most = b.min(axis=0), np.abs(b).max(initial=0)
    span = np.ptp(b, axis=0) if most < 1e150 else np.zeros(dim)
    steps = max(2, min(SIFT_STEPS, 60_000 // max(1, dim)))
    if not span.max(initial=0) > 0 or not 0 < dim < 30_000:
        return None
    order = np.argsort(-span, kind="stable")  # components of the largest spread come first
    b, low, span = b[:, order], low[order], span[order]
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        scale = np.where(span > 0, (steps if metric == "chebyshev" else 0) / span, 0.0)
    step = span.max() / (steps - 1)
    if not np.isfinite(scale).all() or not step > 0 or not np.isfinite(1 / step):
        return None

    def cut(v: np.ndarray) -> np.ndarray:
        """The steps of values; a value never has a later step than a greater one."""
        with np.errstate(over="ignore"):
            at = np.floor((v - low) * scale) if metric == "chebyshev" else np.rint((v - low) / step)
        return np.clip(at, 0, steps - 1).astype(np.uint8)

    own = cut(b).T
    some = max(1, SIFT_TILE // n)

    if metric == "chebyshev":
        wide = -(-n // 64) * 64
        bits = np.zeros((dim, steps, wide // 8), np.uint8)
        bits[:, :, :-(-n // 8)] = np.packbits(own[:, None] <= np.arange(steps, dtype=np.uint8)[None, :, None], axis=2, bitorder="little")
        upto = bits.view(np.uint64)
        since = np.full_like(upto, np.iinfo(np.uint64).max)
        since[:, 1:] = ~upto[:, :-1]
        some *= 8

        def few(a: np.ndarray, reach: np.ndarray):
            first, last = (np.ascontiguousarray(cut(a + side * reach[:, None]).T) for side in (-1, 1))
            rows, left = np.arange(len(a)), np.full((len(a), wide // 64), np.iinfo(np.uint64).max)
            buffer = np.empty_like(left)
            for c in range(dim):
                for table, at in ((upto, last), (since, first)):
                    np.take(table[c], at[c], axis=0, out=buffer, mode="clip")
                    np.bitwise_and(left, buffer, out=left)
                if c % LOOK == LOOK - 1:
                    alive = np.flatnonzero(left.any(axis=1))
                    if 2 * len(alive) < len(rows):
                        rows, left, first, last = rows[alive], left[alive], first[:, alive], last[:, alive]
                        buffer = np.empty_like(left)
                        if not len(rows):
                            break
            count = np.bitwise_count(left).sum(axis=1)
            crowded = count > max(4, SIFT_FEW * n)
            i, w = np.nonzero(left * ~crowded[:, None])
            at, bit = np.nonzero(np.unpackbits(left[i, w].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            return rows[i[at]], w[at] * 64 + bit, rows[crowded]
    else:
        wide = -(-n // 16) * 16
        table = np.zeros((dim, steps, wide), np.uint8)
        levels = np.arange(steps, dtype=np.uint8)[None, :, None]
        np.subtract(np.maximum(levels, own[:, None]), np.minimum(levels, own[:, None]), out=table[:, :, :n])
        far = lambda v, at: np.abs(v - (low + at * step)).sum(axis=1) / step * (1 + 1e-9)
        # what a reference lies off its steps is taken from its sum at the start
        off = np.zeros(wide, np.int64)
        off[:n] = np.ceil(far(b, own.T))
        spare = int(off.max())
        start = (spare - off).astype(np.uint16).reshape(-1, 2).T
        together = max(1, 255 // (steps - 1))

        def few(a: np.ndarray, reach: np.ndarray):
            at = cut(a)
            with np.errstate(over="ignore"):
                limit = np.minimum(np.floor(reach / step * (1 + 1e-9) + far(a, at) + 1e-6) + spare, 65_535).astype(np.uint16)
            at, rows = np.ascontiguousarray(at.T), np.arange(len(a))
            odd = [np.repeat(x[None], len(a), axis=0) for x in start]
            total, buffer = np.empty((len(a), wide), np.uint8), np.empty((len(a), wide), np.uint8)
            half = np.empty((len(a), wide // 2), np.uint16)
            for c in range(0, dim, together):
                np.take(table[c], at[c], axis=0, out=total, mode="clip")
                for d in range(c + 1, min(dim, c + together)):
                    np.take(table[d], at[d], axis=0, out=buffer, mode="clip")
                    np.add(total, buffer, out=total)
                pairs = total.view(np.uint16)
                np.bitwise_and(pairs, 255, out=half)
                np.add(odd[0], half, out=odd[0])
                np.right_shift(pairs, 8, out=half)
                np.add(odd[1], half, out=odd[1])
                if c // together % 4 == 3 and c + together < dim:
                    alive = np.flatnonzero(np.minimum(odd[0], odd[1], out=half).min(axis=1) <= limit)
                    if 2 * len(alive) < len(rows):
                        rows, limit, at, odd = rows[alive], limit[alive], at[:, alive], [x[alive] for x in odd]
                        total, buffer, half = total[:len(rows)], buffer[:len(rows)], half[:len(rows)]
                        if not len(rows):
                            break
            found = [_true(x <= limit[:, None]) for x in odd]
            i, j = np.concatenate([x[0] for x in found]), np.concatenate([2 * x[1] + k for k, x in enumerate(found)])
            i, j = i[j < n], j[j < n]
            crowded = np.bincount(i, minlength=len(rows)) > max(4, SIFT_FEW * n)
            few_left = ~crowded[i]
            return rows[i[few_left]], j[few_left], rows[crowded]

    def sift(a: np.ndarray, reach: np.ndarray):
        # past rounding of the sums above
        size = np.abs(a).max(axis=1, initial=0) + most
        reach = np.minimum(reach, 1e300) * (1 + 1e-9) + 8 * (dim + 8) * np.finfo(float).eps * size * (1 if metric == "chebyshev" else dim)
        a = a[:, order]
        out = []
        for s in range(0, len(a), some):
            i, j, crowded = few(a[s:s + some], reach[s:s + some])
            out.append((i + s, j, crowded + s))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3

    return sift


def _by_component(a: np.ndarray, b: np.ndarray, metric: str, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(queries, references) sums or maxima of gaps, and how far each row's may be off: in single precision, tile by tile.

    What rounding is left is bounded as for the products.  Components of the
    largest spread come first; a pair beyond its row's ``reach`` is infinite as
    soon as few pairs of its tile are within.
    """
    size = lambda v: (np.abs(v).sum(axis=1) if metric == "manhattan" else np.abs(v).max(axis=1, initial=0))
    most = size(b).max(initial=0)
    single = max(size(a).max(initial=0), most) < 1e30
    kind = np.dtype(np.float32 if single else np.float64)
    off = (a.shape[1] + 8) * (np.finfo(kind).eps * (size(a) + most) + np.finfo(kind).tiny)
    add = np.add if metric == "manhattan" else np.maximum
    order = np.argsort(-np.ptp(b, axis=0), kind="stable")
    a, b = np.ascontiguousarray(a[:, order], kind), np.ascontiguousarray(b[:, order], kind)
    at, bt = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    dim = a.shape[1]
    with np.errstate(over="ignore"):
        limit = ((reach + off) * (1 + 1e-6)).astype(kind)[:, None]
    out = np.zeros((len(a), len(b)), kind)
    # the longer side of a tile is the inner one
    turned = len(a) > len(b)
    width, height = (len(a), len(b)) if turned else (len(b), len(a))
    wide = min(width, 2048)
    tall = max(1, TILE // max(1, wide))
    for s in range(0, height, tall):
        for t in range(0, width, wide):
            rows, cols = (slice(t, t + wide), slice(s, s + tall)) if turned else (slice(s, s + tall), slice(t, t + wide))
            x, y, lim = a[rows], b[cols], limit[rows]
            xt, yt = (at[:, None, rows], bt[:, cols, None]) if turned else (at[:, rows, None], bt[:, None, cols])
            lim = lim.T if turned else lim
            total = np.zeros((len(y), len(x)) if turned else (len(x), len(y)), kind)
            gap = np.empty_like(total)
            for j in range(dim):
                np.subtract(xt[j], yt[j], out=gap)
                np.abs(gap, out=gap)
                add(total, gap, out=total)
                done = j + 1
                if done % LOOK == 0 and LOOK < done < dim:
                    left = total <= lim
                    if np.count_nonzero(left) < FEW * left.size:
                        at_a, at_b = np.nonzero(left)[::-1] if turned else np.nonzero(left)
                        rest = np.abs(x[at_a, done:] - y[at_b, done:])
                        known = total[left]
                        total.fill(np.inf)
                        total[left] = add(known, rest.sum(axis=1) if metric == "manhattan" else rest.max(axis=1))
                        break
            out[rows, cols] = total.T if turned else total
    return out, off


def _loose(bound: np.ndarray, metric: str) -> np.ndarray:
    """Bounds that let through what rounds to the same distance, and rounding of the bound itself."""
    tie = 4 * 10.0 ** -TIE_DIGITS
    return (np.sqrt(bound * bound + tie) if metric == "cosine" else bound + tie) * (1 + 1e-9)


class Cells:
    """Pivots, and what is known of the references nearest to each.

    ``least`` holds, per cell and fold, the smallest distances of references to
    the pivot, ``rank`` of them: with a query's distance to the pivot they bound
    the query's k-th distance from above.  All arrays have a row per pivot.
    """

    def __init__(self, pivots: np.ndarray, metric: str, rank: int):
        self.pivots, self.metric, self.rank = pivots, metric, rank
        self.apart = self.to_pivots(pivots)
        n = len(pivots)
        self.low, self.high = np.full(n, np.inf), np.full(n, -np.inf)
        self.least: dict[int, np.ndarray] = {}
        self.first_block, self.n_blocks, self.blocks = np.zeros(n, dtype=np.int64), np.ones(n, dtype=np.int64), 1

    def to_pivots(self, v: np.ndarray, some: np.ndarray | None = None) -> np.ndarray:
        """Distances of spread vectors to all pivots, or ``some``, by differences."""
        pivots = self.pivots if some is None else self.pivots[some]
        out = np.zeros((len(v), len(pivots)))
        metric = "euclidean" if self.metric == "cosine" else self.metric
        for j, p in enumerate(pivots):
            out[:, j] = _paired(v, np.broadcast_to(p, v.shape), metric)
        return out

    def bound(self, far: np.ndarray, fold: np.ndarray, use_fold: bool) -> np.ndarray:
        """Upper bounds of the queries' k-th distances; infinite where too few references are known."""
        out = np.full(len(far), np.inf)
        for f in np.unique(fold) if use_fold else [None]:
            own = np.flatnonzero(fold == f) if use_fold else np.arange(len(far))
            known = [m for g, m in self.least.items() if g != f]
            if known and len(own):
                reach = np.concatenate([far[own][:, :, None] + m[None] for m in known], axis=2).reshape(len(own), -1)
                out[own] = np.partition(reach, self.rank - 1, axis=1)[:, self.rank - 1]
        return out

    def within(self, far: np.ndarray, near: np.ndarray, own: np.ndarray, bound: np.ndarray,
               some: np.ndarray | None = None) -> np.ndarray:
        """(queries, cells): whether a cell, of all or of ``some``, can hold a reference within the bound.

        The triangle inequality on the ring of the cell, and on the two pivots:
        a reference is nearer to its own pivot than to the query's.
        """
        b = _loose(bound, self.metric)[:, None]
        some = np.arange(len(self.pivots)) if some is None else some
        ring = (far - b <= self.high[some]) & (far + b >= self.low[some])
        if self.metric in ("euclidean", "cosine"):
            apart = self.apart[np.ix_(own, some)]
            with np.errstate(divide="ignore", invalid="ignore"):
                plane = (far - near[:, None]) * (far + near[:, None]) / (2 * apart)
            plane[apart == 0] = 0
        else:
            plane = (far - near[:, None]) / 2
        return ring & (plane <= b)

    def block_of(self, cell: np.ndarray, salt: np.ndarray) -> np.ndarray:
        return self.first_block[cell] + salt % self.n_blocks[cell]

    def blocks_in(self, reach: np.ndarray) -> np.ndarray:
        """(queries, blocks) from (queries, cells)."""
        out = np.zeros((len(reach), self.blocks), dtype=bool)
        for c in range(reach.shape[1]):
            for b in range(self.first_block[c], self.first_block[c] + self.n_blocks[c]):
                out[:, b] |= reach[:, c]
        return out

    def deal(self, counts: np.ndarray, block_rows: int) -> None:
        """Neighbouring cells share a block up to ``block_rows``; a larger cell gets several of its own."""
        left, at = set(range(len(counts))), 0
        block, filled = 0, 0
        while left:
            left.discard(at)
            own = max(1, math.ceil(counts[at] / block_rows))
            if own > 1:
                block += filled > 0
                self.first_block[at], self.n_blocks[at] = block, own
                block, filled = block + own, 0
            else:
                if filled and filled + counts[at] > block_rows:
                    block, filled = block + 1, 0
                self.first_block[at] = block
                filled += counts[at]
            if left:
                rest = np.fromiter(left, dtype=np.int64)
                at = int(rest[np.argmin(self.apart[at][rest])])
        self.blocks = int((self.first_block + self.n_blocks).max())


def _pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """``n`` centres of a sample by a few rounds of k-means; where they lie decides speed only."""
    shift = sample.mean(axis=0)
    x = sample - shift
    centres = x[np.random.default_rng(0).choice(len(x), size=min(n, len(x)), replace=False)]
    for _ in range(PIVOT_ROUNDS):
        near = np.argmin((centres * centres).sum(axis=1)[None] - 2 * x @ centres.T, axis=1)
        size = np.bincount(near, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        centres = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centres)
    return centres + shift


def _numbered(i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each run of equal values, and of each value in its run."""
    first = np.r_[True, i[1:] != i[:-1]] if len(i) else np.zeros(0, bool)
    return np.cumsum(first) - 1, np.arange(len(i)) - np.maximum.accumulate(np.where(first, np.arange(len(i)), 0))


def _block_topk(qp: pd.DataFrame, rp: pd.DataFrame, k: int, cells: Cells, exclude_self: bool,
                use_fold: bool, count=None) -> pd.DataFrame:
    """The k nearest references of each query of one block pair: (id, neighbour, distance)."""
    if not len(qp) or not len(rp):
        return pd.DataFrame({"id": np.zeros(0, np.int64), "neighbour": np.zeros(0, np.int64), "distance": np.zeros(0)})
    i, j, distance, _ = _search(qp, rp, k, cells, exclude_self, use_fold, count)
    return pd.DataFrame({"id": qp["qid"].to_numpy(np.int64)[i], "neighbour": rp["rid"].to_numpy(np.int64)[j], "distance": distance})


def _search(qp: pd.DataFrame, rp: pd.DataFrame, k: int, cells: Cells, exclude_self: bool, use_fold: bool, count=None):
    """(query, reference, distance) of the k nearest references of each query, and bounds of the k-th distances.

    Cells are taken in turn; only queries that a cell can hold a neighbour of
    are compared with it, under a bound that falls with what was found before.
    """
    metric = cells.metric
    empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    qv, rv = np.stack(qp["qv"].to_numpy()), np.stack(rp["rv"].to_numpy())
    q, r = (qv, rv) if metric != "cosine" else (_spread(qv, metric), _spread(rv, metric))
    qid, rid = qp["qid"].to_numpy(np.int64), rp["rid"].to_numpy(np.int64)
    qf, rf = qp["fold"].to_numpy(), rp["fold"].to_numpy()
    rc, own, near = rp["cell"].to_numpy(np.int64), qp["cell"].to_numpy(np.int64), qp["near"].to_numpy()
    bound, best = qp["bound"].to_numpy().copy(), np.full((len(q), k), np.inf)
    few = False  # whether the last comparison left few pairs
    kept, found, n_found = empty, [], 0  # ranked so far; and (query, reference, least distance) since

    def ranked() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The k nearest of each query among those ranked before and those found since."""
        i, j, least = (np.concatenate(x) for x in zip(*found))
        within = np.flatnonzero(least <= _loose(bound[i], metric))
        i, j = i[within], j[within]
        dist, step = np.empty(len(i)), max(1, PAIRS // qv.shape[1])
        for s in range(0, len(i), step):
            dist[s:s + step] = _paired(qv[i[s:s + step]], rv[j[s:s + step]], metric)
        i, j, dist = (np.concatenate(x) for x in zip(kept, (i, j, dist)))
        order = np.lexsort((rid[j], np.round(dist, TIE_DIGITS), i))
        i, j, dist = i[order], j[order], dist[order]
        _, nth = _numbered(i)
        return i[nth < k], j[nth < k], dist[nth < k]

    order = np.argsort(rc, kind="stable")
    starts = np.flatnonzero(np.r_[True, rc[order][1:] != rc[order][:-1]])
    # the cells that most queries are in come first, the first by a few references: they lower the bounds
    groups = sorted(np.split(order, starts[1:]), key=lambda g: -np.count_nonzero(own == rc[g[0]]))
    pieces = [groups[0][:FIRST], groups[0][FIRST:], *groups[1:]]
    for at in (g[s:s + PIECE] for g in pieces for s in range(0, len(g), PIECE)):
        c = rc[at[0]]
        one = np.array([c])
        asked = np.flatnonzero(cells.within(cells.to_pivots(q, one), near, own, bound, one)[:, 0])
        if not len(asked):
            continue
        find = _finder(r[at], metric, cells.pivots[c], len(asked))
        done = 0
        while done < len(asked):
            some = asked[done:done + max(1, PAIRS * (SIFT_PAIRS if few else 1) // len(at))]
            done += len(some)
            i, j, d, off = find(q[some], _loose(bound[some], metric))
            few = metric in SIFTED and len(i) * 32 < len(some) * len(at)
            if count is not None:
                count.add(len(some) * len(at))
            valid = np.ones(len(i), bool)
            if exclude_self:
                valid &= qid[some[i]] != rid[at[j]]
            if use_fold:
                valid &= qf[some[i]] != rf[at[j]]
            i, j, d, off = i[valid], j[valid], d[valid], off[valid]
            if not len(i):
                continue
            # a distance and the bound it meets may each be off by ``off``
            row, nth = _numbered(i)
            rows = some[i[nth == 0]]
            if len(i) * 8 > len(rows) * len(at):
                top = np.full((len(rows), max(k, len(at))), np.inf)
                top[row, j] = d + off
                top = np.partition(top, k - 1, axis=1)[:, :k]
            else:
                order = np.lexsort((d, i))
                top = np.full((len(rows), k), np.inf)
                first = nth < k
                top[row[first], nth[first]] = (d + off)[order][first]
            best[rows] = top = np.partition(np.concatenate([best[rows], top], axis=1), k - 1, axis=1)[:, :k]
            bound[rows] = np.minimum(bound[rows], top.max(axis=1))
            within = d <= _loose(bound[some], metric)[i] + off
            found.append((some[i[within]], at[j[within]], (d - off)[within]))
            n_found += np.count_nonzero(within)
            if n_found > PAIRS:
                kept, found, n_found = ranked(), [], 0
    return (*(ranked() if found else kept), bound)


def _ranked(cand: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("id").orderBy(F.round("distance", TIE_DIGITS), "neighbour")
    return cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def complete(df: DataFrame, metric: str = "euclidean") -> DataFrame:
    """Rows whose vector can be compared: not null, without null or non-finite components, for the cosine not all zero."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    df = df.where(F.col("v").isNotNull() & ~F.exists("v", bad))
    return df.where(F.exists("v", lambda x: x != 0)) if metric == "cosine" else df


def _celled(df: DataFrame, cells: Cells) -> DataFrame:
    """``df`` (id, v, fold, ...) with its cell and the distance to the cell's pivot."""
    def place(frames):
        for f in frames:
            if len(f):
                far = cells.to_pivots(_spread(np.stack(f["v"].to_numpy()), cells.metric))
                f["cell"] = np.argmin(far, axis=1)
                f["near"] = far[np.arange(len(f)), f["cell"]]
                yield f

    return df.select("id", "v", "fold").mapInPandas(place, "id long, v array<double>, fold long, cell long, near double")


def _describe(placed: DataFrame, cells: Cells, block_rows: int, use_fold: bool) -> None:
    """Fill ``cells`` from the placed references: a row per cell, and ``rank`` a cell and fold."""
    n = len(cells.pivots)
    counts = np.zeros(n, dtype=np.int64)
    for x in placed.groupBy("cell").agg(F.count("*").alias("n"), F.min("near").alias("low"), F.max("near").alias("high")).collect():
        counts[x["cell"]], cells.low[x["cell"]], cells.high[x["cell"]] = x["n"], x["low"], x["high"]
    fold = F.col("fold") if use_fold else F.lit(0).cast("long")
    # past this many folds no bound is kept, and nothing is pruned by it
    if not use_fold or placed.select("fold").distinct().limit(MAX_FOLDS + 1).count() <= MAX_FOLDS:
        nth = F.row_number().over(Window.partitionBy("cell", fold).orderBy("near"))
        for x in placed.select("cell", fold.alias("fold"), "near", nth.alias("nth")).where(F.col("nth") <= cells.rank).collect():
            m = cells.least.setdefault(x["fold"], np.full((n, cells.rank), np.inf))
            m[x["cell"], x["nth"] - 1] = x["near"]
    cells.deal(counts, block_rows)


def knn(q: DataFrame, r: DataFrame, k: int, exclude_self: bool = True,
        fold_col: str | None = None, block_rows: int | None = None, metric: str = "euclidean",
        pivots: int | None = None, count=None) -> DataFrame:
    """K4: exact k nearest references for every query, by any metric of K2.

    q: (id, v [, fold]); r: (id, v, label [, fold]).  ``exclude_self`` drops
    a reference with the query's id; ``fold_col`` drops references of the
    query's own fold (cross-validation).  A vector that is null, or has a null
    or non-finite component, takes no part, nor does an all-zero one under the
    cosine; a null label stays null.  ``count`` may be an accumulator; it
    gets the number of distances computed.
    Output: (id, neighbour, rank, distance, neighbour_label), ranked by
    distance rounded to TIE_DIGITS, then neighbour id.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {sorted(METRICS)}")
    spark = q.sparkSession
    fold = [F.col(fold_col).cast("long").alias("fold")] if fold_col else [F.lit(0).cast("long").alias("fold")]
    labels = r.select(F.col("id").alias("neighbour"), F.col("label").alias("neighbour_label"))
    use_fold = fold_col is not None
    qs = complete(q, metric).select("id", F.col("v").cast("array<double>").alias("v"), *fold)
    rs = complete(r, metric).select("id", F.col("v").cast("array<double>").alias("v"), *fold)
    nr = rs.count()
    chosen = rs.orderBy(F.xxhash64("id")).limit(PIVOT_SAMPLE).select("id", "v", "fold").collect()
    sample = [x["v"] for x in chosen]
    if not sample:
        return labels.where("false").select(F.lit(0).cast("long").alias("id"), "neighbour", F.lit(0).alias("rank"),
                                            F.lit(0.0).alias("distance"), "neighbour_label")
    if block_rows is None:
        par = max(1, spark.sparkContext.defaultParallelism)
        more = SIFT_BLOCKS if metric in SIFTED else 1
        block_rows = max(64, min(more * MAX_BLOCK_ROWS, more * MAX_BLOCK_VALUES // max(1, len(sample[0])), math.ceil(nr / math.ceil(math.sqrt(2 * par)))))
    n = pivots or max(1, min(MAX_PIVOTS, round(math.sqrt(nr) / 2)))
    cells = Cells(_pivots(_spread(np.array(sample), metric), n), metric, k + exclude_self)
    placed = cut_lineage(_celled(rs, cells))
    _describe(placed, cells, block_rows, use_fold)
    # sums and maxima of gaps are compared with some references first, as they cost little under a good bound
    early = [x for x in chosen[:nr // SAMPLE_SHARE] if x["id"] is not None and x["fold"] is not None] if metric in SIFTED else []
    early = pd.DataFrame({"rid": [x["id"] for x in early], "rv": [np.array(x["v"]) for x in early], "fold": [x["fold"] for x in early], "cell": 0})
    around = Cells(cells.pivots[:1], metric, cells.rank)
    around.low[:], around.high[:] = -np.inf, np.inf

    def route(frames):
        step = max(1, CHUNK // (len(cells.pivots) * cells.rank * max(1, len(cells.least))))
        for f in frames:
            known = np.full(len(f), np.inf)
            if len(early) and len(f):
                asks = pd.DataFrame({"qid": f["id"], "qv": f["v"], "fold": f["fold"], "cell": 0, "near": np.inf, "bound": np.inf})
                known = _search(asks, early, k, around, exclude_self, use_fold, count)[3]
            for s in range(0, len(f), step):
                part = f.iloc[s:s + step]
                far = cells.to_pivots(_spread(np.stack(part["v"].to_numpy()), metric))
                own = np.argmin(far, axis=1)
                near, fold = far[np.arange(len(far)), own], part["fold"].to_numpy()
                bound = np.minimum(cells.bound(far, fold, use_fold), known[s:s + step])
                i, rb = np.nonzero(cells.blocks_in(cells.within(far, near, own, bound)))
                if len(i):
                    salt = pd.util.hash_array(part["id"].to_numpy(np.int64)).astype(np.int64) & 0xFFFF
                    # queries of a cell go together, at most as many cells a block as the references have
                    yield pd.DataFrame({"qid": part["id"].to_numpy()[i], "qv": part["v"].to_numpy()[i], "fold": fold[i],
                                        "cell": own[i], "near": near[i], "bound": bound[i],
                                        "group": cells.first_block[own][i], "salt": salt[i], "rb": rb})

    asked = cut_lineage(qs.mapInPandas(route, "qid long, qv array<double>, fold long, cell long, near double, bound double, "
                                              "group long, salt long, rb long"))
    # queries of a block of references beyond block_rows are dealt over several tasks
    parts = cut_lineage(asked.groupBy("group", "rb").agg(F.ceil(F.count("*") / F.lit(block_rows)).alias("parts")))
    asked = asked.join(parts, ["group", "rb"]).withColumn("part", F.col("salt") % F.col("parts")).drop("salt", "parts")

    def dealt(frames):
        for f in frames:
            salt = pd.util.hash_array(f["rid"].to_numpy(np.int64)).astype(np.int64) & 0xFFFF
            f["rb"] = cells.block_of(f["cell"].to_numpy(np.int64), salt)
            yield f

    stored = (placed.select(F.col("id").alias("rid"), F.col("v").alias("rv"), "fold", "cell")
              .mapInPandas(dealt, "rid long, rv array<double>, fold long, cell long, rb long"))
    met = parts.select("group", "rb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))

    def block(qp: pd.DataFrame, rp: pd.DataFrame) -> pd.DataFrame:
        return _block_topk(qp, rp, k, cells, exclude_self, use_fold, count)

    # each (group, part, rb) is one block pair of numpy work; pin the partition
    # count so AQE does not pack the (byte-small) block pairs into few tasks
    keys = ["group", "part", "rb"]
    left = partition_for_expansion(asked, *keys)
    right = partition_for_expansion(stored.join(met, "rb"), *keys)
    cand = (left.groupBy(*keys).cogroup(right.groupBy(*keys))
            .applyInPandas(block, "id long, neighbour long, distance double"))
    return (_ranked(cand, k).join(labels, "neighbour")
            .select("id", "neighbour", "rank", "distance", "neighbour_label"))


# ---------------------------------------------------------------- K5-K7
def vote(neigh: DataFrame, max_rank_col: str | None = None) -> DataFrame:
    """Majority label among the labelled neighbours of each id (ties to the lower label)."""
    neigh = neigh.where(F.col("neighbour_label").isNotNull())
    keys = ["id"] + ([max_rank_col] if max_rank_col else [])
    votes = neigh.groupBy(*keys, "neighbour_label").agg(F.count("*").alias("votes"))
    w = Window.partitionBy(*keys).orderBy(F.col("votes").desc(), F.col("neighbour_label").asc())
    return (votes.withColumn("rn", F.row_number().over(w)).where("rn = 1")
            .select(*keys, F.col("neighbour_label").alias("predicted")))


def classify(neigh: DataFrame, truth: DataFrame) -> DataFrame:
    """K5: (id, actual, predicted) from k-NN neighbours and the true labels."""
    return vote(neigh).join(truth.select("id", F.col("label").alias("actual")), "id") \
        .select("id", "actual", "predicted")


def k_sweep(neigh: DataFrame, truth: DataFrame, ks: list[int]) -> DataFrame:
    """K6: accuracy for every k in ``ks`` from one top-max(k) neighbour pass."""
    ex = neigh.select("*", F.explode(F.array(*[F.lit(x) for x in ks])).alias("k")) \
        .where(F.col("rank") <= F.col("k"))
    p = vote(ex, "k").join(truth.select("id", F.col("label").alias("actual")), "id")
    return p.groupBy("k").agg(F.count("*").alias("n"),
                              F.sum((F.col("actual") == F.col("predicted")).cast("int")).cast("bigint").alias("correct")) \
        .select("k", "n", "correct", (F.col("correct") / F.col("n")).alias("accuracy"))


def cross_val(df: DataFrame, k: int, folds: int) -> DataFrame:
    """K7: fold = id mod folds; each vector is classified by its k nearest
    neighbours from the other folds; accuracy per fold."""
    d = df.withColumn("fold", F.pmod(F.col("id"), F.lit(folds)))
    neigh = knn(d, d, k, exclude_self=True, fold_col="fold")
    p = classify(neigh, d).join(d.select("id", "fold"), "id")
    return p.groupBy("fold").agg(F.count("*").alias("n"),
                                 F.sum((F.col("actual") == F.col("predicted")).cast("int")).cast("bigint").alias("correct")) \
        .select("fold", "n", "correct", (F.col("correct") / F.col("n")).alias("accuracy"))


# ---------------------------------------------------------------- K8
def _margins(v: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """(vectors, tables, bits): where each vector lies by ``bits`` random hyperplanes a table."""
    planes = np.random.default_rng(seed).standard_normal((v.shape[1], tables * bits))
    return (v @ planes).reshape(len(v), tables, bits)


def _own_buckets(v: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """(vectors, tables): the bucket of each vector in every table."""
    return (_margins(v, bits, tables, seed) > 0) @ (1 << np.arange(bits))


def _looked_in(v: np.ndarray, bits: int, tables: int, probes: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Table and bucket, each (vectors, probes), of the buckets nearest to each vector (see ``probed``)."""
    wide = min(bits, PROBE_BITS)
    flips = (np.arange(1 << wide)[:, None] >> np.arange(wide)) & 1
    margin = _margins(v, bits, tables, seed)
    order = np.argsort(np.abs(margin), axis=2, kind="stable")[:, :, :wide]
    cost = np.take_along_axis(margin, order, 2) ** 2 @ flips.T
    bucket = ((margin > 0) @ (1 << np.arange(bits)))[:, :, None] ^ ((1 << order) @ flips.T)
    best = np.argsort(cost.reshape(len(v), -1), axis=1, kind="stable")[:, :min(probes, tables << wide)]
    return best >> wide, np.take_along_axis(bucket.reshape(len(v), -1), best, 1)


def signatures(df: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """(id, v, tab, bucket): each vector's side of ``bits`` random hyperplanes, per table."""
    def sign(frames):
        for f in frames:
            if not len(f):
                continue
            bucket = _own_buckets(np.stack(f["v"].to_numpy()), bits, tables, seed)
            yield pd.DataFrame({"id": np.repeat(f["id"].to_numpy(), tables), "v": f["v"].repeat(tables).to_numpy(),
                                "tab": np.tile(np.arange(tables), len(f)), "bucket": bucket.reshape(-1)})

    return (df.where(F.col("v").isNotNull()).select("id", "v")
            .mapInPandas(sign, "id long, v array<double>, tab int, bucket long"))


def probed(df: DataFrame, bits: int, tables: int, probes: int, seed: int) -> DataFrame:
    """(id, v, tab, bucket): the ``probes`` buckets that each vector looks in, of all tables together.

    A bucket costs the squared distances to the hyperplanes between it and the
    vector; the cheapest are taken, the vector's own buckets (cost 0) first.
    Of each table the ``PROBE_BITS`` signs of smallest margin may be flipped.
    """
    def look(frames):
        for f in frames:
            for s in range(0, len(f), PROBE_ROWS):
                part = f.iloc[s:s + PROBE_ROWS]
                tab, bucket = _looked_in(np.stack(part["v"].to_numpy()), bits, tables, probes, seed)
                take = tab.shape[1]
                yield pd.DataFrame({"id": np.repeat(part["id"].to_numpy(), take), "v": part["v"].repeat(take).to_numpy(),
                                    "tab": tab.reshape(-1), "bucket": bucket.reshape(-1)})

    return (df.where(F.col("v").isNotNull()).select("id", "v")
            .mapInPandas(look, "id long, v array<double>, tab int, bucket long"))


def _hashed(df: DataFrame, bits: int, tables: int, probes: int, seed: int) -> DataFrame:
    """(id, v, files, asks, salt), a row a vector: its bucket in every table as 16-bit numbers,
    the buckets it looks in as a bit string over the buckets of all tables, and a number to deal it by."""
    def code(frames):
        seen = TaskContext.get().partitionId()
        for f in frames:
            for s in range(0, len(f), PROBE_ROWS):
                part = f.iloc[s:s + PROBE_ROWS]
                v = np.stack(part["v"].to_numpy())
                own = (_own_buckets(v, bits, tables, seed) + (np.arange(tables) << bits)).astype(np.uint16)
                tab, bucket = _looked_in(v, bits, tables, probes, seed)
                asks = np.zeros((len(v), tables << bits), bool)
                np.put_along_axis(asks, (tab << bits) + bucket, True, axis=1)
                yield pd.DataFrame({"id": part["id"].to_numpy(), "v": part["v"].to_numpy(), "files": [x.tobytes() for x in own],
                                    "asks": [x.tobytes() for x in np.packbits(asks, axis=1)], "salt": np.arange(seen, seen + len(v))})
                seen += len(v)

    return df.select("id", "v").mapInPandas(code, "id long, v array<double>, files binary, asks binary, salt long")


def _met_topk(qp: pd.DataFrame, rp: pd.DataFrame, k: int, buckets: int) -> pd.DataFrame:
    """The k nearest of the references that each query of one block pair meets: (id, neighbour, distance).

    A piece of the references is compared with the queries that look in one of its
    buckets.  Products in single precision only sort out what lies beyond a query's
    bound, with their rounding allowed for; what is left must be filed in a bucket
    that the query looks in, and is ranked by distances in double precision.
    """
    if not len(qp) or not len(rp):
        return pd.DataFrame({"id": np.zeros(0, np.int64), "neighbour": np.zeros(0, np.int64), "distance": np.zeros(0)})
    qv, rv = np.stack(qp["qv"].to_numpy()), np.stack(rp["rv"].to_numpy())
    qid, rid = qp["qid"].to_numpy(np.int64), rp["rid"].to_numpy(np.int64)
    asks = np.frombuffer(b"".join(qp["asks"]), np.uint8).reshape(len(qv), -1)
    files = np.frombuffer(b"".join(rp["files"]), np.uint16).reshape(len(rv), -1)
    # around the references' mean, and scaled: nothing overflows in single precision
    origin, dim = rv.mean(axis=0), rv.shape[1]
    size = max(np.abs(qv - origin).max(initial=0), np.abs(rv - origin).max(initial=0)) or 1.0
    a, b = (((v - origin) / size).astype(np.float32) for v in (qv, rv))
    a2, b2 = ((v * v).sum(axis=1, dtype=float) for v in (a, b))
    off = 4 * (dim + 8) * float(np.finfo(np.float32).eps) * (np.sqrt(a2) + math.sqrt(b2.max(initial=0))) ** 2
    # a row's product with a column is the squared distance less the query's square
    a, b = np.column_stack([-2 * a, np.ones(len(a), np.float32)]), np.column_stack([b, b2.astype(np.float32)])
    bound = np.full(len(qv), np.inf)
    none = np.zeros(0, np.int64)
    kept, found, n_found = (none, none, np.zeros(0)), [], 0  # ranked so far; and (query, reference) since

    def limit(i: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((_loose(bound[i], "euclidean") / size) ** 2 - a2[i] + off[i]).astype(np.float32)[:, None]

    def ranked() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The k nearest of each query among those ranked before and those found since; bounds fall to the k-th."""
        i, j = (np.concatenate(x) for x in zip(*found))
        dist, step = np.empty(len(i)), max(1, PAIRS // dim)
        for s in range(0, len(i), step):
            dist[s:s + step] = _paired(qv[i[s:s + step]], rv[j[s:s + step]], "euclidean")
        i, j, dist = (np.concatenate(x) for x in zip(kept, (i, j, dist)))
        order = np.lexsort((rid[j], np.round(dist, TIE_DIGITS), i))
        i, j, dist = i[order], j[order], dist[order]
        _, nth = _numbered(i)
        last = nth == k - 1
        bound[i[last]] = np.minimum(bound[i[last]], dist[last])
        return i[nth < k], j[nth < k], dist[nth < k]

    # the first references come from all over the block, the others by their buckets
    order = np.lexsort(files.T[::-1])
    first = np.zeros(len(order), bool)
    first[::max(1, len(order) // MEET_FIRST)] = True
    order = np.r_[order[first], order[~first]]
    n_first = np.count_nonzero(first)
    for s in [*range(0, n_first, PIECE), *range(n_first, len(order), PIECE)]:
        at = order[s:min(s + PIECE, n_first if s < n_first else len(order))]
        there = np.zeros(buckets, bool)
        there[files[at]] = True
        asked = np.flatnonzero((asks & np.packbits(there)).any(axis=1))
        piece = np.ascontiguousarray(b[at].T)
        step = max(1, PAIRS // len(at))
        for t in range(0, len(asked), step):
            some = asked[t:t + step]
            d2, reach = a[some] @ piece, limit(some)
            near = d2 <= reach
            n_near = np.count_nonzero(near)
            if not n_near:
                continue
            if n_near * MANY > near.size:
                looks = np.unpackbits(asks[some], axis=1, count=buckets).view(bool)
                met = np.zeros(near.shape, bool)
                for tab in range(files.shape[1]):
                    met |= looks[:, files[at, tab]]
                met &= qid[some][:, None] != rid[at]
                d2[~met] = np.inf
                if len(at) >= k:
                    kth = np.partition(d2, k - 1, axis=1)[:, k - 1]
                    bound[some] = np.minimum(bound[some], np.sqrt(np.maximum(kth + a2[some] + off[some], 0)) * size)
                    reach = limit(some)
                i, j = np.divmod(np.flatnonzero(met & (d2 <= reach)), len(at))
            else:
                i, j = np.divmod(np.flatnonzero(near), len(at))
                filed = files[at[j]]
                met = ((asks[some[i][:, None], filed >> 3] >> (7 - (filed & 7))) & 1).any(axis=1)
                met &= qid[some[i]] != rid[at[j]]
                i, j = i[met], j[met]
            found.append((some[i], at[j]))
            n_found += len(i)
            if n_found > PAIRS:
                kept, found, n_found = ranked(), [], 0
    if found:
        kept = ranked()
    ids, others, dist = kept
    return pd.DataFrame({"id": qid[ids], "neighbour": rid[others], "distance": dist})


def _by_blocks(df: DataFrame, k: int, bits: int, tables: int, seed: int, probes: int) -> DataFrame:
    """Every vector's k nearest rows among those filed in the buckets it looks in: (id, neighbour, rank, distance).

    A vector is sent once to each block of the other side, with its buckets, and not once to each bucket;
    a pair is compared once however many buckets it meets in.
    """
    hashed = cut_lineage(_hashed(df, bits, tables, probes, seed))
    n, dim = hashed.agg(F.count("*"), F.max(F.size("v"))).first()
    par = max(1, df.sparkSession.sparkContext.defaultParallelism)
    rows = max(64, min(MEET_ROWS, MEET_VALUES // max(1, dim or 1), math.ceil(n / math.ceil(math.sqrt(2 * par)))))
    blocks = max(1, math.ceil(n / rows))
    own, others = F.col("salt") % blocks, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    qs = hashed.select(F.col("id").alias("qid"), F.col("v").alias("qv"), "asks", own.alias("x"), others.alias("y"))
    rs = hashed.select(F.col("id").alias("rid"), F.col("v").alias("rv"), "files", others.alias("x"), own.alias("y"))

    def block(qp: pd.DataFrame, rp: pd.DataFrame) -> pd.DataFrame:
        return _met_topk(qp, rp, k, tables << bits)

    # few block pairs of much work each: with more partitions than pairs, few tasks get several
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * blocks * blocks)
    cand = (qs.repartition(parts, "x", "y").groupBy("x", "y").cogroup(rs.repartition(parts, "x", "y").groupBy("x", "y"))
            .applyInPandas(block, "id long, neighbour long, distance double"))
    return _ranked(cand, k).select("id", "neighbour", "rank", "distance")


def _by_bucket(queries: DataFrame, df: DataFrame, k: int, bits: int, tables: int, seed: int, block_rows: int, probes: int) -> DataFrame:
    """The k nearest ids among the k nearest rows of each bucket that a vector looks in: (id, neighbour, rank, distance).

    Buckets are worked on in block pairs of ``block_rows``, so a hot bucket only has more of them.
    """
    keys = ["tab", "bucket"]
    filed = cut_lineage(signatures(df, bits, tables, seed))
    asked = cut_lineage(probed(queries, bits, tables, probes, seed))

    def blocks(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy(*keys).agg(F.ceil(F.count("*") / F.lit(block_rows)).alias(name))

    sizes = cut_lineage(blocks(asked, "xs").join(blocks(filed, "ys"), keys))  # buckets with both sides
    qs = asked.join(sizes, keys).select(
        *keys, F.col("id").alias("qid"), F.col("v").alias("qv"), F.lit(0).alias("fold"),
        F.pmod(F.xxhash64("id"), F.col("xs")).alias("x"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("ys") - 1)).alias("y"))
    rs = filed.join(sizes, keys).select(
        *keys, F.col("id").alias("rid"), F.col("v").alias("rv"), F.lit(0).alias("fold"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("xs") - 1)).alias("x"), F.pmod(F.xxhash64("id"), F.col("ys")).alias("y"))
    keys = [*keys, "x", "y"]

    def block(qp: pd.DataFrame, rp: pd.DataFrame) -> pd.DataFrame:
        qp["cell"], qp["near"], qp["bound"], rp["cell"] = 0, 0.0, np.inf, 0
        cells = Cells(rp["rv"].iloc[0][None] if len(rp) else np.zeros((1, 1)), "euclidean", k)
        cells.low[:], cells.high[:] = 0, np.inf
        return _block_topk(qp, rp, k, cells, True, False)

    cand = (qs.groupBy(*keys).cogroup(rs.groupBy(*keys))
            .applyInPandas(block, "id long, neighbour long, distance double").dropDuplicates(["id", "neighbour"]))
    return _ranked(cand, k).select("id", "neighbour", "rank", "distance")


def knn_approx(df: DataFrame, k: int, bits: int = 6, tables: int = 12, seed: int = 42,
               block_rows: int = 2048, probes: int = 60) -> DataFrame:
    """K8: approximate self k-NN (Euclidean) by hyperplane hashing: (id, neighbour, rank, distance).

    A vector is filed under its ``bits`` signs in every table, and meets those
    filed in the ``probes`` buckets nearest to it (``probed``).  Where these are
    many of all buckets, vectors are dealt to blocks (``_by_blocks``), otherwise
    to each bucket (``_by_bucket``); both give the same rows.  An id that is
    there more than once takes several places of a bucket's k, so vectors with
    such an id, or near one, are always searched bucket by bucket.  A vector
    that is null, or has a null or non-finite component, takes no part.
    Widening: a vector with fewer than k neighbours found is searched exactly
    against all.
    """
    df = complete(df)
    if probes * MEET_SHARE < 1 << bits or tables << bits > MEET_BUCKETS:
        found = cut_lineage(_by_bucket(df, df, k, bits, tables, seed, block_rows, probes))
    else:
        found = cut_lineage(_by_blocks(df, k, bits, tables, seed, probes))
        named = F.coalesce("id", F.lit(-1 << 63))  # what a null id is in a block's results
        twice = cut_lineage(df.groupBy(named.alias("id")).count().where("count > 1").select("id"))
        if not twice.isEmpty():
            near = found.join(twice.withColumnRenamed("id", "neighbour"), "neighbour", "left_semi").select("id")
            again = cut_lineage(twice.union(near).distinct())
            some = df.join(again.withColumnRenamed("id", "again"), named == F.col("again"), "left_semi")
            rest = _by_bucket(some, df, k, bits, tables, seed, block_rows, probes)
            found = cut_lineage(found.join(again, "id", "left_anti").unionByName(rest))
    full = found.groupBy("id").count().where(F.col("count") >= k).select("id")
    short = cut_lineage(df.where(F.col("v").isNotNull()).join(full, "id", "left_anti"))
    if short.isEmpty():
        return found
    wide = knn(short, df, k).select("id", "neighbour", "rank", "distance")
    return found.join(full, "id", "left_semi").unionByName(wide)
