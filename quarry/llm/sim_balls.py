"""SimHash near-duplicates by ball hashing, meeting in the middle.

A document's fingerprint has a bit for each of the 64 bits of its shingles'
hashes: set if more than half of the hashes have it.  Every distinct fingerprint
emits all variants within half the radius (2 flips: 2081 of 64 bits); two
fingerprints within the radius meet in a variant, and two that meet in one are
within the radius, which is verified all the same.

Variants aren't shuffled one by one.  A fingerprint goes once to each *prefix*
that its variants have (16 bits: 137 rows for 2081 variants), and the task of a
prefix makes the variants there, sorts them and finds the equal ones.  Prefixes
with more than ``GROUP`` fingerprints are dealt by longer ones instead (32 bits,
then all 64, where a group has at most 2081 members), so a dense ball of
near copies is split however large it is.  Members of a variant are joined to its
smallest fingerprint, and a chunk of groups returns a spanning forest only, so a
group of n costs about n links a prefix and never its pairs.  Links unite by
alternating stars.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; shingles are runs of
four, repeats included, joined by one space; their hash is XXH64 with seed 42.

Defined results: fewer than four words are one shingle; null text, and text
without words, has fingerprint zero, which links like any other; a component is
named by its smallest doc_id (null only if it has no other); repeated rows come
back repeated; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import common
from quarry.llm.near_dedup import components
from quarry.llm.tokens import sub_batches
from quarry.session import partition_for_expansion

SHINGLE = 4
SEED = 42
RADIUS = 4
BITS = 64
PREFIXES = (16, 32, BITS)
#: A prefix with more fingerprints is dealt by the next longer one.
GROUP = 2048
#: Variants made at a time in a task.
VARIANTS = 1 << 22
SUB_BATCH = 1 << 20

_LANES = np.uint64(0x0101010101010101)


def flips(bits: int, radius: int) -> np.ndarray:
    """Masks of ``bits`` bits with at most ``radius`` set."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(bits), r)], dtype=np.uint64)


def shingle_hashes(text: bytes | None) -> list[int]:
    words = (text or b"").lower().split()  # bytes: ASCII case and white space only
    if not words:
        return []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    n = min(SHINGLE, len(words))
    h = xxhash.xxh64_intdigest
    return [h(joined[s:e], SEED) for s, e in zip(starts[:len(words) - n + 1].tolist(), (ends[n - 1:] - 1).tolist())]


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Fingerprints of documents with ``sizes`` hashes each, given one after another."""
    out = np.zeros(len(sizes), dtype=np.uint64)
    some = np.flatnonzero(sizes)
    if not len(some):
        return out
    n = sizes[some]
    runs = -(-n // 255)  # at most 255 hashes fit the byte lanes of a sum
    first = np.cumsum(runs) - runs
    starts = np.repeat(np.cumsum(n) - n, runs) + 255 * (np.arange(runs.sum()) - np.repeat(first, runs))
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & _LANES, starts).astype("<u8").view(np.uint8).reshape(-1, 8)
        counts = np.add.reduceat(lanes.astype(np.int64), first, axis=0)
        for lane in range(8):
            out[some] |= (2 * counts[:, lane] > n).astype(np.uint64) << np.uint64(8 * lane + k)
    return out


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column("text").to_pylist()
        for s, e in sub_batches(texts, SUB_BATCH):
            parts = [shingle_hashes(t) for t in texts[s:e]]
            hashes = np.concatenate([np.array(p, dtype=np.uint64) for p in parts])
            found = majority(hashes, np.array([len(p) for p in parts], dtype=np.int64))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(s, e - s), pa.array(found.view(np.int64))],
                                             names=["doc_id", "fp"])


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """Those of the links that join two trees, taken in turn."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    left, right = [], []
    for x, y in zip(a.tolist(), b.tolist()):
        u, v = root(x), root(y)
        if u != v:
            up[max(u, v)] = min(u, v)
            left.append(x)
            right.append(y)
    return left, right


def meet(key: np.ndarray, fp: np.ndarray, bits: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct links (smallest member, other member) of the variants below the prefixes ``key``.

    A row is a fingerprint and the prefix of some of its variants; what the
    prefix has flipped is no longer free below it.
    """
    half, low = radius // 2, BITS - bits
    top = fp >> np.uint64(low) if low else fp
    room = half - np.bitwise_count(top ^ key).astype(np.int64)
    base = (key << np.uint64(low)) | (fp & np.uint64((1 << low) - 1)) if low else key
    variants, owners = [], []
    for r in range(half + 1):
        at = np.flatnonzero(room == r)
        masks = flips(low, r)
        variants.append((base[at][:, None] ^ masks).reshape(-1))
        owners.append(np.repeat(at, len(masks)))
    v, owner = np.concatenate(variants), np.concatenate(owners)
    ordered = np.sort(v)
    met = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(met):
        return met, met
    at = np.searchsorted(met, v)
    at[at == len(met)] = 0
    hit = met[at] == v
    bucket, member = at[hit], fp[owner[hit]]
    order = np.lexsort((member, bucket))
    bucket, member = bucket[order], member[order]
    first = np.concatenate([[True], bucket[1:] != bucket[:-1]])
    centre = member[np.flatnonzero(first)][np.cumsum(first) - 1]
    pairs = np.unique(np.stack([centre[~first], member[~first]], axis=1), axis=0)
    near = np.bitwise_count(pairs[:, 0] ^ pairs[:, 1]) <= radius
    return pairs[near, 0], pairs[near, 1]


def _linker(bits: int, radius: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Links of rows (key, fp) that come sorted by key; only whole groups are met."""
    half = radius // 2
    cost = np.array([len(flips(BITS - bits, r)) for r in range(half + 1)])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)

        def made(upto: int) -> Iterator[pa.RecordBatch]:
            nonlocal key, fp
            a, b = _forest(*meet(key[:upto], fp[:upto], bits, radius))
            key, fp = key[upto:], fp[upto:]
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (a, b)], names=["a", "b"])

        for batch in batches:
            key = np.concatenate([key, batch.column("key").to_numpy().view(np.uint64)])
            fp = np.concatenate([fp, batch.column("fp").to_numpy().view(np.uint64)])
            while len(key):
                room = half - np.bitwise_count((fp >> np.uint64(BITS - bits)) ^ key).astype(np.int64)
                total = np.cumsum(cost[room])
                ends = np.flatnonzero(key[1:] != key[:-1]) + 1
                if total[-1] <= VARIANTS or not len(ends):
                    break
                fits = ends[total[ends - 1] <= VARIANTS]
                yield from made(int(fits[-1] if len(fits) else ends[0]))
        yield from made(len(key))

    return link


def near_links(fps: DataFrame, radius: int = RADIUS, prefixes: tuple[int, ...] = PREFIXES, group: int = GROUP) -> DataFrame:
    """(a, b): links that connect what lies within ``radius`` of each other, of distinct fingerprints (fp)."""
    found, hot, before = None, None, 0
    for bits in prefixes:
        shift = BITS - bits
        masks = (flips(bits, radius // 2) << np.uint64(shift)).view(np.int64).tolist()
        dealt = fps.select("fp", F.explode(F.lit(masks)).alias("mask")).select(
            F.shiftrightunsigned(F.col("fp").bitwiseXOR(F.col("mask")), shift).alias("key"), "fp")
        if hot is not None:
            dealt = dealt.join(hot, F.shiftrightunsigned("key", bits - before) == hot["hot"], "left_semi")
        if bits < BITS:
            more = common.materialise(dealt.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > group)
                                      .select(F.col("key").alias("hot")), "ball-hot")
            some = not more.isEmpty()
            kept = dealt.join(more, dealt["key"] == more["hot"], "left_anti") if some else dealt
        else:
            more, some, kept = None, False, dealt
        links = (partition_for_expansion(kept, "key").sortWithinPartitions("key")
                 .mapInArrow(_linker(bits, radius), "a bigint, b bigint"))
        found = links if found is None else found.unionByName(links)
        hot, before = more, bits
        if not some:
            break
    return common.materialise(found.distinct(), "ball-links")


def near_groups(docs: DataFrame, radius: int = RADIUS, prefixes: tuple[int, ...] = PREFIXES, group: int = GROUP) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of each row."""
    src = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    rows = common.materialise(src.mapInArrow(_fingerprints, "doc_id bigint, fp bigint"), "ball-rows")
    fps = common.materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "ball-fingerprints")
    comp = common.materialise(components(near_links(fps.select("fp"), radius, prefixes, group), "ball"), "ball-components")
    named = fps.join(comp, fps["fp"] == comp["node"], "left").select("fp", "least", F.coalesce("comp", "fp").alias("comp"))
    named = common.materialise(named, "ball-named")
    least = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    placed = common.materialise(named.join(least, "comp").select("fp", "component_id"), "ball-placed")
    return rows.join(placed, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
