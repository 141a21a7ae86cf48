"""Near-duplicates by SuperMinHash signatures, banding, verification and union.

A document's set holds the 64-bit hashes of its distinct five-word shingles.
SuperMinHash gives each element a random permutation of the signature's slots
and offers (rank in the permutation, uniform fraction) to each slot; a slot
keeps the least.  Ranks are tried in rising order, and a document stops when
every slot holds a lower rank than the next: most need two to five.

Documents of equal sets form one class; the classes' signatures are cut into
bands of ``ROWS`` slots, so many that a link at the threshold is missed with a
chance of at most ``MISS``: 25 at 85 percent (4.3e-7), 37 at 80 (4.2e-7).
Candidates are confirmed on the full sets.

Links need not be listed, only joined up.  The member of a bucket that shares
most buckets with others is its centre and is compared with all others, unless a
bound rules the pair out: shingles that no other candidate has are in no
intersection.  Confirmed links unite components.  What is left are buckets whose
members lie in several components.  There a member is known by its difference
from the centre, which is short where texts were made from one original, and two
members of different components are compared only if their differences share one
of their rarest elements, as many as the threshold asks for (``_across``).  This
misses no pair of a bucket that links, and members that have no more in common
than the original don't meet, however many they are.

Defined results: null text, and text without words, has an empty set, is its
own component and stays; with fewer than five words the whole sequence is the
only shingle; a component is named by its smallest doc_id (null only if it has
no other); of repeated rows one stays; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import common
from quarry.llm.tokens import sub_batches

SHINGLE = 5
PERCENT = 85  # the contract of op5; callers may give another
ROWS = 5
MISS = 5e-7
PRIVATE_PASSES = 2
SUB_BATCH = 1 << 20


def n_bands(percent: int) -> int:
    """The least number of bands that miss a link at the threshold with a chance of at most ``MISS``."""
    return math.ceil(math.log(MISS) / math.log1p(-(percent / 100) ** ROWS)) if percent < 100 else 1


SLOTS = n_bands(PERCENT) * ROWS

_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)
_ODD = [_U(c) for c in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                        0x85EBCA77C2B2AE63, 0x9FB21C651E98DF25)]


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` word hashes; fewer words make no run."""
    if len(h) < n:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(h) - n + 1, dtype=np.uint64)
    for i in range(n):
        out = mix(out + h[i:i + len(out)] * _ODD[i % len(_ODD)])
    return out


def shingle_set(text: bytes | None) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    words = (text or b"").lower().split()  # bytes: ASCII case and white space only
    if not words:
        return np.zeros(0, dtype=np.uint64)
    return np.unique(ngram_hashes(word_hashes(words), min(SHINGLE, len(words))))


def superminhash(elems: np.ndarray, doc: np.ndarray, n_docs: int, slots: int = SLOTS) -> np.ndarray:
    """(n_docs, slots) signatures of the sets given by ``elems`` and their ``doc``.

    Values are rank << 32 | fraction.  Documents without elements keep the
    greatest value everywhere.
    """
    top = np.iinfo(np.int64).max
    sig = np.full(n_docs * slots, top, dtype=np.int64)
    perm = None
    moved: list[tuple[np.ndarray, np.ndarray]] = []  # per rank: place written, its new content
    for j in range(slots):
        x = mix(elems + _U((j + 1) * int(_GOLD) % (1 << 64)))
        k = (j + (((x >> _U(32)) * _U(slots - j)) >> _U(32)).astype(np.int64))
        if perm is None and j == 4:  # few documents are left: write their permutations out
            perm = np.tile(np.arange(slots, dtype=np.int16), (len(elems), 1))
            at = np.arange(len(elems))
            for place, content in moved:
                perm[at, place] = content
        if perm is None:
            slot, here = k.copy(), np.full(len(elems), j)
            for place, content in moved:
                slot = np.where(place == k, content, slot)
                here = np.where(place == j, content, here)
            moved.append((k, here))
        else:
            at = np.arange(len(elems))
            slot = perm[at, k].astype(np.int64)
            perm[at, k] = perm[at, j]
        np.minimum.at(sig, doc * slots + slot, (j << 32) | (x & _U(0xFFFFFFFF)).astype(np.int64))
        open_docs = sig.reshape(n_docs, slots).max(axis=1) >= (j + 1) << 32
        left = open_docs[doc]
        if not left.any():
            break
        if not left.all():
            elems, doc = elems[left], doc[left]
            moved = [(p[left], c[left]) for p, c in moved]
            perm = None if perm is None else perm[left]
    return sig.reshape(n_docs, slots)


def band_hashes(sig: np.ndarray) -> np.ndarray:
    bands = sig.shape[1] // ROWS
    parts = sig.reshape(len(sig), bands, ROWS).astype(np.uint64)
    out = np.broadcast_to(np.arange(bands, dtype=np.uint64) * _GOLD, (len(sig), bands))
    for r in range(ROWS):
        out = mix(out ^ mix(parts[:, :, r] + _ODD[r]))
    return out.astype(np.int64)


_ROWS_SCHEMA = ("row bigint, doc_id bigint, text_key bigint, n_shingles bigint, "
                "f1 bigint, f2 bigint, bands array<bigint>")


def _signer(bands: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for b in batches:
            texts = b.column("text").to_pylist()
            for s, e in sub_batches(texts, SUB_BATCH):
                sets = [shingle_set(t) for t in texts[s:e]]
                n = np.array([len(x) for x in sets], dtype=np.int64)
                hashes = band_hashes(superminhash(np.concatenate(sets), np.repeat(np.arange(len(n)), n), len(n), bands * ROWS))
                marks = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x.tobytes()) for x in sets),
                                      dtype="<i8").reshape(-1, 2)
                ends = np.concatenate([[0], np.cumsum(np.where(n > 0, bands, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + e - s)), b.column("doc_id").slice(s, e - s),
                     b.column("text_key").slice(s, e - s), pa.array(n), pa.array(marks[:, 0]),
                     pa.array(marks[:, 1]),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes[n > 0].reshape(-1)))],
                    names=["row", "doc_id", "text_key", "n_shingles", "f1", "f2", "bands"])
                row += e - s

    return sign


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column("text").to_pylist()
        for s, e in sub_batches(texts, SUB_BATCH):
            sets = [shingle_set(t) for t in texts[s:e]]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("node").slice(s, e - s),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))],
                names=["node", "items"])


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, comp) of undirected links (a, b): comp is the smallest node connected.

    Alternating large and small stars until only stars are left; each step is
    an aggregate and a join.
    """
    edges = common.materialise(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        f"{name}-edges")
    while True:
        ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("leaf"), F.lit(0).alias("root")).unionByName(
            edges.select(F.col("v").alias("x"), F.lit(0).alias("leaf"), F.lit(1).alias("root")))
        tangled = ends.groupBy("x").agg(F.sum("leaf").alias("leaf"), F.max("root").alias("root"))
        if tangled.filter("leaf + root > 1").isEmpty():  # stars only: each leaf has one edge, to a root
            return edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = common.materialise(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")),
                                 f"{name}-low")
        large = common.materialise(
            both.filter("v > u").join(low, "u").filter("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(edges.join(low, "u").filter("u <> m").select("u", F.col("m").alias("v")))
            .distinct(), f"{name}-large")
        low = common.materialise(large.groupBy("u").agg(F.min("v").alias("m")), f"{name}-low")
        edges = common.materialise(
            large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                                          F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
                                        .alias("e")).select("e.*").filter("u <> v").distinct(), f"{name}-edges")


def _across(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): all pairs of one centre's members, of different components, that can link.

    ``members``: centre, node, n, most, comp, centre_comp, centre_n.  Two sets link if their
    difference has at most (n + n')(100 - percent) / (100 + percent) elements, and the
    difference of two members is that of their differences from the centre.  So members far
    from the centre must share an element of those differences among the first few in a
    common order, rarest first: elements of the text that all were made from don't bring
    them together.  One of a pair lies outside the centre's component and looks for the other.
    """
    s, c = sets.select("node", "items"), sets.select(F.col("node").alias("centre"), F.col("items").alias("of_centre"))
    differ = common.materialise(
        members.join(s, "node").join(c, "centre")
        .withColumn("items", F.array_union(F.array_except("items", "of_centre"), F.array_except("of_centre", "items")))
        .withColumn("d", F.size("items")).drop("of_centre"), "near-differences")
    spread = differ.select("centre", "node", F.floor(F.col("n") * (100 - percent) / percent).alias("slack"), F.explode("items").alias("item"))
    frequency = common.materialise(spread.groupBy("centre", "item").agg(F.count("*").alias("df")), "near-frequency")
    member = Window.partitionBy("centre", "node")
    prefix = (spread.join(frequency, ["centre", "item"])
              .withColumn("nth", F.row_number().over(member.orderBy("df", "item")))
              .withColumn("e", F.sum((F.col("df") > 1).cast("int")).over(member))  # elements that any other has
              .filter("nth <= slack + 1 and df > 1").select("centre", "node", "item", "nth", "e"))
    info = differ.drop("items")
    entries = common.materialise(prefix.join(info, ["centre", "node"]), "near-prefixes")

    def met(left: DataFrame, right: DataFrame, on: list[str], cond: str) -> DataFrame:
        other = right.select(*on, *[F.col(x).alias(f"{x}_2") for x in right.columns if x not in (*on, "centre", "centre_comp", "centre_n", "item")])
        fits = (f"comp <> comp_2 and 100 * least(most, most_2) >= {percent} * (n + n_2 - least(most, most_2)) and "
                f"(100 + {percent}) * abs(d - d_2) <= (100 - {percent}) * (n + n_2)")
        # in the join's own condition, so that only such pairs leave it
        return left.join(other, on).filter(f"{fits} and {cond}").select(
            F.least("node", "node_2").alias("a"), F.greatest("node", "node_2").alias("b"))

    outside = "comp <> centre_comp"
    # with their first common element in these places, the differences have at most so many in common
    common_most = "least(e, e_2, 1 + d - nth, 1 + d_2 - nth_2)"
    shared = met(entries.filter(outside), entries, ["centre", "item"],
                 f"(100 + {percent}) * (d + d_2 - 2 * {common_most}) <= (100 - {percent}) * (n + n_2)")
    # differences so small that they need no common element: members longer than the centre
    close = met(info.filter(outside).filter(f"{percent} * d <= {100 - percent} * n"),
                info.filter(f"n > centre_n and (100 + {percent}) * d <= (100 - {percent}) * (n - centre_n)"), ["centre"],
                f"(100 + {percent}) * (d + d_2) <= (100 - {percent}) * (n + n_2)")
    return shared.unionByName(close).distinct()


def near_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_key, n_links of each row.

    Documents link if their sets have a Jaccard similarity of ``percent`` / 100 or more.
    n_links counts the confirmed links that the row's class took part in; it
    tells joined classes from lone ones, not the degree in the full graph.
    """
    src = docs.select("doc_id", common.row_key().alias("text_key"), F.col("text").cast("binary").alias("text"))
    rows = common.materialise(src.select("doc_id", "text_key", "text").mapInArrow(_signer(n_bands(percent)), _ROWS_SCHEMA), "near-rows")
    classes = common.materialise(
        rows.filter("n_shingles > 0").groupBy("n_shingles", "f1", "f2").agg(F.min("row").alias("node")), "near-classes")
    member = common.materialise(
        rows.filter("n_shingles > 0").join(classes, ["n_shingles", "f1", "f2"])
        .select("row", "node", "doc_id", "text_key", "n_shingles", F.when(F.col("row") == F.col("node"), F.col("bands")).alias("bands"))
        .unionByName(rows.filter("n_shingles = 0").select(
            "row", F.col("row").alias("node"), "doc_id", "text_key", "n_shingles", F.lit(None).cast("array<bigint>").alias("bands"))),
        "near-members")

    entry = member.filter("bands is not null").select("node", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    shared = common.materialise(entry.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1"), "near-shared")
    alive = common.materialise(entry.join(shared, "bucket"), "near-buckets")

    # the full sets of classes that share a bucket, from a second pass over their texts
    weight = common.materialise(alive.groupBy("node", "n").agg(F.sum("size").alias("weight")), "near-busy")
    heads = (member.filter("row = node").join(weight, "node", "left_semi")
             .select("node", F.col("doc_id").alias("head_id"), F.col("text_key").alias("head_key")))
    sets = common.materialise(
        src.join(heads, src["doc_id"].eqNullSafe(heads["head_id"]) & (src["text_key"] == heads["head_key"]))
        .select("node", "text").mapInArrow(_sets, "node bigint, items array<bigint>").dropDuplicates(["node"]), "near-sets")

    # Shingles that no other such class has can't be in an intersection.  Classes
    # that have too many link with none; without them, more shingles are private.
    able = weight
    for _ in range(PRIVATE_PASSES):
        left = sets if able is weight else sets.join(able.select("node"), "node", "left_semi")
        own = (left.select("node", F.explode("items").alias("item")).groupBy("item")
               .agg(F.count("*").alias("df"), F.min("node").alias("node")).filter("df = 1")
               .groupBy("node").agg(F.count("*").alias("own")))
        able = common.materialise(
            able.select("node", "n", "weight").join(own, "node", "left")
            .withColumn("most", F.col("n") - F.coalesce("own", F.lit(0)))
            .filter(f"100 * most >= {percent} * n").select("node", "n", "most", "weight"), "near-able")
    alive = common.materialise(alive.select("bucket", "node").join(able, "node"), "near-buckets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        a = sets.select(F.col("node").alias("a"), F.col("items").alias("ia"))
        b = sets.select(F.col("node").alias("b"), F.col("items").alias("ib"))
        both = F.size(F.array_intersect("ia", "ib"))
        return (pairs.join(b, "b").join(a, "a").withColumn("both", both)
                .filter(100 * F.col("both") >= percent * (F.size("ia") + F.size("ib") - F.col("both")))
                .select("a", "b"))

    # an intersection has at most least(most) shingles, a union at least the rest
    fits = (f"100 * least(most, centre_most) >= {percent} * (n + centre_n - least(most, centre_most))")
    named = [F.col("node").alias("centre"), F.col("n").alias("centre_n"), F.col("most").alias("centre_most")]
    # the member that shares most with the others: often the text that the others were made from
    first = common.materialise(
        alive.groupBy("bucket").agg(F.max_by(F.struct("node", "n", "most"), F.struct("weight", "node")).alias("c"),
                                    F.count("*").alias("size")).filter("size > 1").select("bucket", "c.*")
        .select("bucket", *named), "near-centres")
    alive = common.materialise(alive.join(first, "bucket").filter("node <> centre"), "near-buckets")
    pairs = alive.filter(fits).select(F.greatest("node", "centre").alias("b"), F.least("node", "centre").alias("a"))
    links = common.materialise(confirmed(common.materialise(pairs.distinct().select("a", "b"), "near-pairs")), "near-links")
    comp = components(links)

    # buckets whose members lie in several components: each member by its difference from the centre
    placed = alive.join(comp, "node", "left").select("bucket", "centre", "node", "n", "most", F.coalesce("comp", "node").alias("comp"))
    own = first.join(comp.withColumnsRenamed({"node": "centre", "comp": "linked"}), "centre", "left").select(
        "bucket", F.coalesce("linked", "centre").alias("centre_comp"), "centre_n")
    placed = common.materialise(placed.join(own, "bucket"), "near-placed")
    mixed = placed.filter("comp <> centre_comp").select("bucket").distinct()
    members = common.materialise(
        placed.join(mixed, "bucket", "left_semi")
        .groupBy("centre", "node").agg(*[F.first(c).alias(c) for c in ("n", "most", "comp", "centre_comp", "centre_n")]), "near-mixed")
    if not members.isEmpty():
        fresh = common.materialise(_across(members, sets, percent), "near-pairs")
        more = common.materialise(confirmed(fresh), "near-links")
        if not more.isEmpty():
            links = common.materialise(links.unionByName(more).distinct(), "near-links")
            comp = components(links)

    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    joined = common.materialise(comp.join(degree, "node", "full"), "near-joined")
    placed = (member.drop("bands").join(joined, "node", "left")
              .select("row", "doc_id", "text_key", "n_shingles", F.coalesce("comp", "node").alias("comp"),
                      F.coalesce("n_links", F.lit(0)).alias("n_links")))
    placed = common.materialise(placed, "near-placed")
    least = common.materialise(placed.groupBy("comp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("least")), "near-least")
    return placed.join(least, "comp").select(
        "doc_id", "n_shingles", F.col("least.doc_id").alias("component_id"),
        (F.col("row") == F.col("least.row")).alias("kept"), "text_key", "n_links")


def drop_near_copies(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component, all columns kept."""
    groups = common.materialise(near_groups(docs, percent), "near-groups")
    repeated = not groups.groupBy("doc_id", "text_key").count().filter("count > 1").isEmpty()
    return common.keep_rows(docs, groups.filter("kept"), one_per_key=repeated)
