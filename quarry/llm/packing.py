"""Packing documents into sequences along a space-filling curve.

Each document's ids are hashed into a signed count vector of ``HASH_DIMS``
places, normalised, and projected to ``DIMS`` coordinates; their Hilbert key
orders the documents, so that neighbours on the curve have similar contents.
Documents are cut freely: sequence s holds ids [s * length, (s + 1) * length)
of the curve's order, and only the last one is padded.

The ids are tokenised once and kept in a table.  The order is a range sort of
(key, doc_id, row) alone; prefix sums per range and over the ranges' totals
give each document's place, which joins back to its ids.

Defined results: null text is empty (the end id alone remains); rows of equal
key follow doc_id (null first), then the table's order; repeated rows are
documents of their own; an empty table gives no pieces; other columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import common
from quarry.llm.tokens import sub_batches, tokenizer

HASH_DIMS = 256
DIMS = 3
BITS = 10
SEED = 11


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index on the Hilbert curve of integer cells (n, dims) below 2**bits."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the rotations, from the largest cube down
        low = q - 1
        for i in range(dims):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[dims - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def projection(vocab: int) -> tuple[np.ndarray, np.ndarray]:
    """Per id: its hashed place, ``HASH_DIMS`` further on if its sign is minus; per place: its projected coordinates."""
    with np.errstate(over="ignore"):
        h = (np.arange(vocab, dtype=np.uint64) + np.uint64(SEED)) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    place = (h >> np.uint64(40)) % np.uint64(HASH_DIMS)
    minus = (h >> np.uint64(33)) & np.uint64(1)
    return (place + minus * np.uint64(HASH_DIMS)).astype(np.int64), np.random.default_rng(SEED).standard_normal((HASH_DIMS, DIMS))


def curve_keys(docs: list[np.ndarray], tables) -> np.ndarray:
    """Hilbert keys of documents given by their ids."""
    place, matrix = tables
    vec = np.empty((len(docs), HASH_DIMS))
    for row, ids in zip(vec, docs):
        n = np.bincount(place[ids], minlength=2 * HASH_DIMS)
        np.subtract(n[:HASH_DIMS], n[HASH_DIMS:], out=row, casting="unsafe")
    norm = np.linalg.norm(vec, axis=1, keepdims=True)
    xy = (vec / np.where(norm == 0, 1, norm)) @ matrix
    unit = 1 / (1 + np.exp(-1.702 * xy))  # near the normal distribution function
    return hilbert_key(np.minimum((unit * (1 << BITS)).astype(np.int64), (1 << BITS) - 1))


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int, length: int = 2048,
                   byte: bool = True, with_ids: bool = True) -> DataFrame:
    """Pieces of the packed sequences, one row each.

    doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the
    piece's ids (little-endian u32, packed) if ``with_ids``.
    """
    end = np.array([end_id])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tk = tokenizer(vocabulary, byte)
        tables, tail = projection(tk.tk.get_vocab_size()), end.astype(tk.dtype).tobytes()
        row = TaskContext.get().partitionId() << 33
        for b in batches:
            sizes = pc.fill_null(pc.binary_length(b.column("text")), 0).to_pylist()
            for s, e in sub_batches(sizes):
                raw = tk.encode_batch(b.column("text").slice(s, e - s).to_pylist())
                counts = np.array([len(r) // tk.dtype.itemsize for r in raw])
                keys = curve_keys([np.frombuffer(r, tk.dtype) for r in raw], tables)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + e - s)), b.column("doc_id").slice(s, e - s),
                     pa.array(keys), pa.array(counts.astype(np.int64) + 1),
                     pa.array([r + tail for r in raw], pa.binary())],
                    names=["row", "doc_id", "key", "n", "ids"])
                row += e - s

    src = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    tokens = common.materialise(
        src.mapInArrow(encode, "row bigint, doc_id bigint, key bigint, n bigint, ids binary"), "packing-ids")

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b.column("n").to_numpy()
            ends = total + np.cumsum(n)
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array(np.full(len(n), part, np.int32)), pa.array(ends - n), pa.array(n)],
                names=["row", "part", "within", "n"])
            total = int(ends[-1]) if len(ends) else total

    order = tokens.select("key", "doc_id", "row", "n")
    placed = common.materialise(
        order.repartitionByRange("key", "doc_id", "row").sortWithinPartitions("key", "doc_id", "row")
        .select("row", "n").mapInArrow(running, "row bigint, part int, within bigint, n bigint"), "packing-order")
    parts = placed.groupBy("part").agg(F.sum("n").alias("n"))  # a row for each range: bounded by the shuffle partitions
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    place = placed.join(F.broadcast(before), "part").select("row", (F.col("before") + F.col("within")).alias("at"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = tokenizer(vocabulary, byte).dtype
        for b in batches:
            at, n = b.column("at").to_numpy(), b.column("n").to_numpy()
            first, last = at // length, (at + n - 1) // length
            pieces = last - first + 1
            doc = np.repeat(np.arange(len(n)), pieces)
            nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            seq = first[doc] + nth
            start = np.maximum(seq * length - at[doc], 0)
            stop = np.minimum((seq + 1) * length - at[doc], n[doc])
            raw, seen, ids = b.column("ids"), -1, None
            crc, out = [], []
            for d, s, e in zip(doc.tolist(), start.tolist(), stop.tolist()):
                if d != seen:
                    ids, seen = np.frombuffer(raw[d].as_py(), width).astype("<u4"), d
                crc.append(zlib.crc32(ids[s:e]))
                if with_ids:
                    out.append(ids[s:e].tobytes())
            cols = {"doc_id": b.column("doc_id").take(pa.array(doc)), "start": pa.array(start),
                    "length": pa.array(stop - start), "ids_crc32": pa.array(crc, pa.int64()),
                    "doc_tokens": pa.array(n[doc]), "sequence_id": pa.array(seq),
                    "offset": pa.array(at[doc] + start - seq * length)}
            if with_ids:
                cols["ids"] = pa.array(out, pa.binary())
            yield pa.RecordBatch.from_pydict(cols)

    schema = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
              "sequence_id bigint, offset bigint" + ", ids binary" * with_ids)
    return (tokens.select("row", "doc_id", "n", "ids").join(place, "row")
            .select("doc_id", "n", "ids", "at").mapInArrow(cut, schema))
