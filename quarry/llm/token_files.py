"""Token-id files in patched frame-of-reference blocks.

``write_token_files`` puts the ids of all documents into shard images, in
ascending doc_id order; ``read_token_files`` gives them back per document.

A shard image (little-endian) holds the whole documents of about
``SHARD_IDS`` ids::

    magic "QPF1" | u32 documents | u64 ids | u32 blocks
    u32 n_ids[documents]
    u64 block_start[blocks + 1]      index of the blocks, in bytes from the payload's start
    u32 minimum[blocks] | u8 width[blocks] | u16 exceptions[blocks]
    payload: per block, width * BLOCK / 8 bytes of packed differences, then the
             exceptions' positions (u16) and their high parts (u32)

A block is ``BLOCK`` ids.  Its minimum is subtracted; the width is the bit
length of the ``PERCENTILE`` difference, and larger differences keep their
high parts in the exception list.  Images are rows of a Parquet table (part,
seq, doc_ids, image): Spark's committer makes task retries safe on any store,
and a reader can skip to a shard or, by the index, to a block.

Defined results: null text is empty (its end id alone remains); null doc_ids
come first; repeated rows are documents of their own, side by side; an empty
table gives an empty file and no rows; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm import common
from quarry.llm.tokens import sub_batches, tokenizer

MAGIC = b"QPF1"
BLOCK = 1024
LANES = 64
PERCENTILE = 95
SHARD_IDS = 1 << 20
SHARD_SCHEMA = "part int, seq int, doc_ids array<bigint>, n_ids bigint, image binary"


def pack_blocks(delta: np.ndarray, width: int) -> np.ndarray:
    """(n, BLOCK) differences below 2**width -> (n, width * BLOCK / 64) u64 words.

    Value 16 i + c of a block lies in bits i*width.. of column c.
    """
    n, cols = len(delta), BLOCK // LANES
    lanes = delta.reshape(n, LANES, cols)
    out = np.zeros((n, width, cols), dtype=np.uint64)
    for i in range(LANES):
        word, shift = divmod(i * width, 64)
        v = lanes[:, i]
        out[:, word] |= v << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= v >> np.uint64(64 - shift)
    return out.reshape(n, width * cols)


def unpack_blocks(words: np.ndarray, width: int) -> np.ndarray:
    n, cols = len(words), BLOCK // LANES
    src = words.reshape(n, width, cols)
    out = np.empty((n, LANES, cols), dtype=np.uint64)
    mask = np.uint64((1 << width) - 1)
    for i in range(LANES):
        word, shift = divmod(i * width, 64)
        v = src[:, word] >> np.uint64(shift)
        if shift + width > 64:
            v = v | (src[:, word + 1] << np.uint64(64 - shift))
        out[:, i] = v & mask
    return out.reshape(n, BLOCK)


def _bits(x: np.ndarray) -> np.ndarray:
    """Bit length of values below 2**32."""
    return np.frexp(x.astype(np.float64))[1].astype(np.uint8)


def encode_image(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """Shard image of ``ids`` (below 2**32), of documents with ``counts`` ids each."""
    n_blocks = -(-len(ids) // BLOCK)
    v = np.zeros(n_blocks * BLOCK, dtype=np.uint64)
    v[:len(ids)] = ids
    v[len(ids):] = ids[-1] if len(ids) else 0
    v = v.reshape(n_blocks, BLOCK)
    low = v.min(axis=1) if n_blocks else np.zeros(0, dtype=np.uint64)
    delta = v - low[:, None]
    at = min(BLOCK - 1, BLOCK * PERCENTILE // 100)
    width = _bits(np.partition(delta, at, axis=1)[:, at]) if n_blocks else np.zeros(0, np.uint8)
    over = (delta >> width.astype(np.uint64)[:, None]) > 0
    n_over = over.sum(axis=1).astype(np.uint16)
    packed: list[bytes] = [b""] * n_blocks
    for w in np.unique(width):
        if w == 0:
            continue
        rows = np.flatnonzero(width == w)
        words = pack_blocks(delta[rows] & np.uint64((1 << int(w)) - 1), int(w))
        for r, row in zip(rows.tolist(), words):
            packed[r] = row.tobytes()
    for r in np.flatnonzero(n_over).tolist():
        pos = np.flatnonzero(over[r])
        high = (delta[r, pos] >> np.uint64(width[r])).astype("<u4")
        packed[r] += pos.astype("<u2").tobytes() + high.tobytes()
    start = np.concatenate([[0], np.cumsum([len(p) for p in packed])]).astype("<u8")
    return b"".join([MAGIC, struct.pack("<IQI", len(counts), len(ids), n_blocks),
                     counts.astype("<u4").tobytes(), start.tobytes(), low.astype("<u4").tobytes(),
                     width.tobytes(), n_over.astype("<u2").tobytes(), *packed])


class Image:
    """A parsed shard image; ``block(k)`` decodes one block alone."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a token shard")
        n_docs, self.n_ids, n = struct.unpack_from("<IQI", data, 4)
        at = 4 + 16

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, dtype=kind, count=count, offset=at)
            at += out.nbytes
            return out

        self.counts, self.start = take("<u4", n_docs), take("<u8", n + 1)
        self.low, self.width, self.n_over = take("<u4", n), take("u1", n), take("<u2", n)
        self.data, self.base, self.n_blocks = data, at, n

    def _decode(self, rows: np.ndarray, width: int) -> np.ndarray:
        if width == 0:
            out = np.zeros((len(rows), BLOCK), dtype=np.uint64)
        else:
            size = width * BLOCK // 64
            words = np.stack([np.frombuffer(self.data, "<u8", size, self.base + s)
                              for s in self.start[rows].tolist()])
            out = unpack_blocks(words, width)
        for j, r in enumerate(rows.tolist()):
            if k := int(self.n_over[r]):
                at = self.base + int(self.start[r]) + width * BLOCK // 8
                pos = np.frombuffer(self.data, "<u2", k, at)
                high = np.frombuffer(self.data, "<u4", k, at + 2 * k).astype(np.uint64)
                out[j, pos] |= high << np.uint64(width)
        return out + self.low[rows].astype(np.uint64)[:, None]

    def block(self, k: int) -> np.ndarray:
        ids = self._decode(np.array([k]), int(self.width[k]))[0]
        return ids[:min(BLOCK, self.n_ids - k * BLOCK)].astype(np.uint32)

    def ids(self) -> np.ndarray:
        out = np.empty((self.n_blocks, BLOCK), dtype=np.uint32)
        for w in np.unique(self.width):
            rows = np.flatnonzero(self.width == w)
            out[rows] = self._decode(rows, int(w))
        return out.reshape(-1)[:self.n_ids]


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end_id: int, byte: bool = False) -> None:
    """Tokenise ``docs`` (doc_id, text) and write shard images to ``path``."""
    src = docs.select("doc_id", F.col("text").cast("binary").alias("text"),
                      common.row_key().alias("k"))
    ordered = (src.repartitionByRange("doc_id", "k").sortWithinPartitions("doc_id", "k")
               .select("doc_id", "text"))
    end = np.array([end_id])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tk, part, seq = tokenizer(vocabulary, byte), TaskContext.get().partitionId(), 0
        tail = end.astype(tk.dtype).tobytes()
        doc_ids: list = []
        rows: list[bytes] = []
        size = 0

        def shard() -> pa.RecordBatch:
            nonlocal seq, size
            counts = np.array([len(r) // tk.dtype.itemsize for r in rows])
            image = encode_image(np.frombuffer(b"".join(rows), tk.dtype), counts)
            out = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()),
                 pa.array([doc_ids], pa.list_(pa.int64())), pa.array([int(counts.sum())], pa.int64()),
                 pa.array([image], pa.binary())], names=["part", "seq", "doc_ids", "n_ids", "image"])
            doc_ids.clear()
            rows.clear()
            seq, size = seq + 1, 0
            return out

        for b in batches:
            texts, ids = b.column("text").to_pylist(), b.column("doc_id").to_pylist()
            for s, e in sub_batches(texts):
                for doc, r in zip(ids[s:e], tk.encode_batch(texts[s:e])):
                    doc_ids.append(doc)
                    rows.append(r + tail)
                    size += len(rows[-1])
                    if size >= SHARD_IDS * tk.dtype.itemsize:
                        yield shard()
        if rows:
            yield shard()

    ordered.mapInArrow(encode, SHARD_SCHEMA).write.option("compression", "none").parquet(path)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Documents of a token file: doc_id, start (ids before it), n_tokens, ids_crc32, ids.

    ids is the packed little-endian u32 form, left out if not ``with_ids``.
    The shards' offsets are prefix sums within each part plus the totals of
    earlier parts, so no task orders more rows than there are parts.
    """
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                img = Image(b.column("image")[r].as_py())
                ids, ends = img.ids().astype("<u4"), np.cumsum(img.counts, dtype=np.int64)
                starts = ends - img.counts
                docs = [ids[s:e] for s, e in zip(starts.tolist(), ends.tolist())]
                n = len(docs)
                cols = {"part": pa.array(np.full(n, b.column("part")[r].as_py(), np.int32)),
                        "seq": pa.array(np.full(n, b.column("seq")[r].as_py(), np.int32)),
                        "doc_id": b.column("doc_ids")[r].values, "local": pa.array(starts),
                        "n_tokens": pa.array(img.counts.astype(np.int64)),
                        "ids_crc32": pa.array([zlib.crc32(d) for d in docs], pa.int64())}
                if with_ids:
                    cols["ids"] = pa.array([d.tobytes() for d in docs], pa.binary())
                yield pa.RecordBatch.from_pydict(cols)

    schema = "part int, seq int, doc_id bigint, local bigint, n_tokens bigint, ids_crc32 bigint"
    docs = shards.select("part", "seq", "doc_ids", "image").mapInArrow(
        decode, schema + ", ids binary" * with_ids)
    sizes = shards.select("part", "seq", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inner = Window.partitionBy("part").orderBy("seq")
    offsets = (sizes.withColumn("within", F.sum("n_ids").over(inner) - F.col("n_ids"))
               .join(F.broadcast(before), "part")
               .select("part", "seq", (F.col("before") + F.col("within")).alias("offset")))
    out = docs.join(offsets, ["part", "seq"])
    return out.select("doc_id", (F.col("offset") + F.col("local")).alias("start"), "n_tokens",
                      "ids_crc32", *(["ids"] if with_ids else []))
