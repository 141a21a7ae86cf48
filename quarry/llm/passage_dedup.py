"""Repeated passages: windows of ``WINDOW`` words that also start in an earlier document.

1. Every document names some of its ``PHRASE``-word phrases: of each window
   the one of least hash.  A window chooses by its own words alone, so all
   copies of a window choose the same phrase; about one phrase in 13 is named.
2. Phrases named by two documents recur; the others' windows are unique.
   Documents of equal words count as one here, the first; in the others every
   window starts in that one, so all their words go.
3. The recurring phrases of a shard of documents are compiled into an
   Aho-Corasick automaton, and the shard's texts are streamed through it, which
   locates every occurrence.  Shards are batches of documents that hold a
   recurring phrase, so automata and streaming grow with the input and no
   document meets phrases that it can't hold.
4. Windows whose chosen phrase was located are compared by the hash (96 bits)
   of all their words, over all documents: the least doc_id that has a window
   keeps it; the words of the same window in larger doc_ids are removed.

Only hashes cross the network, besides each text twice (to its phrases, to its
spans).  Counts combine before the shuffle, and the joins back to documents are
on plain exchanges, which Spark splits if a passage is hot.

Defined results: null text has no words; rows with null doc_id come after all
others (they keep nothing from them); rows of equal doc_id don't count as
earlier than each other; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import common
from quarry.llm.near_dedup import mix, word_hashes
from quarry.llm.tokens import sub_batches

WINDOW = 50
PHRASE = 25
SUB_BATCH = 2 << 20
LAST = (1 << 63) - 1
WHOLE = -1  # in a list of starts: every window of the document

_U = np.uint64


def run_hashes(h: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hash of every run of ``n`` values of ``h``, from runs of half the length."""
    if len(h) < n:
        return np.zeros(0, dtype=np.uint64)
    a, b = _U(0x9E3779B97F4A7C15 ^ 2 * seed), _U(0xC2B2AE3D27D4EB4F)
    out, length, level = None, 0, h
    size = 1
    while size <= n:
        if n & size:
            if out is None:
                out, length = level, size
            else:
                k = len(h) - (length + size) + 1
                out = mix(out[:k] * a + level[length:length + k] * b + _U(size))
                length += size
        if size * 2 <= n:
            k = len(h) - 2 * size + 1
            level = mix(level[:k] * a + level[size:size + k] * b + _U(size))
        size *= 2
    return out


def chosen_phrases(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrase hashes, and per window the place of a phrase of least hash.

    Minima of runs of doubling length; the place rides in the low six bits
    (a window has fewer than 64 phrases).  If the least phrase stands twice in
    a window, either place names the same phrase.
    """
    phrases = run_hashes(h, PHRASE, 1)
    span = WINDOW - PHRASE + 1
    n = len(h) - WINDOW + 1
    if n < 1:
        return phrases, np.zeros(0, dtype=np.int64)
    low = (phrases & ~_U(63)) | (np.arange(len(phrases), dtype=np.uint64) & _U(63))
    size = 1
    while size * 2 <= span:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    low = np.minimum(low[:n], low[span - size:span - size + n])
    first = np.arange(n)
    return phrases, first + (((low & _U(63)).astype(np.int64) - first) & 63)


def _name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct chosen phrases of each document, and a 128-bit mark of its words."""
    for b in batches:
        texts = b.column("text").to_pylist()
        for s, e in sub_batches(texts, SUB_BATCH):
            lists, marks = [], []
            for t in texts[s:e]:
                words = (t or b"").split()
                marks.append(xxhash.xxh3_128_digest(b" ".join(words)))
                if len(words) < WINDOW:
                    lists.append(np.zeros(0, dtype=np.int64))
                    continue
                phrases, at = chosen_phrases(word_hashes(words))
                lists.append(np.unique(phrases[at[np.r_[True, at[1:] != at[:-1]]]]).view(np.int64))
            ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
            mark = np.frombuffer(b"".join(marks), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [b.column("ord").slice(s, e - s), b.column("text_key").slice(s, e - s),
                 pa.array(mark[:, 0]), pa.array(mark[:, 1]),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists)))],
                names=["ord", "text_key", "f1", "f2", "phrases"])


def _locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate windows of documents that come with their recurring phrases' hashes."""
    for b in batches:
        texts, hashes = b.column("text").to_pylist(), b.column("phrases").to_pylist()
        for s, e in sub_batches(texts, SUB_BATCH):
            shard = []
            automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
            for i in range(s, e):
                words = texts[i].split()
                h = word_hashes(words)
                phrases, at = chosen_phrases(h)
                shard.append((i, words, h, at))
                named = np.unique(at)
                recurs = named[np.isin(phrases[named].view(np.int64), np.array(hashes[i], dtype=np.int64))]
                for p in recurs.tolist():
                    automaton.add_word((b" " + b" ".join(words[p:p + PHRASE]) + b" ").decode("utf-8", "replace"), PHRASE)
            if not len(automaton):
                continue
            automaton.make_automaton()
            for i, words, h, at in shard:
                text = (b" " + b" ".join(words) + b" ").decode("utf-8", "replace")
                ends = np.fromiter((end for end, _ in automaton.iter(text)), dtype=np.int64)
                # the closing space of word w stands at the sum of the lengths so far
                close = np.cumsum(np.fromiter((len(w) + 1 for w in text[1:-1].split(" ")), dtype=np.int64))
                found = np.zeros(len(words) + 1, dtype=bool)
                found[np.searchsorted(close, ends) + 1 - PHRASE] = True
                start = np.flatnonzero(found[at])
                if not len(start):
                    continue
                w1 = run_hashes(h, WINDOW, 2)[start]
                w2 = run_hashes(h, WINDOW, 3)[start]
                n = len(start)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, b.column("ord")[i].as_py())), pa.array(np.full(n, b.column("text_key")[i].as_py())),
                     pa.array(start.astype(np.int32)), pa.array(w1.view(np.int64)),
                     pa.array((w2 >> _U(33)).astype(np.int32))],
                    names=["ord", "text_key", "start", "w1", "w2"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts, starts = b.column("text").to_pylist(), b.column("starts").to_pylist()
        for s, e in sub_batches(texts):
            n_words, removed, spans, kept = [], [], [], []
            for t, st in zip(texts[s:e], starts[s:e]):
                words = (t or b"").split()
                out, at, cut = [], 0, []
                if st and min(st) == WHOLE:
                    st, cut = (), [[0, len(words)]]
                for x in sorted(st or ()):
                    if cut and x <= cut[-1][1]:
                        cut[-1][1] = x + WINDOW
                    else:
                        cut.append([x, x + WINDOW])
                for x, y in cut:
                    out += words[at:x]
                    at = y
                out += words[at:]
                n_words.append(len(words))
                removed.append(len(words) - len(out))
                spans.append([{"first": x, "last": y - 1} for x, y in cut])
                kept.append(b" ".join(out))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").slice(s, e - s), b.column("text_key").slice(s, e - s),
                 pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "text_key", "n_words", "n_removed", "removed", "kept_text"])


def cut_passages(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_words, n_removed, removed (word spans, inclusive), kept_text."""
    src = docs.select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("ord"),
                      common.row_key().alias("text_key"), F.col("text").cast("binary").alias("text"))
    named = common.materialise(
        src.select("ord", "text_key", "text")
        .mapInArrow(_name, "ord bigint, text_key bigint, f1 bigint, f2 bigint, phrases array<bigint>")
        .filter("size(phrases) > 0"), "passage-phrases")
    # of documents with equal words, the first stands for all: the others' windows all start in it
    heads = common.materialise(named.groupBy("f1", "f2").agg(F.min("ord").alias("head")), "passage-heads")
    named = named.join(heads, ["f1", "f2"])
    copies = named.filter("ord > head").select("ord", "text_key").distinct()
    named = common.materialise(named.filter("ord = head").select("ord", "text_key", "phrases"), "passage-named")
    each = named.select("ord", "text_key", F.explode("phrases").alias("phrase"))
    recurring = common.materialise(
        each.groupBy("phrase").agg(F.min("ord").alias("lo"), F.max("ord").alias("hi")).filter("lo < hi").select("phrase"),
        "passage-recurring")
    lists = (each.join(recurring, "phrase").groupBy("ord", "text_key")
             .agg(F.collect_set("phrase").alias("phrases")))  # bounded by its own document
    found = common.materialise(
        src.select("ord", "text_key", "text").join(lists, ["ord", "text_key"]).select("ord", "text_key", "text", "phrases")
        .mapInArrow(_locate, "ord bigint, text_key bigint, start int, w1 bigint, w2 int"), "passage-windows")
    first = common.materialise(
        found.groupBy("w1", "w2").agg(F.min("ord").alias("lo"), F.max("ord").alias("hi")).filter("lo < hi")
        .select("w1", "w2", "lo"), "passage-first")
    starts = (found.join(first, ["w1", "w2"]).filter("ord > lo").groupBy("ord", "text_key")
              .agg(F.collect_set("start").alias("starts")))  # bounded by its own document
    starts = starts.unionByName(copies.select("ord", "text_key", F.array(F.lit(WHOLE)).alias("starts")))
    schema = ("doc_id bigint, text_key bigint, n_words bigint, n_removed bigint, "
              "removed array<struct<first: bigint, last: bigint>>, kept_text string")
    return (src.join(starts, ["ord", "text_key"], "left").select("doc_id", "text_key", "text", "starts")
            .mapInArrow(_cut, schema))
