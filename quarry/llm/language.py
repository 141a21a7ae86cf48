"""Language by compression: the smallest result among per-language dictionaries wins.

Each learned language has a raw-content zstandard dictionary of sample texts.
A text is reduced to its letters (ASCII lowered, everything else ASCII becomes
a space), cut into blocks, and every block is compressed with every dictionary;
a language's code length is the sum over all blocks, plus the bits of its share
of the training rows.  The smallest length wins.  A prediction is ``accepted``
unless the margin over the second language is narrow.

Dictionaries come from a bounded sample per language: the ``SAMPLE_TEXTS``
training rows with the least hashes.  Their whole texts are cut into chunks of
``CHUNK`` bytes of letters, and the distinct chunks with the least hashes, from
wherever in a text they are, fill the dictionary.  A dictionary holds at most
``DICTIONARY`` bytes and all of them ``MODEL`` bytes, which is what a worker is
sent, however many languages there are.  Predictions read whole texts.

Defined results: null text, or text without a letter, is ``und`` with score 0;
so is every text if no language could be learnt; rows with null lang or null
doc_id are predicted and never learnt from; equal lengths go to the language
that sorts first; repeated rows are rows of their own; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import common
from quarry.llm.quality import held_out
from quarry.llm.tokens import sub_batches

SAMPLE_TEXTS = 400
CHUNK = 1024
DICTIONARY = 1 << 18
MODEL = 1 << 24
BLOCK = 2048
LEVEL = 5
#: Bits of code length that one unit of log-odds takes, and the narrowest accepted margin in bits.
TEMPER = 16.0
NARROW = 16.0

_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def letters(text: bytes) -> bytes:
    return b" ".join(text.translate(_LETTERS).split())


def chunks(text: bytes) -> list[tuple[int, bytes]]:
    """(hash, chunk) of a whole text's letters."""
    t = letters(text)
    return [(xxhash.xxh64_intdigest(c, CHUNK) >> 1, c) for c in (t[i:i + CHUNK] for i in range(0, len(t), CHUNK))]


def dictionary(found: list[tuple[int, bytes]], size: int) -> bytes:
    """The distinct chunks of least hash, as many as ``size`` bytes hold (one space between them)."""
    out, used = [], 0
    for _, c in sorted(set(found)):
        if used + len(c) > size:
            break
        out.append(c)
        used += len(c) + 1
    return b" ".join(out)


def sampled(rows: DataFrame, counts: dict[str, int]) -> DataFrame:
    """(lang, text): the ``SAMPLE_TEXTS`` rows of least hash of each language; equal rows count once."""
    thin_to = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 4.0 * SAMPLE_TEXTS / n))])
    h = rows.select("lang", "doc_id", F.xxhash64("doc_id", "text").alias("h"))
    # thin by hash first, so that ranks are taken over few rows
    thin = h.filter(F.pmod("h", F.lit(1 << 20)) < F.element_at(thin_to, F.col("lang")) * (1 << 20)).distinct()
    order = Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 20)), "h", "doc_id")
    ids = common.materialise(thin.withColumn("nth", F.row_number().over(order))
                             .filter(F.col("nth") <= SAMPLE_TEXTS).drop("nth"), "language-ids")
    return (rows.withColumn("h", F.xxhash64("doc_id", "text")).join(ids, ["lang", "doc_id", "h"], "left_semi")
            .select("lang", "text"))


def learn(docs: DataFrame) -> tuple[list[str], list[bytes], list[float]]:
    """Languages, their dictionaries and the bits of their shares."""
    rows = (docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(5, 0))
            .select("doc_id", "lang", "text"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return [], [], []
    size = min(DICTIONARY, MODEL // len(counts))
    sample = common.materialise(sampled(rows, counts), "language-sample")
    held = {r["lang"]: r["n"] or 0 for r in
            sample.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n")).collect()}
    # the share of all chunks that reaches the driver: about four dictionaries of each language
    below = {lang: min(1.0, 4.0 * size / max(n, 1)) * 2.0 ** 63 for lang, n in held.items()}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text")):
                kept = [(h, c) for h, c in chunks(text.as_py() or b"") if h < below[lang]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(kept), pa.string()), pa.array([h for h, _ in kept], pa.int64()),
                     pa.array([c for _, c in kept], pa.binary())], names=["lang", "h", "chunk"])

    found = (sample.select("lang", F.col("text").cast("binary").alias("text"))
             .mapInArrow(cut, "lang string, h bigint, chunk binary").distinct())
    by_lang: dict[str, list[tuple[int, bytes]]] = {lang: [] for lang in counts}
    for r in found.toLocalIterator():
        by_lang[r["lang"]].append((r["h"], bytes(r["chunk"])))
    total = sum(counts.values())
    langs = sorted(counts)
    return (langs, [dictionary(by_lang[lang], size) for lang in langs],
            [-math.log2(counts[lang] / total) for lang in langs])


def compressors(dicts: list[bytes]) -> list[zstandard.ZstdCompressor]:
    out = []
    for d in dicts:
        kw = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        if len(d) >= 8:
            data = zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=LEVEL)
            kw["dict_data"] = data
        out.append(zstandard.ZstdCompressor(**kw))
    return out


def code_bits(text: bytes, by_lang: list[zstandard.ZstdCompressor], prior: list[float]) -> list[float]:
    """Code length of a text in each language, in bits."""
    t = letters(text)
    blocks = [t[i:i + BLOCK] for i in range(0, len(t), BLOCK)]
    return [p + 8.0 * sum(len(c.compress(b)) for b in blocks) for c, p in zip(by_lang, prior)]


def predict_language(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, margin (bits), accepted."""
    langs, dicts, prior = learn(docs)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_lang = compressors(dicts)
        for b in batches:
            texts = b.column("text").to_pylist()
            for s, e in sub_batches(texts):
                pred, score, margin = [], [], []
                for t in texts[s:e]:
                    if not langs or not t or not any(map(str.isalpha, t.decode("utf-8", "replace"))):
                        pred.append("und")
                        score.append(0.0)
                        margin.append(0.0)
                        continue
                    bits = np.array(code_bits(t, by_lang, prior))
                    best = int(bits.argmin())
                    rest = np.delete(bits, best) - bits[best]
                    pred.append(langs[best])
                    score.append(1 / (1 + float(np.exp(-rest / TEMPER).sum())))
                    margin.append(float(rest.min()) if len(rest) else 0.0)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(s, e - s), pa.array(pred, pa.string()),
                     pa.array(score, pa.float64()), pa.array(margin, pa.float64())],
                    names=["doc_id", "lang_pred", "score", "margin"])

    src = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    out = src.mapInArrow(predict, "doc_id bigint, lang_pred string, score double, margin double")
    return out.select("doc_id", held_out(5, 0).alias("held_out"), "lang_pred", "score", "margin",
                      ((F.col("lang_pred") != "und") & (F.col("margin") >= NARROW)).alias("accepted"))
