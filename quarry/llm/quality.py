"""Quality classifier: regularised quadratic discriminant over document statistics.

Counts of a whole text (letters, digits, symbols, repeated words and lines, ...)
become rates.  Each rate is drawn towards the labelled rows' overall rate by
``PRIOR_WORDS`` words, so that short texts aren't extreme by chance, then put
on a log-odds scale, standardised and clipped.  Each class has a mean and a
covariance, shrunk towards a multiple of the identity; the score is the
difference of the classes' Gaussian log-densities (Mahalanobis distances by
Cholesky factors that are computed once per fit) plus their log prior odds,
as a logistic of ``1 / TEMPER`` of it: features aren't independent.

Fitting gathers sums, not rows: the driver sees a few hundred numbers, from
all labelled rows.

Defined results: null text is scored as empty; a row's label counts once per
row in ``labels``; null labels count nowhere; without labels of both classes
the score is the smoothed share of the class that is there (0.5 without any);
rows with null doc_id are scored and never learnt from; repeated rows are rows
of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import common

PRIOR_WORDS = 50
SHRINK = 0.1
CLIP = 4.0
TEMPER = 4.0

#: Counts, in order; rates are over bytes, words or lines.
COUNTS = ("bytes", "words", "lines", "upper", "high", "digits", "symbols", "stops", "bangs", "bars",
          "echoes", "distinct", "distinct_lines", "lone_bars")
_OVER_BYTES, _OVER_WORDS, _OVER_LINES = (3, 4, 5, 6, 7), (8, 9, 10, 13), (12,)


def count_text(text: bytes | None) -> list[int]:
    t = text or b""
    c = np.bincount(np.frombuffer(t, np.uint8), minlength=256)
    words, lines = t.split(), t.split(b"\n")
    upper, lower, high = int(c[65:91].sum()), int(c[97:123].sum()), int(c[128:].sum())
    digits, space, stops = int(c[48:58].sum()), int(c[32] + c[9:14].sum()), int(c[46] + c[44])
    return [len(t), len(words), len(lines), upper, high, digits,
            len(t) - upper - lower - high - digits - space - stops, stops, int(c[33]), int(c[124]),
            sum(map(operator.eq, words[1:], words)), len(set(words)), len(set(lines)), words.count(b"|")]


class Model(NamedTuple):
    rates: np.ndarray  # overall counts of the labelled rows
    centre: np.ndarray
    spread: np.ndarray
    means: tuple  # per class, 0 then 1; empty if a class is missing
    factors: tuple  # inverse Cholesky factors
    offsets: tuple  # log prior minus half the log determinant
    share: float  # smoothed share of class 1


def features(counts: np.ndarray, rates: np.ndarray) -> np.ndarray:
    """(rows, features) of counts (rows, len(COUNTS)); ``rates`` as in ``Model``."""
    n, w, lines = counts[:, 0], counts[:, 1], counts[:, 2]
    letters = rates[0] / max(rates[1], 1)  # bytes per word
    out = []
    for ks, over, base, prior in ((_OVER_BYTES, n, rates[0], PRIOR_WORDS * letters),
                                  (_OVER_WORDS, w, rates[1], PRIOR_WORDS),
                                  (_OVER_LINES, lines, rates[2], PRIOR_WORDS * rates[2] / max(rates[1], 1))):
        for k in ks:
            r = (counts[:, k] + prior * rates[k] / max(base, 1)) / (over + max(prior, 1e-9))
            out.append(np.log(r + 0.002) - np.log(1.002 - np.minimum(r, 1)))
    variety = np.log1p(counts[:, 11]) / np.log1p(np.maximum(w, 1))
    out.append((w * variety + PRIOR_WORDS * 0.96) / (w + PRIOR_WORDS))
    out.append(np.log((n + PRIOR_WORDS * letters + 1) / (w + PRIOR_WORDS)))
    return np.column_stack(out)


def held_out(mod: int = 3, rest: int = 1) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % mod == rest, F.lit(False))


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, counts of every whole text."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [count_text(t) for t in b.column("text").to_pylist()]
            flat = pa.array(np.array(rows, dtype=np.float64).reshape(-1))
            ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_key"), pa.ListArray.from_arrays(ends, flat)],
                names=["doc_id", "text_key", "counts"])

    src = docs.select("doc_id", common.row_key().alias("text_key"), F.col("text").cast("binary").alias("text"))
    return src.mapInArrow(count, "doc_id bigint, text_key bigint, counts array<double>")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("counts").flatten().to_numpy().reshape(-1, len(COUNTS))


def _sums(rows: DataFrame, emit) -> dict[int, np.ndarray]:
    """Sums over all rows of ``emit(batch)``, pairs of a class and a vector."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            if b.num_rows:
                for c, v in emit(b):
                    total[c] = total.get(c, 0) + v
        for c, v in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(v), c, np.int32)), pa.array(np.arange(len(v), dtype=np.int32)), pa.array(v)],
                names=["c", "k", "v"])

    got = rows.mapInArrow(part, "c int, k int, v double").groupBy("c", "k").agg(F.sum("v").alias("v")).collect()
    out = {c: np.zeros(max(r.k for r in got if r.c == c) + 1) for c in {r.c for r in got}}
    for r in got:
        out[r.c][r.k] = r.v
    return out


def fit(counts: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Model from the labelled rows of ``counts`` that aren't held out."""
    marks = labels.select(F.col("doc_id").alias("labelled"), F.col(label).cast("int").alias("label")).filter("label in (0, 1)")
    rows = counts.filter(~held_out())
    rows = common.materialise(rows.join(marks, rows["doc_id"] == marks["labelled"]).select("counts", "label"), "quality-train")

    total = _sums(rows, lambda b: [(0, _matrix(b).sum(axis=0))])
    rates = total.get(0, np.zeros(len(COUNTS)))

    def moments(b, centre=None, spread=None):
        x, y = features(_matrix(b), rates), b.column("label").to_numpy()
        if centre is not None:
            x = np.clip((x - centre) / spread, -CLIP, CLIP)
        for c in (0, 1):
            z = x[y == c]
            if len(z):
                yield c, np.concatenate([[len(z)], z.sum(axis=0), (z.T @ z).reshape(-1)])

    first = _sums(rows, moments)
    n = {c: v[0] for c, v in first.items()}
    share = (n.get(1, 0) + 1) / (sum(n.values()) + 2)
    if len(first) < 2:
        return Model(rates, np.zeros(0), np.zeros(0), (), (), (), share)
    d = len(features(np.zeros((1, len(COUNTS))), rates)[0])
    both = first[0] + first[1]
    centre = both[1:d + 1] / both[0]
    var = np.diag(both[d + 1:].reshape(d, d)) / both[0] - centre ** 2
    spread = np.sqrt(np.maximum(var, 1e-12))
    second = _sums(rows, lambda b: moments(b, centre, spread))
    means, factors, offsets = [], [], []
    for c in (0, 1):
        v = second[c]
        m = v[1:d + 1] / v[0]
        cov = v[d + 1:].reshape(d, d) / v[0] - np.outer(m, m)
        cov = (1 - SHRINK) * cov + (SHRINK * np.trace(cov) / d + 1e-6) * np.eye(d)
        low = np.linalg.cholesky(cov)
        means.append(m)
        factors.append(np.linalg.inv(low))
        offsets.append(np.log(v[0] / both[0]) - np.log(np.diag(low)).sum())
    return Model(rates, centre, spread, tuple(means), tuple(factors), tuple(offsets), share)


def score_counts(counts: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(scores, log-density differences) of rows of counts."""
    if not model.means:
        margin = np.full(len(counts), np.log(model.share / (1 - model.share)))
        return 1 / (1 + np.exp(-margin)), margin
    z = np.clip((features(counts, model.rates) - model.centre) / model.spread, -CLIP, CLIP)
    log = [o - 0.5 * (((z - m) @ f.T) ** 2).sum(axis=1) for m, f, o in zip(model.means, model.factors, model.offsets)]
    margin = log[1] - log[0]
    return 1 / (1 + np.exp(-margin / TEMPER)), margin


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, margin (log-density difference), text_key."""
    counts = common.materialise(text_counts(docs), "quality-counts")
    model = fit(counts, labels)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s, m = score_counts(_matrix(b), model)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_key"), pa.array(s), pa.array((s >= 0.5).astype(np.int32)), pa.array(m)],
                names=["doc_id", "text_key", "score", "predicted", "margin"])

    out = counts.mapInArrow(score, "doc_id bigint, text_key bigint, score double, predicted int, margin double")
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted", "margin", "text_key")


def drop_rejected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that score below one half; all columns kept.

    Texts are counted once more in the filter, in place: cheaper than moving
    them to their scores.
    """
    model = fit(common.materialise(text_counts(docs), "quality-counts"), labels)
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                texts = b.column(at).cast(pa.binary()).to_pylist()
                s, _ = score_counts(np.array([count_text(t) for t in texts], dtype=np.float64), model)
                yield b.filter(pa.array(s >= 0.5))

    return docs.mapInArrow(keep, docs.schema)
