"""Ranking measures against pair counting."""

import math

import pytest

from quarry.operators import ranking


def table(spark, rows):
    return spark.createDataFrame(rows, "actual int, score double")


def brute(rows):
    rows = [(a, s) for a, s in rows if a is not None and s is not None and not math.isnan(s)]
    pos, neg = [s for a, s in rows if a == 1], [s for a, s in rows if a != 1]
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    ap = [sum(p >= t for p in pos) / sum(s >= t for _, s in rows) for t in pos]
    return (len(rows), len(pos), wins / (len(pos) * len(neg)) if pos and neg else None, sum(ap) / len(ap) if ap else None)


ROWS = [(i * 7 % 3 == 1 and 1 or 0, float(i * i % 11) - 5) for i in range(60)] + [
    (None, 1.0), (1, None), (1, float("nan")), (0, float("inf")), (1, float("-inf")), (0, 0.0), (1, -0.0)]


@pytest.mark.parametrize("rows", [ROWS, [], [(1, 0.5)], [(0, 0.5), (0, 0.5)], [(1, 2.0), (0, 2.0)]])
def test_measures(spark, rows):
    got = ranking.measures(table(spark, rows)).collect()
    assert len(got) == 1
    for g, e in zip(tuple(got[0]), brute(rows)):
        assert g == (e if e is None else pytest.approx(e, abs=1e-12))


def test_precision_recall(spark):
    got = ranking.precision_recall(table(spark, ROWS)).collect()
    rows = [(a, s) for a, s in ROWS if a is not None and s is not None and not math.isnan(s)]
    assert sorted(r.threshold for r in got) == sorted({s + 0.0 for _, s in rows})
    n_pos = sum(a for a, _ in rows)
    for r in got:
        tp, n = sum(a for a, s in rows if s >= r.threshold), sum(s >= r.threshold for _, s in rows)
        assert (r.tp, r.fp) == (tp, n - tp)
        assert (r.precision, r.recall, r.fall_out) == (tp / n, tp / n_pos, (n - tp) / (len(rows) - n_pos))
    assert ranking.precision_recall(table(spark, [])).count() == 0
