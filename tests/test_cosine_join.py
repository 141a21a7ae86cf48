"""Threshold cosine join against all pairs."""

import math

import numpy as np
import pytest

from quarry.operators import cosine_join as C

SCHEMA = "user long, item string, rating double, extra int"


def brute(rows, threshold):
    cells: dict = {}
    for u, i, x, *_ in rows:
        if u is not None and i is not None and x is not None and math.isfinite(x):
            cells.setdefault(i, {}).setdefault(u, []).append(x)
    v = {i: {u: float(np.mean(x)) for u, x in c.items()} for i, c in cells.items()}
    norm = {i: math.sqrt(sum(x * x for x in c.values())) for i, c in v.items()}
    out = {}
    for a in v:
        for b in v:
            common = v[a].keys() & v[b].keys()
            if a < b and common and norm[a] and norm[b]:
                s = sum(v[a][u] * v[b][u] for u in common) / norm[a] / norm[b]
                if s >= threshold:
                    out[a, b] = (len(common), s)
    return out


def rows_of(seed, n_items=40, n_users=60):
    rng = np.random.default_rng(seed)
    rows = [(int(u), f"i{i}", float(rng.integers(-2, 6)), 1) for i in range(n_items)
            for u in rng.choice(n_users, rng.integers(1, 12), replace=False)]
    rows += [(7, f"i{i}", 5.0, 2) for i in range(n_items)]
    rows += [(u, f"copy{i[1:]}", x * 3, 1) for u, i, x, _ in rows if int(i[1:]) % 5 == 0]
    rows += [(u, "popular", 1.0 + u % 3, 2) for u in range(n_users)]
    return rows + rows[:9] + [(None, "i1", 1.0, 1), (1, None, 1.0, 1), (2, "i2", None, 1), (3, "i3", float("nan"), 1),
                              (4, "i4", float("inf"), 1), (5, "zero", 0.0, 1)]


@pytest.mark.parametrize("threshold", [0.1, 0.5, 0.8, 0.99])
def test_all_pairs_above(spark, threshold):
    rows = rows_of(int(threshold * 100))
    got = {(r.item_a, r.item_b): (r.n_common, r.similarity)
           for r in C.similar_items(spark.createDataFrame(rows, SCHEMA), threshold).collect()}
    expect = brute(rows, threshold)
    near = {p for p, (_, s) in brute(rows, threshold - 1e-9).items() if abs(s - threshold) < 1e-9}
    assert set(got) - near == set(expect) - near and len(expect) > 3
    for p in set(got) & set(expect):
        assert got[p] == (expect[p][0], pytest.approx(expect[p][1], abs=1e-12))


def test_hot_users_and_items_are_split(spark):
    rows = rows_of(3)
    df = spark.createDataFrame(rows, SCHEMA)
    assert {(r.item_a, r.item_b) for r in C.similar_items(df, 0.6, hot_rows=3).collect()} == set(brute(rows, 0.6))


def test_fewer_pairs_are_made(spark):
    df = spark.createDataFrame(rows_of(8, 200, 300), SCHEMA)
    made = C.candidates(C.heads(C.unit_vectors(df), 0.8), 0.8).count()
    assert made * 4 < len(brute(rows_of(8, 200, 300), -2))


def test_empty_and_bounds(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert C.similar_items(none, 0.5).count() == 0
    with pytest.raises(ValueError):
        C.similar_items(none, 0.0)


def test_no_row_per_pair_is_shuffled(spark):
    """Pairs are made where they are summed: no exchange of the candidates is by both items."""
    got = C.candidates(C.heads(C.unit_vectors(spark.createDataFrame(rows_of(8), SCHEMA)), 0.5), 0.5)
    plan = got._jdf.queryExecution().executedPlan().toString()
    by = [line.split("hashpartitioning(")[1].split(")")[0] for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert [x for x in by if x.startswith("a#")] and not [x for x in by if "item_b" in x or "b#" in x]


def stored(spark, work):
    """Bytes shuffled and written below the checkpoint folder by ``work``."""
    import os

    from quarry.session import checkpoint_dir

    top = checkpoint_dir(spark).removeprefix("file:")
    store = spark.sparkContext._jsc.sc().statusStore()

    def now():
        stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
        shuffled = sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))
        return shuffled + sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(top) for f in files)

    before = now()
    work()
    return now() - before


def test_what_is_stored_grows_with_the_ratings(spark):
    """Lists of a user's items are neither shuffled nor written: ten times longer ones take as much a rating."""
    def rows(users, items, seed=1):
        rng = np.random.default_rng(seed)
        return [(u, f"i{i}", float(rng.integers(1, 51)), 1) for u in range(users) for i in rng.choice(1000, items, replace=False)]

    def size(r):
        return stored(spark, lambda: C.similar_items(spark.createDataFrame(r, SCHEMA).repartition(8), 0.2).collect()) / len(r)

    short, long = size(rows(600, 20)), size(rows(60, 200))
    assert long < 1.5 * short and long < 150


def test_items_of_many_pieces_and_blocks(spark, monkeypatch):
    """Blocks and pieces decide nothing, whatever the items' sizes."""
    rows = rows_of(5)
    df = spark.createDataFrame([(u, None if i is None else int(i.encode().hex()[:12], 16), x, e) for u, i, x, e in rows], "user long, item long, rating double, extra int")
    want = {(r.item_a, r.item_b, r.n_common, round(r.similarity, 9)) for r in C.similar_items(df, 0.3).collect()}
    monkeypatch.setattr(C, "PIECE_ROWS", 7)
    monkeypatch.setattr(C, "PRODUCTS", 64)
    got = C.similar_items(df, 0.3, hot_rows=20).collect()
    assert {(r.item_a, r.item_b, r.n_common, round(r.similarity, 9)) for r in got} == want and len(got) == len(want) > 10
