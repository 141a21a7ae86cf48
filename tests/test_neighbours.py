import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions.vectors import chebyshev, cosine_distance, euclidean, manhattan
from quarry.operators import neighbours as K
from tests.conftest import SF001


def test_metrics_on_3_4_5(spark):
    df = spark.createDataFrame([([0.0, 0.0], [3.0, 4.0])], "a array<double>, b array<double>")
    r = df.select(euclidean("a", "b").alias("e"), manhattan("a", "b").alias("m"),
                  chebyshev("a", "b").alias("c"), cosine_distance("a", "b").alias("cos")).first()
    assert (r["e"], r["m"], r["c"]) == (5.0, 7.0, 4.0)
    assert r["cos"] is None  # all-zero vector has no direction


def _brute(vecs, ids, k, folds=None):
    d = np.sqrt(((vecs[:, None, :] - vecs[None, :, :]) ** 2).sum(-1))
    out = set()
    for i in range(len(ids)):
        cand = [j for j in range(len(ids)) if j != i and (folds is None or folds[i] != folds[j])]
        cand.sort(key=lambda j: (round(d[i, j], 9), ids[j]))
        for rank, j in enumerate(cand[:k], 1):
            out.add((int(ids[i]), int(ids[j]), rank))
    return out


@pytest.mark.parametrize("block_rows", [64, 1000])
def test_knn_equals_brute_force(spark, block_rows):
    from quarry.sources.fixtures import labelled_vectors

    df = labelled_vectors(spark, SF001)
    local = df.orderBy("id").collect()
    ids = np.array([r["id"] for r in local])
    vecs = np.array([r["v"] for r in local])
    got = {(r["id"], r["neighbour"], r["rank"]) for r in
           K.knn(df, df.repartition(3), 4, block_rows=block_rows).collect()}
    assert got == _brute(vecs, ids, 4)


def test_knn_fold_exclusion(spark):
    from quarry.sources.fixtures import labelled_vectors

    df = labelled_vectors(spark, SF001).withColumn("fold", F.pmod("id", F.lit(3)))
    local = df.orderBy("id").collect()
    ids = np.array([r["id"] for r in local])
    vecs = np.array([r["v"] for r in local])
    got = {(r["id"], r["neighbour"], r["rank"]) for r in
           K.knn(df, df, 3, fold_col="fold", block_rows=100).collect()}
    assert got == _brute(vecs, ids, 3, folds=ids % 3)


def test_vote_ties_to_lower_label(spark):
    n = spark.createDataFrame([(1, 2, 1, 0.1, 7), (1, 3, 2, 0.2, 5)],
                              "id long, neighbour long, rank int, distance double, neighbour_label int")
    assert K.vote(n).first()["predicted"] == 5


def test_scale_constant_dimension(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 4.0])], "id long, v array<double>")
    mm = {r["id"]: r["v"] for r in K.scale(df, "v", "minmax").collect()}
    assert mm == {1: [0.0, 0.0], 2: [0.0, 1.0]}
    zs = {r["id"]: r["v"] for r in K.scale(df, "v", "standard").collect()}
    assert zs[1][0] == 0.0 and zs[2][1] == pytest.approx(1 / np.sqrt(2))


def test_triangle_inequality_and_self_distance(spark):
    from quarry.sources.fixtures import labelled_vectors

    df = labelled_vectors(spark, SF001)
    n = K.knn(df, df, 1, exclude_self=False).collect()
    assert all(r["neighbour"] == r["id"] and r["distance"] == 0.0 for r in n)
    v = {r["id"]: np.array(r["v"]) for r in df.limit(30).collect()}
    ids = sorted(v)
    tri = spark.createDataFrame([(a, b, c, v[a].tolist(), v[b].tolist(), v[c].tolist())
                                 for a in ids[:6] for b in ids[6:12] for c in ids[12:18]],
                                "a long, b long, c long, va array<double>, vb array<double>, vc array<double>")
    for r in tri.select(euclidean("va", "vc").alias("ac"), euclidean("va", "vb").alias("ab"),
                        euclidean("vb", "vc").alias("bc")).collect():
        assert r["ac"] <= r["ab"] + r["bc"] + 1e-12


@pytest.mark.parametrize("metric", ["manhattan", "chebyshev", "cosine"])
def test_knn_by_metric(spark, metric):
    rng = np.random.default_rng(1)
    vecs = rng.standard_normal((90, 5))
    df = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(vecs)], "id long, v array<double>, label int")
    got = {(r["id"], r["rank"]): r["neighbour"] for r in K.knn(df, df, 4, metric=metric, block_rows=25).collect()}
    gap = np.abs(vecs[:, None] - vecs[None])
    unit = vecs / np.linalg.norm(vecs, axis=1, keepdims=True)
    d = {"manhattan": gap.sum(-1), "chebyshev": gap.max(-1), "cosine": 1 - unit @ unit.T}[metric]
    for i in range(90):
        near = sorted((j for j in range(90) if j != i), key=lambda j: (round(d[i, j], 9), j))[:4]
        assert [got[i, r] for r in range(1, 5)] == near


def test_knn_without_labels_and_vectors(spark):
    rows = [(1, [0.0, 0.0], None), (2, [1.0, 0.0], 4), (3, None, 5), (4, [0.0, 3.0], None)]
    df = spark.createDataFrame(rows, "id long, v array<double>, label int")
    n = K.knn(df, df, 2)
    got = {(r["id"], r["rank"]): (r["neighbour"], r["neighbour_label"]) for r in n.collect()}
    assert got == {(1, 1): (2, 4), (1, 2): (4, None), (2, 1): (1, None), (2, 2): (4, None), (4, 1): (1, None), (4, 2): (2, 4)}
    assert {r["id"]: r["predicted"] for r in K.vote(n).collect()} == {1: 4, 4: 4}
    assert K.knn(df.where("false"), df, 2).count() == 0


def test_distance_of_given_pairs(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0], [3.0, 4.0]), (2, [1.0, 0.0], [0.0, 1.0])], "id long, a array<double>, b array<double>")
    r = {x["id"]: x for x in K.distance(df).collect()}
    assert (r[1]["euclidean"], r[1]["manhattan"], r[1]["chebyshev"], r[1]["cosine"]) == (5.0, 7.0, 4.0, None)
    assert r[2]["cosine"] == 1.0


def plain_neighbours(vecs, k, metric, fold=None):
    gap = np.abs(vecs[:, None] - vecs[None])
    if metric == "cosine":
        norm = np.sqrt((vecs * vecs).sum(-1))
        d = 1 - (vecs[:, None] * vecs[None]).sum(-1) / (norm[:, None] * norm[None])
    else:
        d = {"euclidean": np.sqrt((gap * gap).sum(-1)), "manhattan": gap.sum(-1), "chebyshev": gap.max(-1)}[metric]
    n = range(len(vecs))
    return {(i, r): j for i in n for r, j in enumerate(
        sorted((j for j in n if j != i and (fold is None or i % fold != j % fold)), key=lambda j: (round(d[i, j], 9), j))[:k], 1)}


def vectors(spark, vecs):
    return spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(vecs)], "id long, v array<double>, label int")


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "chebyshev", "cosine"])
@pytest.mark.parametrize("offset", [0, 1e7, 1e8])
def test_knn_is_exact_at_any_offset(spark, offset, metric):
    vecs = np.random.default_rng(7).standard_normal((200, 8)) + offset
    df = vectors(spark, vecs)
    got = {(r["id"], r["rank"]): r["neighbour"] for r in K.knn(df, df, 5, metric=metric, block_rows=60).collect()}
    assert got == plain_neighbours(vecs, 5, metric)


def test_knn_prunes_more_the_larger_the_table(spark):
    """Exact on clusters, a third of the rows equal; the share of distances computed falls with size."""
    rng = np.random.default_rng(3)
    shares = []
    for n in (400, 4000):
        centres = rng.standard_normal((12, 6)) * 20
        vecs = centres[rng.integers(0, 12, n)] + rng.standard_normal((n, 6))
        vecs[: n // 3] = centres[0]
        df, count = vectors(spark, vecs), spark.sparkContext.accumulator(0)
        got = {(r["id"], r["rank"]): r["neighbour"] for r in K.knn(df, df, 4, count=count).collect()}
        shares.append(count.value / n / n)
        if n == 400:
            assert got == plain_neighbours(vecs, 4, "euclidean")
        else:
            assert len(got) == 4 * n
            for i in [0, 1, *range(n // 3, n, 97)]:
                d = np.sqrt(((vecs - vecs[i]) ** 2).sum(-1))
                near = sorted((j for j in range(n) if j != i), key=lambda j: (round(d[j], 9), j))[:4]
                assert [got[i, r] for r in range(1, 5)] == near
    assert shares[1] < shares[0] / 1.5 and shares[1] < 0.3


def test_knn_of_other_folds_and_few_references(spark):
    vecs = np.random.default_rng(5).standard_normal((90, 3))
    df = vectors(spark, vecs).withColumn("fold", F.col("id") % 4)
    got = {(r["id"], r["rank"]): r["neighbour"] for r in K.knn(df, df, 6, fold_col="fold", block_rows=20).collect()}
    assert got == plain_neighbours(vecs, 6, "euclidean", fold=4)
    few = df.where("id < 3")
    assert K.knn(df, few, 6).count() == 3 * 90 - 3  # all there are


def test_vectors_with_gaps_take_no_part(spark):
    rows = [(0, [0.0, None], 1), (1, [0.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [float("nan"), 0.0], 1), (4, [0.0, 3.0], 1),
            (5, None, 1), (6, [float("inf"), 0.0], 1)]
    df = spark.createDataFrame(rows, "id long, v array<double>, label int")
    got = {(r["id"], r["rank"]): r["neighbour"] for r in K.knn(df, df, 2).collect()}
    assert got == {(1, 1): 2, (1, 2): 4, (2, 1): 1, (2, 2): 4, (4, 1): 1, (4, 2): 2}
    assert {(r["id"], r["neighbour"]) for r in K.knn(df, df, 2, metric="cosine").collect()} == {(2, 4), (4, 2)}


def test_probing_recall_and_share(spark):
    """At least 0.9 of the exact neighbours; the share of pairs met is the one the README gives."""
    from quarry.plans import neighbours as PN
    from quarry.sources.fixtures import labelled_vectors
    from tests.conftest import SF01

    df = labelled_vectors(spark, SF01)
    n = df.count()
    filed = K.signatures(df, PN.LSH_BITS, PN.LSH_TABLES, 42).select("id", "tab", "bucket").toPandas()
    asked = K.probed(df, PN.LSH_BITS, PN.LSH_TABLES, PN.LSH_PROBES, 42).select("id", "tab", "bucket").toPandas()
    assert len(asked) == len(asked.drop_duplicates()) == n * PN.LSH_PROBES
    met = asked.merge(filed, on=["tab", "bucket"]).query("id_x != id_y")[["id_x", "id_y"]].drop_duplicates()
    assert 0.5 < len(met) / (n * (n - 1)) < 0.7
    approx = {(r["id"], r["neighbour"]) for r in PN.q_lsh(spark, SF01).collect()}
    exact = {(r["id"], r["neighbour"]) for r in PN.q_knn(spark, SF01).collect()}
    assert len(approx) == len(exact) == n * PN.K_NEIGHBOURS
    assert len(approx & exact) / len(exact) >= 0.9


def _one_block(vecs, metric, k):
    """``vecs`` as both sides of one block pair, all in one cell; result and peak of traced memory in MB."""
    import tracemalloc

    import pandas as pd

    ids = np.arange(len(vecs))
    cells = K.Cells(K._spread(vecs[:1], metric), metric, k + 1)
    near = cells.to_pivots(K._spread(vecs, metric))[:, 0]
    cells.low[:], cells.high[:] = near.min(), near.max()
    qp = pd.DataFrame({"qid": ids, "qv": list(vecs), "fold": 0, "cell": 0, "near": near, "bound": np.inf})
    rp = pd.DataFrame({"rid": ids, "rv": list(vecs), "fold": 0, "cell": 0})
    tracemalloc.start()
    got = K._block_topk(qp, rp, k, cells, True, False)
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return got, peak


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "chebyshev", "cosine"])
def test_block_memory_is_bounded(metric):
    """Neither many candidates nor groups of equal vectors are held at once."""
    rng = np.random.default_rng(3)
    loose = rng.standard_normal((3000, 32))
    got, peak = _one_block(loose, metric, 9)
    assert peak < 130 and len(got) == 9 * 3000
    equal = np.repeat(rng.standard_normal((2, 32)), 1500, axis=0)
    got, peak = _one_block(equal, metric, 3)
    assert peak < 170
    first = got.groupby("id")["neighbour"].apply(list)
    assert first[0] == [1, 2, 3] and first[2] == [0, 1, 3] and first[2999] == [1500, 1501, 1502]


@pytest.mark.parametrize("metric", ["manhattan", "chebyshev"])
@pytest.mark.parametrize("scale,offset", [(1.0, 0.0), (1.0, 1e8), (1e35, 0.0), (1e-42, 0.0)])
def test_block_by_component_equals_brute_force(metric, scale, offset):
    """Single precision only sorts out: small gaps beside large values, and values beyond its range, lose no neighbour."""
    rng = np.random.default_rng(5)
    vecs = (rng.standard_normal((400, 40)) + 4 * rng.integers(0, 4, (400, 1))) * scale + offset
    gaps = np.abs(vecs[:, None] - vecs[None])
    d = np.round(gaps.sum(axis=2) if metric == "manhattan" else gaps.max(axis=2), K.TIE_DIGITS)
    got, _ = _one_block(vecs, metric, 4)
    want = [(i, j) for i in range(400) for j in sorted(set(range(400)) - {i}, key=lambda j: (d[i, j], j))[:4]]
    assert list(zip(got["id"], got["neighbour"])) == want


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "cosine"])
def test_ties_take_little_memory(metric):
    """Candidates are ranked as soon as some have come up, with the same neighbours."""
    vecs = np.repeat(np.random.default_rng(3).standard_normal((2, 32)), 1500, axis=0)
    got, peak = _one_block(vecs, metric, 3)
    assert peak < 110
    first = got.groupby("id")["neighbour"].apply(list)
    assert first[1] == [0, 2, 3] and first[1500] == [1501, 1502, 1503]


def _plain_approx(spark, df, vecs, k, bits, tables, probes):
    """Rank by distance, then id, all that was filed where a vector looks; ids are places in ``vecs``."""
    filed = K.signatures(df, bits, tables, 42).select("id", "tab", "bucket").toPandas()
    asked = K.probed(df, bits, tables, probes, 42).select("id", "tab", "bucket").toPandas()
    met = asked.merge(filed, on=["tab", "bucket"]).query("id_x != id_y").groupby("id_x")["id_y"].agg(set)
    out = {}
    for i, others in met.items():
        d = {j: round(float(np.sqrt(((vecs[i] - vecs[j]) ** 2).sum())), 9) for j in others}
        out |= {(i, r): j for r, j in enumerate(sorted(others, key=lambda j: (d[j], j))[:k], 1)}
    return out


@pytest.mark.parametrize("scale,offset,copies", [(1.0, 0.0, 1), (1e30, 0.0, 1), (1e-30, 0.0, 1), (1.0, 50.0, 1), (1.0, 0.0, 40)])
def test_blocks_meet_what_buckets_hold(spark, monkeypatch, scale, offset, copies):
    """the neighbours are those of the buckets, at any scale, offset and number of equal vectors."""
    monkeypatch.setattr(K, "MEET_ROWS", 90)
    monkeypatch.setattr(K, "MEET_FIRST", 16)
    monkeypatch.setattr(K, "PIECE", 32)
    rng = np.random.default_rng(11)
    vecs = np.repeat(rng.standard_normal((240 // copies, 12)) + 3 * rng.integers(0, 2, (240 // copies, 1)), copies, axis=0) * scale + offset
    df = vectors(spark, vecs)
    got = {(r["id"], r["rank"]): r["neighbour"] for r in K._by_blocks(df, 4, 4, 5, 42, 9).collect()}
    assert got == _plain_approx(spark, df, vecs, 4, 4, 5, 9)


def test_approx_keeps_a_row_a_vector(spark, monkeypatch):
    """no row for every bucket that a vector is filed under or looks in is written or dealt."""
    kept = []

    def keep(df, cut=K.cut_lineage):
        kept.append(cut(df))
        return kept[-1]

    monkeypatch.setattr(K, "cut_lineage", keep)
    df = vectors(spark, np.random.default_rng(2).standard_normal((300, 8)))
    assert K.knn_approx(df, 3).count() == 900
    assert max(x.count() for x in kept if "v" in x.columns) == 300


def test_approx_with_repeated_ids_and_gaps(spark):
    """A repeated id takes several places of a bucket's k, as it does bucket by bucket; vectors with gaps take no part."""
    vecs = np.random.default_rng(4).standard_normal((200, 6))
    df = vectors(spark, vecs)
    twice = df.union(df.where("id % 40 = 0")).union(spark.createDataFrame([(777, [float("nan")] * 6, 1), (778, None, 1)], df.schema))
    got = {(r["id"], r["rank"]): r["neighbour"] for r in K.knn_approx(twice, 4).collect()}
    plain = K._by_bucket(K.complete(twice), K.complete(twice), 4, 6, 12, 42, 2048, 60)
    assert got == {(r["id"], r["rank"]): r["neighbour"] for r in plain.collect()} and len(got) == 800
    # many signs and few probes: the buckets are small, and are worked on one by one
    sparse = {(r["id"], r["rank"]): r["neighbour"] for r in K.knn_approx(df, 1, bits=10, tables=3, probes=4).collect()}
    assert len(sparse) == 200


def _nearest(vecs, metric, k):
    far = lambda v: (np.abs(v - vecs).sum(axis=1) if metric == "manhattan" else np.abs(v - vecs).max(axis=1))
    d = [np.round(far(v), K.TIE_DIGITS) for v in vecs]
    return [(i, int(j)) for i in range(len(vecs)) for j in [j for j in np.lexsort((np.arange(len(vecs)), d[i])) if j != i][:k]]


@pytest.mark.parametrize("metric", ["manhattan", "chebyshev"])
def test_few_pairs_are_compared_component_by_component(metric, monkeypatch):
    """vectors without structure are sifted by steps of their components, and few pairs need their gaps."""
    vecs = np.random.default_rng(11).standard_normal((2500, 48))
    pairs, plain, paired = 0, K._by_component, K._paired

    def counted(a, b, *rest):
        nonlocal pairs
        pairs += len(a) * len(b)
        return plain(a, b, *rest)

    def counted_pairs(q, *rest):
        nonlocal pairs
        pairs += len(q)
        return paired(q, *rest)

    monkeypatch.setattr(K, "_by_component", counted)
    monkeypatch.setattr(K, "_paired", counted_pairs)
    got, _ = _one_block(vecs, metric, 3)
    assert list(zip(got["id"], got["neighbour"])) == _nearest(vecs, metric, 3)
    assert pairs < 0.25 * 2500 ** 2


@pytest.mark.parametrize("metric", ["manhattan", "chebyshev"])
@pytest.mark.parametrize("kind", ["clusters", "constant", "outliers", "whole", "spreads", "long"])
def test_sifting_loses_no_pair(metric, kind):
    rng = np.random.default_rng(4)
    vecs = rng.standard_normal((600, 12 if kind != "long" else 1500))
    if kind == "clusters":
        vecs = 20 * vecs[rng.integers(0, 20, 600)] + 0.01 * vecs
    elif kind == "constant":
        vecs[:, ::2] = 3.0
    elif kind == "outliers":
        vecs[::50] *= 1e6
    elif kind == "whole":
        vecs = np.round(vecs * 2)
    elif kind == "spreads":
        vecs *= 10.0 ** np.arange(-8, 4)
    q, r = vecs[:400], vecs[200:]
    gaps = np.abs(q[:, None] - r[None])
    d = gaps.sum(axis=2) if metric == "manhattan" else gaps.max(axis=2)
    for nth in (0, 5, 40, 399):
        reach = np.sort(d, axis=1)[:, nth] * (1 + 1e-9)
        sift = K._sift(r - r[0], metric)
        i, j, crowded = sift(q - r[0], reach)
        assert set(zip(*np.nonzero(d <= reach[:, None]))) <= set(zip(i, j)) | {(x, y) for x in crowded for y in range(len(r))}
        f, g, dist, off = K._finder(r, metric, r[0], len(q))(q, reach)
        assert (np.diff(f) >= 0).all() and (np.abs(dist - d[f, g]) <= off + 1e-9 * d[f, g]).all()
        assert set(zip(*np.nonzero(d <= reach[:, None]))) <= set(zip(f, g))
