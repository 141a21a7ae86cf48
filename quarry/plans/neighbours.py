"""Distance and k-NN plans over ``embeddings`` (64-d unit vectors, 10 labels)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import neighbours as K
from quarry.session import cut_lineage
from quarry.sources.fixtures import labelled_vectors

K_NEIGHBOURS = 5
KS = [1, 3, 5, 7, 9]
FOLDS = 5
# LSH: vectors are filed in 12 tables of 6 signs and look in the 60 buckets
# nearest to them; on these vectors without structure that compares about 63 %
# of all pairs for a recall of at least 0.9 (own buckets alone: 18 %, half)
LSH_BITS = 6
LSH_TABLES = 12
LSH_PROBES = 60


def _vec(spark, sf_dir):
    return labelled_vectors(spark, sf_dir)


def q_euclidean(spark, sf_dir):
    d = K.distance_to_centroid(_vec(spark, sf_dir), ("euclidean",))
    return d.select("id", "label", F.round("euclidean", 6).alias("euclidean"))


def q_metrics(spark, sf_dir):
    ms = ("euclidean", "manhattan", "chebyshev", "cosine")
    d = K.distance_to_centroid(_vec(spark, sf_dir), ms)
    return d.select("id", "label", *[F.round(m, 6).alias(m) for m in ms])


def q_scale(spark, sf_dir):
    df = _vec(spark, sf_dir)
    df = K.scale(K.scale(df, "v", "minmax", "mm"), "v", "standard", "zs")
    ex = df.select("id", F.posexplode(F.arrays_zip("mm", "zs")).alias("dim", "s"))
    return ex.select("id", "dim", F.round("s.mm", 6).alias("minmax"), F.round("s.zs", 6).alias("zscore"))


def neighbours(spark, sf_dir, k=K_NEIGHBOURS):
    df = cut_lineage(_vec(spark, sf_dir))  # read by counts, both sides and labels
    return df, K.knn(df, df, k, exclude_self=True)


def q_knn(spark, sf_dir):
    _, n = neighbours(spark, sf_dir)
    return n.select("id", "neighbour", "rank", F.round("distance", 6).alias("distance"), "neighbour_label")


def q_classify(spark, sf_dir):
    df, n = neighbours(spark, sf_dir)
    return K.classify(n, df)


def q_k_sweep(spark, sf_dir):
    df, n = neighbours(spark, sf_dir, max(KS))
    return K.k_sweep(n, df, KS)


def q_folds(spark, sf_dir):
    return K.cross_val(cut_lineage(_vec(spark, sf_dir)), K_NEIGHBOURS, FOLDS)


def q_lsh(spark, sf_dir):
    """Approximate neighbours; tests measure their recall against the exact ones."""
    approx = K.knn_approx(_vec(spark, sf_dir), K_NEIGHBOURS, LSH_BITS, LSH_TABLES, probes=LSH_PROBES)
    return approx.select("id", "neighbour", "rank", F.round("distance", 6).alias("distance"))


def q_pairs(spark, sf_dir):
    """K1/K2 over a given pair list: each vector and the one with the next id."""
    e = _vec(spark, sf_dir)
    a = e.select("id", F.col("v").alias("a"))
    b = e.select((F.col("id") - 1).alias("id"), F.col("v").alias("b"))
    d = K.distance(a.join(b, "id"))
    return d.select("id", *[F.round(m, 6).alias(m) for m in K.METRICS])


def _by_metric(metric):
    def q(spark, sf_dir):
        df = cut_lineage(_vec(spark, sf_dir))
        n = K.knn(df, df, K_NEIGHBOURS, metric=metric)
        return n.select("id", "neighbour", "rank", F.round("distance", 6).alias("distance"), "neighbour_label")
    return q


QUERIES = {
    "dist_euclidean": q_euclidean,
    "dist_metrics": q_metrics,
    "dist_pairs": q_pairs,
    "vec_scale": q_scale,
    "knn": q_knn,
    "knn_classify": q_classify,
    "knn_k_sweep": q_k_sweep,
    "knn_folds": q_folds,
    "knn_lsh": q_lsh,
    "knn_manhattan": _by_metric("manhattan"),
    "knn_chebyshev": _by_metric("chebyshev"),
    "knn_cosine": _by_metric("cosine"),
}

_E = "e AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)"
_X = "x AS (SELECT id, label, unnest(range(0, len(v))) AS i, unnest(v) AS x FROM e)"
_CENT = f"{_E}, {_X}, cent AS (SELECT label, i, avg(x) AS m FROM x GROUP BY label, i)"
_DIST = f"""{_CENT} SELECT x.id, x.label, round(sqrt(sum((x - m) * (x - m))), 6) AS euclidean,
  round(sum(abs(x - m)), 6) AS manhattan, round(max(abs(x - m)), 6) AS chebyshev,
  round(1 - sum(x * m) / (sqrt(sum(x * x)) * sqrt(sum(m * m))), 6) AS cosine
  FROM x JOIN cent USING (label, i) GROUP BY x.id, x.label"""


_GAPS = "[abs(g[1] - g[2]) for g in list_zip(a.v, b.v)]"
_METRIC = {"euclidean": "list_distance(a.v, b.v)", "manhattan": f"list_sum({_GAPS})",
           "chebyshev": f"list_max({_GAPS})", "cosine": "1 - list_cosine_similarity(a.v, b.v)"}


def _nn(k, fold_filter="", metric="euclidean"):
    return f"""{_E}, p AS (SELECT a.id, b.id AS neighbour, {_METRIC[metric]} AS distance,
    b.label AS neighbour_label FROM e a JOIN e b ON a.id <> b.id {fold_filter}),
  nn AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY id
         ORDER BY round(distance, 9), neighbour) AS INTEGER) AS rank FROM p) WHERE rank <= {k})"""


_VOTE = """votes AS (SELECT id, neighbour_label, count(*) AS votes FROM nn GROUP BY 1, 2),
  pred AS (SELECT id, neighbour_label AS predicted FROM (SELECT *, row_number() OVER
           (PARTITION BY id ORDER BY votes DESC, neighbour_label) AS rn FROM votes) WHERE rn = 1),
  pa AS (SELECT pred.id, e.label AS actual, predicted FROM pred JOIN e USING (id))"""

ORACLE = {
    "dist_euclidean": f"WITH {_DIST.replace(' SELECT x.id', ' , d AS (SELECT x.id', 1)}) SELECT id, label, euclidean FROM d",
    "dist_metrics": f"WITH {_DIST}",
    "vec_scale": f"""WITH {_E}, {_X}, st AS (SELECT i, min(x) AS lo, max(x) AS hi, avg(x) AS mu,
    stddev_samp(x) AS sd FROM x GROUP BY i)
  SELECT id, CAST(i AS INTEGER) AS dim,
    round(CASE WHEN hi = lo THEN 0.0 ELSE (x - lo) / (hi - lo) END, 6) AS minmax,
    round(CASE WHEN coalesce(sd, 0) = 0 THEN 0.0 ELSE (x - mu) / sd END, 6) AS zscore
  FROM x JOIN st USING (i)""",
    "knn": f"""WITH {_nn(K_NEIGHBOURS)} SELECT id, neighbour, rank, round(distance, 6) AS distance,
  neighbour_label FROM nn""",
    "dist_pairs": f"""WITH {_E} SELECT a.id, {', '.join(f"round({sql}, 6) AS {m}" for m, sql in _METRIC.items())}
  FROM e a JOIN e b ON b.id = a.id + 1""",
    **{f"knn_{m}": f"""WITH {_nn(K_NEIGHBOURS, metric=m)} SELECT id, neighbour, rank,
  round(distance, 6) AS distance, neighbour_label FROM nn""" for m in ("manhattan", "chebyshev", "cosine")},
    "knn_classify": f"WITH {_nn(K_NEIGHBOURS)}, {_VOTE} SELECT * FROM pa",
    "knn_k_sweep": f"""WITH {_nn(max(KS))}, ks AS (SELECT unnest({KS}) AS k),
  votes AS (SELECT k, id, neighbour_label, count(*) AS votes FROM nn JOIN ks ON rank <= k GROUP BY 1, 2, 3),
  pred AS (SELECT k, id, neighbour_label AS predicted FROM (SELECT *, row_number() OVER
           (PARTITION BY k, id ORDER BY votes DESC, neighbour_label) AS rn FROM votes) WHERE rn = 1)
  SELECT CAST(k AS INTEGER) AS k, count(*) AS n, CAST(sum(CASE WHEN label = predicted THEN 1 ELSE 0 END) AS BIGINT) AS correct,
         sum(CASE WHEN label = predicted THEN 1 ELSE 0 END) / count(*) AS accuracy
  FROM pred JOIN e USING (id) GROUP BY k""",
    "knn_folds": f"""WITH {_nn(K_NEIGHBOURS, f"AND a.id % {FOLDS} <> b.id % {FOLDS}")}, {_VOTE}
  SELECT id % {FOLDS} AS fold, count(*) AS n,
         CAST(sum(CASE WHEN actual = predicted THEN 1 ELSE 0 END) AS BIGINT) AS correct,
         sum(CASE WHEN actual = predicted THEN 1 ELSE 0 END) / count(*) AS accuracy
  FROM pa GROUP BY 1""",
}
