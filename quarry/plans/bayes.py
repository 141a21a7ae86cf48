"""Naive Bayes plans on labels ⋈ documents, y = toxic.

Train = documents with id mod 5 != 0, test = id mod 5 == 0 (V1).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import bayes as NB
from quarry.operators import bayes_em as EM
from quarry.functions.text import words
from quarry.operators import evaluate as V
from quarry.session import cut_lineage
from quarry.sources.fixtures import labelled_text, partly_labelled_text

MIN_DF = 2
TOP_K = 20
FOLDS = 5
EM_ROUNDS = 2


def _split(spark, sf_dir):
    return V.split(labelled_text(spark, sf_dir), "id", FOLDS)


def _tokens(spark, sf_dir, social=False):
    """All labelled documents tokenised in one regex pass: (id, y, words
    with counts), materialised once.  A document without words keeps its row."""
    txt = labelled_text(spark, sf_dir).select("id", "y", words("text", social).alias("words"))
    return cut_lineage(txt)


def _counted(docs):
    """(id, y, w, tf) of a materialised word table."""
    return (docs.select("id", "y", F.explode("words").alias("w"))
            .groupBy("id", "y", "w").agg(F.count("*").alias("tf")))


def _fitted(spark, sf_dir):
    train, test = V.split(_tokens(spark, sf_dir), "id", FOLDS)
    tok, tok_test = _counted(train), _counted(test)
    classes = NB.classes_of(train)
    counts = cut_lineage(NB.class_counts(tok, None, classes, MIN_DF))
    priors = NB.class_priors(train.select("id", "y"), classes)
    return train, test, classes, counts, priors, tok_test


def q_tokens(spark, sf_dir):
    return NB.tokens(labelled_text(spark, sf_dir))


def q_tokens_social(spark, sf_dir):
    """N1 for short posts: URLs removed, @names and #tags kept."""
    return NB.tokens(labelled_text(spark, sf_dir), social=True)


def q_vocab(spark, sf_dir):
    train, _ = V.split(_tokens(spark, sf_dir), "id", FOLDS)
    return NB.vocab(_counted(train), MIN_DF)


def q_class_counts(spark, sf_dir):
    return _fitted(spark, sf_dir)[3]


def q_fit_bernoulli(spark, sf_dir):
    _, _, _, counts, priors, _ = _fitted(spark, sf_dir)
    m = NB.fit_bernoulli(counts, priors)
    return m.select("y", "w", F.round("log_p", 6).alias("log_p"), F.round("log_q", 6).alias("log_q"))


def q_fit_multinomial(spark, sf_dir):
    counts = _fitted(spark, sf_dir)[3]
    return NB.fit_multinomial(counts).select("y", "w", F.round("log_p", 6).alias("log_p"))


def bernoulli_scores(spark, sf_dir):
    _, test, classes, counts, priors, tok_test = _fitted(spark, sf_dir)
    model = NB.fit_bernoulli(counts, priors)
    return test, NB.score(tok_test, model, priors, classes, "bernoulli", test)


def q_scores(spark, sf_dir):
    _, s = bernoulli_scores(spark, sf_dir)
    return s.select("id", "y", F.round("score", 6).alias("score"))


def nb_predictions(spark, sf_dir):
    """(id, actual, predicted) for the test documents."""
    test, s = bernoulli_scores(spark, sf_dir)
    p = NB.predict(s)
    return p.join(test.select("id", F.col("y").alias("actual")), "id").select("id", "actual", "predicted")


def q_predict(spark, sf_dir):
    return nb_predictions(spark, sf_dir)


def q_top_words(spark, sf_dir):
    counts = _fitted(spark, sf_dir)[3]
    t = NB.top_words(NB.fit_multinomial(counts), TOP_K)
    return t.select("w", F.round("log_odds", 6).alias("log_odds"))


def q_em(spark, sf_dir):
    """Learns from all documents but the labelled ones of the test fold, and classifies those."""
    docs = cut_lineage(partly_labelled_text(spark, sf_dir).select("id", "y", words("text").alias("words")))
    is_test = F.coalesce(F.col("y").isNotNull() & (F.col("id") % FOLDS == 0), F.lit(False))
    train, test = docs.where(~is_test & F.col("id").isNotNull()), docs.where(is_test)
    model, priors, classes = EM.fit(train, _counted(train).drop("y"), MIN_DF, EM_ROUNDS)
    s = NB.score(_counted(test).drop("y"), model, priors, classes, "multinomial", test)
    return NB.predict(s).join(test.select("id", F.col("y").alias("actual")), "id").select(
        "id", "actual", "predicted", F.round("score", 3).alias("score"))


def q_ml(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    return NB.fit_ml(train, test, MIN_DF, "bernoulli")


QUERIES = {
    "nb_tokens": q_tokens,
    "nb_tokens_social": q_tokens_social,
    "nb_vocab": q_vocab,
    "nb_class_counts": q_class_counts,
    "nb_fit_bernoulli": q_fit_bernoulli,
    "nb_fit_multinomial": q_fit_multinomial,
    "nb_scores": q_scores,
    "nb_predict": q_predict,
    "nb_top_words": q_top_words,
    "nb_ml": q_ml,
    "nb_em": q_em,
}

TEXT = "txt AS (SELECT doc_id AS id, text, toxic AS y FROM labels JOIN documents USING (doc_id))"
TOK = ("tok AS (SELECT id, y, w, count(*) AS tf FROM (SELECT id, y, "
       "unnest(regexp_extract_all(lower(text), '(\\p{L}+)', 1)) AS w FROM txt) GROUP BY id, y, w)")
FIT = f"""{TEXT}, {TOK},
  trd AS (SELECT * FROM txt WHERE id % {FOLDS} <> 0),
  trt AS (SELECT * FROM tok WHERE id % {FOLDS} <> 0),
  tet AS (SELECT * FROM tok WHERE id % {FOLDS} = 0),
  voc AS (SELECT w, count(*) AS df FROM trt GROUP BY w HAVING count(*) >= {MIN_DF}),
  cls AS (SELECT DISTINCT y FROM trd),
  cc AS (SELECT c.y, v.w, count(t.id) AS n_docs, CAST(coalesce(sum(t.tf), 0) AS BIGINT) AS n_occ
         FROM voc v CROSS JOIN cls c LEFT JOIN trt t ON t.w = v.w AND t.y = c.y GROUP BY c.y, v.w),
  pri AS (SELECT y, count(*) AS n_class,
          ln((count(*) + 1.0) / ((SELECT count(*) FROM trd) + (SELECT count(*) FROM cls))) AS log_prior
          FROM trd GROUP BY y),
  bm AS (SELECT cc.y, w, ln((n_docs + 1.0) / (n_class + 2.0)) AS log_p,
         ln((n_class - n_docs + 1.0) / (n_class + 2.0)) AS log_q FROM cc JOIN pri USING (y)),
  mm AS (SELECT cc.y, w, ln((n_occ + 1.0) / (occ_c + v)) AS log_p FROM cc JOIN
         (SELECT y, sum(n_occ) AS occ_c, count(*) AS v FROM cc GROUP BY y) t USING (y)),
  base AS (SELECT pri.y, log_prior + sq AS base FROM pri JOIN
           (SELECT y, sum(log_q) AS sq FROM bm GROUP BY y) s USING (y)),
  part AS (SELECT id, bm.y, sum(log_p - log_q) AS part FROM tet JOIN bm USING (w) GROUP BY id, bm.y),
  sc AS (SELECT i.id, base.y, base + coalesce(part.part, 0) AS score
         FROM (SELECT DISTINCT id FROM txt WHERE id % {FOLDS} = 0) i CROSS JOIN base
         LEFT JOIN part ON part.id = i.id AND part.y = base.y),
  pred AS (SELECT id, y AS predicted, score FROM (SELECT *, row_number() OVER
           (PARTITION BY id ORDER BY score DESC, y) AS rn FROM sc) WHERE rn = 1),
  pa AS (SELECT pred.id, txt.y AS actual, predicted FROM pred JOIN txt USING (id))"""



def _em_sql():
    """The rounds written out."""
    parts = [f"""alltxt AS MATERIALIZED (SELECT doc_id AS id, text, toxic AS y FROM documents LEFT JOIN labels USING (doc_id)),
  atok AS MATERIALIZED (SELECT id, y, w, count(*) AS tf FROM (SELECT id, y, unnest(regexp_extract_all(lower(text), '(\\p{{L}}+)', 1)) AS w
          FROM alltxt) GROUP BY id, y, w),
  et AS MATERIALIZED (SELECT * FROM atok WHERE y IS NOT NULL AND id % {FOLDS} = 0),
  tr AS MATERIALIZED (SELECT * FROM atok WHERE y IS NULL OR id % {FOLDS} <> 0),
  ev AS MATERIALIZED (SELECT w FROM tr GROUP BY w HAVING count(*) >= {MIN_DF}),
  tv AS MATERIALIZED (SELECT tr.* FROM tr JOIN ev USING (w)),
  trd AS (SELECT id, y FROM alltxt WHERE y IS NOT NULL AND id % {FOLDS} <> 0),
  cl AS (SELECT DISTINCT y FROM trd)"""]
    for r in range(EM_ROUNDS + 1):
        more_w = f" UNION ALL SELECT w, p.y, tf * p AS n FROM tv JOIN post{r} p USING (id) WHERE tv.y IS NULL" if r else ""
        more_d = f" UNION ALL SELECT y, p AS n FROM post{r}" if r else ""
        parts.append(f"""held{r} AS (SELECT w, y, sum(n) AS n FROM (SELECT w, y, CAST(tf AS DOUBLE) AS n FROM tv WHERE y IS NOT NULL{more_w}) GROUP BY w, y),
  occ{r} AS MATERIALIZED (SELECT ev.w, cl.y, coalesce(h.n, 0.0) AS n FROM ev CROSS JOIN cl LEFT JOIN held{r} h ON h.w = ev.w AND h.y = cl.y),
  em{r} AS MATERIALIZED (SELECT w, y, ln((n + 1.0) / (sum(n) OVER (PARTITION BY y) + count(*) OVER (PARTITION BY y))) AS log_p FROM occ{r}),
  mass{r} AS (SELECT y, sum(n) AS n FROM (SELECT y, 1.0::DOUBLE AS n FROM trd{more_d}) GROUP BY y),
  pr{r} AS MATERIALIZED (SELECT y, ln((n + 1.0) / ((SELECT sum(n) FROM mass{r}) + (SELECT count(*) FROM cl))) AS log_prior FROM mass{r})""")
        rows, ids = ("tv", "SELECT id FROM alltxt WHERE y IS NULL") if r < EM_ROUNDS else (
            "et", f"SELECT id FROM alltxt WHERE y IS NOT NULL AND id % {FOLDS} = 0")
        parts.append(f"""es{r} AS MATERIALIZED (SELECT i.id, pr{r}.y, log_prior + coalesce(part, 0) AS score FROM ({ids}) i CROSS JOIN pr{r}
    LEFT JOIN (SELECT id, em{r}.y, sum(tf * log_p) AS part FROM {rows} JOIN em{r} USING (w) GROUP BY id, em{r}.y) q ON q.id = i.id AND q.y = pr{r}.y)""")
        if r < EM_ROUNDS:
            parts.append(f"""odd{r} AS (SELECT id, y, exp(score - max(score) OVER (PARTITION BY id)) AS o FROM es{r}),
  post{r + 1} AS MATERIALIZED (SELECT id, y, o / sum(o) OVER (PARTITION BY id) AS p FROM odd{r})""")
    return ("WITH " + ",\n  ".join(parts) + f""" SELECT b.id, a.y AS actual, b.y AS predicted, round(b.score, 3) AS score
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, y) AS rn FROM es{EM_ROUNDS}) b JOIN alltxt a ON a.id = b.id WHERE rn = 1""")


ORACLE = {
    "nb_em": _em_sql(),
    "nb_tokens": f"WITH {TEXT}, {TOK} SELECT * FROM tok",
    "nb_tokens_social": rf"""WITH {TEXT} SELECT id, y, w, count(*) AS tf FROM (SELECT id, y,
    unnest(regexp_extract_all(regexp_replace(lower(text), '(https?://|www\.)\S+', ' ', 'g'), '([@#]?\p{{L}}+)', 1)) AS w
    FROM txt) GROUP BY id, y, w""",
    "nb_vocab": f"WITH {FIT} SELECT * FROM voc",
    "nb_class_counts": f"WITH {FIT} SELECT y, w, n_docs, n_occ FROM cc",
    "nb_fit_bernoulli": f"WITH {FIT} SELECT y, w, round(log_p, 6) AS log_p, round(log_q, 6) AS log_q FROM bm",
    "nb_fit_multinomial": f"WITH {FIT} SELECT y, w, round(log_p, 6) AS log_p FROM mm",
    "nb_scores": f"WITH {FIT} SELECT id, y, round(score, 6) AS score FROM sc",
    "nb_predict": f"WITH {FIT} SELECT * FROM pa",
    "nb_ml": f"WITH {FIT} SELECT id, actual, predicted FROM pa",
    "nb_top_words": f"""WITH {FIT} SELECT a.w, round(a.log_p - b.log_p, 6) AS log_odds
  FROM mm a JOIN mm b ON a.w = b.w AND a.y = 1 AND b.y = 0
  ORDER BY a.log_p - b.log_p DESC, a.w LIMIT {TOP_K}""",
}
