"""Multinomial Naive Bayes that also learns from unlabelled documents.

Expectation maximisation: a model from the labelled documents gives each
unlabelled one a probability for each class; these count as fractions of a document,
``weight`` of a labelled one's, in the next round's model.  Labelled documents keep
their class.  A document's counted words stay together in one row: a round joins them
with the model, word by word, and with the posteriors, document by document.  The
posteriors, a row per document, are written as it ends, so no round runs twice.

The vocabulary is the words in at least ``min_df`` documents of both kinds.

Defined results: a null label means unlabelled; a row without an id is left out;
null or empty text, and one without a vocabulary word, counts towards the priors only;
without unlabelled documents the model is the plain one; without labelled ones there
is no class, and the model is empty; an id must name one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators import bayes as NB
from quarry.session import cut_lineage


def priors_of(mass: DataFrame, classes, smoothing: float = 1.0) -> DataFrame:
    """(y, n_class, log_prior) from (y, n), n a number of documents that may be a fraction."""
    total = mass.select(F.sum("n")).scalar()
    n = mass.groupBy("y").agg(F.sum("n").alias("n_class"))
    return n.select("y", "n_class", F.log((F.col("n_class") + smoothing) / (total + smoothing * F.size(NB._array(classes)))).alias("log_prior"))


def _exploded(bags: DataFrame, *cols: str) -> DataFrame:
    """``cols``, w and tf of (..., bag)."""
    return bags.select(*cols, F.explode("bag").alias("t")).select(*cols, "t.w", "t.tf")


def posteriors(ids: DataFrame, bags: DataFrame, model: DataFrame, priors: DataFrame) -> DataFrame:
    """(id, post array of (y, p)) of every distinct id in ``ids``; ``bags`` (id, bag) are the words of those that have any.

    Exponentials of the distances to a document's best class, over their sum.
    """
    parts = (_exploded(bags, "id").join(model, "w").groupBy("id", "y").agg(F.sum(F.col("tf") * F.col("log_p")).alias("part"))
             .groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("y", "part"))).alias("parts")))
    heads = priors.select(F.array_sort(F.collect_list(F.struct("y", "log_prior"))).alias("heads"))  # one row
    part = lambda y: F.coalesce(F.try_element_at("parts", y), F.lit(0.0))
    scored = ids.distinct().join(parts, "id", "left").crossJoin(F.broadcast(heads)).select(
        "id", F.transform("heads", lambda h: F.struct(h["y"].alias("y"), (h["log_prior"] + part(h["y"])).alias("score"))).alias("s"))
    best = scored.select("id", "s", F.array_max(F.transform("s", lambda x: x["score"])).alias("best"))
    odds = best.select("id", F.transform("s", lambda x: F.struct(x["y"].alias("y"), F.exp(x["score"] - F.col("best")).alias("odds"))).alias("o"))
    total = F.aggregate("o", F.lit(0.0), lambda acc, x: acc + x["odds"])
    return odds.select("id", "o", total.alias("all")).select(
        "id", F.transform("o", lambda x: F.struct(x["y"].alias("y"), (x["odds"] / F.col("all")).alias("p"))).alias("post"))


def fit(docs: DataFrame, tok: DataFrame, min_df: int = 1, rounds: int = 2, weight: float = 1.0, smoothing: float = 1.0):
    """(model (y, w, log_p), priors (y, n_class, log_prior), classes) from ``docs`` (id, y) and ``tok`` (id, w, tf).

    ``classes`` is a column for ``NB.score``.
    """
    docs = cut_lineage(docs.where(F.col("id").isNotNull()).select("id", "y"))
    known, unknown = docs.where(F.col("y").isNotNull()), docs.where(F.col("y").isNull()).select("id")
    classes = NB.classes_of(known)
    tok = cut_lineage(tok.select("id", "w", "tf"))
    voc = cut_lineage(NB.vocab(tok, min_df).select("w"))
    bags = tok.join(voc, "w").groupBy("id").agg(F.collect_list(F.struct("w", "tf")).alias("bag"))
    bags = cut_lineage(docs.join(bags, "id"))
    loose = bags.where(F.col("y").isNull()).select("id", "bag")
    sure = cut_lineage(_exploded(bags.where(F.col("y").isNotNull()), "y").groupBy("w", "y").agg(F.sum(F.col("tf").cast("double")).alias("n")))
    heads = known.groupBy("y").agg(F.count("*").cast("double").alias("n"))
    grid = voc.select("w", F.explode(classes).alias("y"))

    def model_of(words: DataFrame, mass: DataFrame):
        held = words.groupBy("w", "y").agg(F.sum("n").alias("n"))
        counts = grid.join(held, ["w", "y"], "left").select("w", "y", F.coalesce("n", F.lit(0.0)).alias("n_occ"))
        return cut_lineage(NB.fit_multinomial(cut_lineage(counts), smoothing)), cut_lineage(priors_of(mass, classes, smoothing))

    model, priors = model_of(sure, heads)
    for _ in range(rounds):
        post = cut_lineage(posteriors(unknown, loose, model, priors))
        shares = (_exploded(loose.join(post, "id"), "post").select("w", "tf", F.explode("post").alias("c"))
                  .groupBy("w", "c.y").agg(F.sum(F.col("tf") * F.col("c.p") * weight).alias("n")))
        mass = post.select(F.explode("post").alias("c")).select("c.y", (F.col("c.p") * weight).alias("n"))
        model, priors = model_of(sure.unionByName(shares), heads.unionByName(mass))
    return model, priors, classes
