"""Naive Bayes text classification (N1-N9), as joins and aggregates.

The model is a table (y, w, log_p, log_q) plus per-class constants, so
fitting is two aggregations and scoring is one equi-join of document
tokens with the model followed by a sum per (document, class).  Class
labels are an array that a scalar subquery gives; exploding it per word or
document keeps zero counts without a cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.functions.text import words
from quarry.session import cut_lineage


def tokens(df: DataFrame, id_col: str = "id", y_col: str = "y", text_col: str = "text",
           social: bool = False) -> DataFrame:
    """(id, y, w, tf) — lower-cased letter runs of the whole text.

    ``social=True`` (short posts) removes URLs and keeps @name / #tag tokens.
    """
    ex = df.select(F.col(id_col).alias("id"), F.col(y_col).alias("y"),
                   F.explode(words(text_col, social)).alias("w"))
    return ex.groupBy("id", "y", "w").agg(F.count("*").alias("tf"))


def vocab(tok: DataFrame, min_df: int = 1) -> DataFrame:
    """Words in at least ``min_df`` documents, with their document count."""
    v = tok.groupBy("w").agg(F.count("*").alias("df"))
    return v.where(F.col("df") >= min_df) if min_df > 1 else v


def classes_of(df: DataFrame, y_col: str = "y") -> Column:
    """The distinct labels as one sorted array, a scalar subquery: they never
    reach the driver, and any number of them will do."""
    return df.select(F.array_sort(F.collect_set(y_col))).scalar()


def _array(classes) -> Column:
    return classes if isinstance(classes, Column) else F.array(*[F.lit(c) for c in classes])


def class_counts(tok: DataFrame, voc: DataFrame | None, classes, min_df: int = 1) -> DataFrame:
    """(y, w, n_docs, n_occ) for every vocabulary word and class, zeros kept.

    Counts by (w, y), joined to a scaffold of every vocabulary word and label.
    With ``voc=None`` the vocabulary is the words in at least ``min_df``
    documents, decided from the same counts; a given ``voc`` keeps its words
    even where they never occur.
    """
    seen = cut_lineage(tok.groupBy("w", "y").agg(F.count("tf").alias("d"), F.sum("tf").alias("o")))
    if voc is None:
        voc = seen.groupBy("w").agg(F.sum("d").alias("df")).where(F.col("df") >= min_df)
    grid = voc.select("w", F.explode(_array(classes)).alias("y"))
    return grid.join(seen, ["w", "y"], "left").select(
        "w", "y", F.coalesce("d", F.lit(0)).cast("bigint").alias("n_docs"),
        F.coalesce("o", F.lit(0)).cast("bigint").alias("n_occ"))


def class_priors(docs: DataFrame, classes, smoothing: float = 1.0) -> DataFrame:
    """(y, n_class, log_prior): ln((n_c + λ) / (N + λ·C)), as Spark ML smooths it."""
    n = docs.select(F.count("*")).scalar()
    return (docs.groupBy("y").agg(F.count("*").alias("n_class"))
            .select("y", "n_class",
                    F.log((F.col("n_class") + smoothing) / (n + smoothing * F.size(_array(classes)))).alias("log_prior")))


def fit_bernoulli(counts: DataFrame, priors: DataFrame, smoothing: float = 1.0) -> DataFrame:
    """(y, w, log_p, log_q): p = (docs with w + λ)/(n_c + 2λ), q = 1 - p."""
    j = counts.join(priors.select("y", "n_class"), "y")
    den = F.col("n_class") + 2 * smoothing
    return j.select("y", "w",
                    F.log((F.col("n_docs") + smoothing) / den).alias("log_p"),
                    F.log((F.col("n_class") - F.col("n_docs") + smoothing) / den).alias("log_q"))


def fit_multinomial(counts: DataFrame, smoothing: float = 1.0) -> DataFrame:
    """(y, w, log_p): ln((occurrences + λ) / (Σ occurrences_c + λ·V))."""
    tot = counts.groupBy("y").agg(F.sum("n_occ").alias("occ_c"), F.count("*").alias("v"))
    j = counts.join(tot, "y")
    return j.select("y", "w", F.log((F.col("n_occ") + smoothing) /
                                    (F.col("occ_c") + smoothing * F.col("v"))).alias("log_p"))


def score(doc_tokens: DataFrame, model: DataFrame, priors: DataFrame, classes,
          kind: str = "bernoulli", docs: DataFrame | None = None) -> DataFrame:
    """(id, y, score) for every document and class.

    ``docs`` (id) names the documents, so that one without any token gets its
    classes' base scores; by default only documents with tokens are known.
    The model is materialised: with both sides of the word join on plain
    exchanges, Spark can split a word that a third of the tokens share.

    Bernoulli: prior + Σ_vocab log_q + Σ_{w in doc} (log_p - log_q); the first
    two terms are one constant per class, so absent words need no rows.
    Multinomial: prior + Σ_{w in doc} tf · log_p.  Words outside the model
    are ignored by the inner join.
    """
    model = cut_lineage(model)
    if kind == "bernoulli":
        const = (model.groupBy("y").agg(F.sum("log_q").alias("sum_q"))
                 .join(priors, "y").select("y", (F.col("log_prior") + F.col("sum_q")).alias("base")))
        contrib = (doc_tokens.select("id", "w").join(model, "w")
                   .groupBy("id", "y").agg(F.sum(F.col("log_p") - F.col("log_q")).alias("part")))
    else:
        const = priors.select("y", F.col("log_prior").alias("base"))
        contrib = (doc_tokens.select("id", "w", "tf").join(model, "w")
                   .groupBy("id", "y").agg(F.sum(F.col("tf") * F.col("log_p")).alias("part")))
    ids = (docs if docs is not None else doc_tokens).select("id").distinct()
    grid = ids.select("id", F.explode(_array(classes)).alias("y"))
    return (grid.join(const, "y")
            .join(contrib, ["id", "y"], "left")
            .select("id", "y", (F.col("base") + F.coalesce(F.col("part"), F.lit(0.0))).alias("score")))


def predict(scores: DataFrame) -> DataFrame:
    """Argmax class per document; ties go to the lower label."""
    w = Window.partitionBy("id").orderBy(F.col("score").desc(), F.col("y").asc())
    return (scores.withColumn("rn", F.row_number().over(w)).where("rn = 1")
            .select("id", F.col("y").alias("predicted"), "score"))


def top_words(model: DataFrame, k: int, pos=1, neg=0) -> DataFrame:
    """Words with the largest log-odds log_p(pos) - log_p(neg); ties by word."""
    a = model.where(F.col("y") == pos).select("w", F.col("log_p").alias("lp_pos"))
    b = model.where(F.col("y") == neg).select("w", F.col("log_p").alias("lp_neg"))
    return (a.join(b, "w").select("w", (F.col("lp_pos") - F.col("lp_neg")).alias("log_odds"))
            .orderBy(F.col("log_odds").desc(), "w").limit(k))


def fit_ml(train: DataFrame, test: DataFrame, min_df: int = 2, kind: str = "bernoulli") -> DataFrame:
    """Spark ML path — CountVectorizer (binary for Bernoulli) + NaiveBayes.

    Returns (id, actual, predicted) for ``test``.  Every word enters; Spark
    ML itself holds the vocabulary and a class × word matrix on the driver,
    so N4-N7 are the path for vocabularies beyond its memory.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import CountVectorizer

    def prep(df):
        return df.select("id", F.col("y").cast("double").alias("label"), words("text").alias("words"))

    cv = CountVectorizer(inputCol="words", outputCol="features", minDF=float(min_df),
                         binary=(kind == "bernoulli"), vocabSize=(1 << 31) - 1)
    nb = NaiveBayes(featuresCol="features", labelCol="label", smoothing=1.0, modelType=kind)
    model = Pipeline(stages=[cv, nb]).fit(prep(train))
    pred = model.transform(prep(test))
    return pred.select("id", F.col("label").cast("int").alias("actual"),
                       F.col("prediction").cast("int").alias("predicted"))
