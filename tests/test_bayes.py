import math

import pytest
from pyspark.sql import functions as F

from quarry.operators import bayes as NB


@pytest.fixture
def fitted(spark):
    docs = spark.createDataFrame([(1, "good good", 1), (2, "bad", 0)], "id long, text string, y int")
    tok = NB.tokens(docs)
    voc = NB.vocab(tok)
    counts = NB.class_counts(tok, voc, [0, 1])
    priors = NB.class_priors(docs, [0, 1])
    return docs, tok, counts, priors


def test_hand_worked_probabilities(fitted):
    _, tok, counts, priors = fitted
    bern = {(r["y"], r["w"]): r for r in NB.fit_bernoulli(counts, priors).collect()}
    assert math.exp(bern[(1, "good")]["log_p"]) == pytest.approx(2 / 3)
    assert math.exp(bern[(0, "good")]["log_p"]) == pytest.approx(1 / 3)
    multi = {(r["y"], r["w"]): r["log_p"] for r in NB.fit_multinomial(counts).collect()}
    assert math.exp(multi[(1, "good")]) == pytest.approx(3 / 4)
    # exp(theta) sums to one per class
    for c in (0, 1):
        assert sum(math.exp(v) for (y, _), v in multi.items() if y == c) == pytest.approx(1.0)
    assert {r["w"]: r["tf"] for r in tok.collect()} == {"good": 2, "bad": 1}


def test_zero_counts_kept(fitted):
    _, _, counts, _ = fitted
    c = {(r["y"], r["w"]): (r["n_docs"], r["n_occ"]) for r in counts.collect()}
    assert c[(0, "good")] == (0, 0) and c[(1, "bad")] == (0, 0)


def test_unseen_words_ignored_and_prediction(spark, fitted):
    _, _, counts, priors = fitted
    model = NB.fit_bernoulli(counts, priors)
    new = spark.createDataFrame([(10, "good zebra", 0), (11, "zebra", 0)], "id long, text string, y int")
    s = NB.score(NB.tokens(new), model, priors, [0, 1])
    p = {r["id"]: r["predicted"] for r in NB.predict(s).collect()}
    assert p[10] == 1
    assert p[11] == 0  # no known word: equal priors, symmetric model -> tie to the lower label


def test_matches_spark_ml(spark):
    """N4 equals pyspark.ml NaiveBayes (Bernoulli, smoothing 1) on the same vocabulary."""
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import CountVectorizer

    from quarry.functions.text import words
    from quarry.sources.fixtures import labelled_text
    from tests.conftest import SF001

    docs = labelled_text(spark, SF001)
    tok = NB.tokens(docs)
    voc = NB.vocab(tok, 2)
    classes = NB.classes_of(docs)
    model = NB.fit_bernoulli(NB.class_counts(tok, voc, classes), NB.class_priors(docs, classes))
    prep = docs.select(F.col("y").cast("double").alias("label"), words("text").alias("words"))
    cvm = CountVectorizer(inputCol="words", outputCol="features", minDF=2.0, binary=True,
                          vocabSize=1 << 20).fit(prep)
    ml = NaiveBayes(modelType="bernoulli", smoothing=1.0).fit(cvm.transform(prep))
    theta = ml.theta.toArray()
    w = cvm.vocabulary[0]
    ours = {r["y"]: r["log_p"] for r in model.where(F.col("w") == w).collect()}
    for i, c in enumerate(sorted(ours)):
        assert ours[c] == pytest.approx(theta[i][0], abs=1e-12)


def test_social_tokens(spark):
    df = spark.createDataFrame([(1, "Love it @Ana #Spark see https://x.io/a?b=1 www.y.org ok", 1)],
                               "id long, text string, y int")
    got = {r["w"] for r in NB.tokens(df, social=True).collect()}
    assert got == {"love", "it", "@ana", "#spark", "see", "ok"}
    plain = {r["w"] for r in NB.tokens(df).collect()}
    assert {"ana", "spark", "https", "x", "io"} <= plain


def test_one_class_training(spark):
    docs = spark.createDataFrame([(1, "a b", 1), (2, "b c", 1)], "id long, text string, y int")
    tok = NB.tokens(docs)
    classes = NB.classes_of(docs)
    assert docs.select(classes).first()[0] == [1]
    pri = NB.class_priors(docs, classes)
    model = NB.fit_bernoulli(NB.class_counts(tok, NB.vocab(tok), classes), pri)
    p = NB.predict(NB.score(tok, model, pri, classes)).collect()
    assert {r["predicted"] for r in p} == {1}


def test_ml_path_agrees_with_exact_operator(spark):
    """N9 (CountVectorizer + NaiveBayes) predicts what N4/N6/N7 predict."""
    from quarry.plans import bayes as PB
    from tests.conftest import SF01

    exact = {r["id"]: r["predicted"] for r in PB.q_predict(spark, SF01).collect()}
    ml = {r["id"]: r["predicted"] for r in PB.q_ml(spark, SF01).collect()}
    assert exact.keys() == ml.keys()
    agree = sum(exact[i] == ml[i] for i in exact) / len(exact)
    assert agree == 1.0


def test_many_labels(spark):
    """Labels are not capped and never collected."""
    df = spark.range(1500).select("id", F.col("id").alias("y"), F.concat(F.lit("w"), F.col("id") % 3).alias("text"))
    counts = NB.class_counts(NB.tokens(df), None, NB.classes_of(df), 1)
    assert counts.count() == 1500  # one word, "w"
    assert counts.agg(F.sum("n_docs")).first()[0] == 1500


def test_document_without_words_gets_its_base_scores(spark):
    docs = spark.createDataFrame([(1, "good day", 1), (2, "bad day", 0), (3, "12345 !!", 1)], "id long, text string, y int")
    tok, classes = NB.tokens(docs), NB.classes_of(docs)
    priors = NB.class_priors(docs, classes)
    model = NB.fit_bernoulli(NB.class_counts(tok, None, classes), priors)
    got = NB.score(tok, model, priors, classes, "bernoulli", docs).groupBy("id").count().collect()
    assert {r["id"]: r["count"] for r in got} == {1: 2, 2: 2, 3: 2}
