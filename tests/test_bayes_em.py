"""Naive Bayes with unlabelled documents, against plain Python."""

import math
from collections import Counter

import pytest

from quarry.operators import bayes as NB
from quarry.operators import bayes_em as EM

DOCS = [(1, 0, "red red car"), (2, 1, "blue sky"), (3, 1, "blue bird sky"), (4, None, "red truck"), (5, None, "bird wing wing"),
        (6, None, ""), (7, None, "truck truck car red blue"), (8, 0, None), (None, 1, "red")]


def plain(docs, rounds, weight):
    bags = {i: Counter((t or "").split()) for i, _, t in docs}
    voc, classes = sorted({w for b in bags.values() for w in b}), sorted({y for _, y, _ in docs if y is not None})
    share = {i: {y: 1.0} for i, y, _ in docs if y is not None}
    for _ in range(rounds + 1):
        mass = {y: sum(s.get(y, 0) for s in share.values()) for y in classes}
        prior = {y: math.log((mass[y] + 1) / (sum(mass.values()) + len(classes))) for y in classes}
        occ = {y: {w: sum(s.get(y, 0) * bags[i][w] for i, s in share.items()) for w in voc} for y in classes}
        model = {(y, w): math.log((occ[y][w] + 1) / (sum(occ[y].values()) + len(voc))) for y in classes for w in voc}
        for i, y0, _ in docs:
            if y0 is None:
                score = {y: prior[y] + sum(n * model[y, w] for w, n in bags[i].items()) for y in classes}
                total = sum(math.exp(v) for v in score.values())
                share[i] = {y: weight * math.exp(v) / total for y, v in score.items()}
    return model, prior


@pytest.mark.parametrize("rounds, weight", [(0, 1.0), (3, 1.0), (2, 0.25)])
def test_rounds_equal_plain_python(spark, rounds, weight):
    df = spark.createDataFrame(DOCS, "id long, y int, text string")
    model, priors, _ = EM.fit(df, NB.tokens(df).drop("y"), 1, rounds, weight)
    expect_model, expect_prior = plain([d for d in DOCS if d[0] is not None], rounds, weight)
    got = {(r["y"], r["w"]): r["log_p"] for r in model.collect()}
    assert got.keys() == expect_model.keys()
    assert all(got[k] == pytest.approx(v, abs=1e-12) for k, v in expect_model.items())
    assert {r["y"]: r["log_prior"] for r in priors.collect()} == pytest.approx(expect_prior, abs=1e-12)


def test_without_unlabelled_or_labelled_documents(spark):
    df = spark.createDataFrame([d for d in DOCS[:3]], "id long, y int, text string")
    tok = NB.tokens(df)
    model, priors, classes = EM.fit(df, tok.drop("y"), 1, 2)
    plain_model = NB.fit_multinomial(NB.class_counts(tok, None, [0, 1]))
    assert sorted(map(tuple, model.select("y", "w", "log_p").collect())) == sorted(map(tuple, plain_model.select("y", "w", "log_p").collect()))
    only = df.selectExpr("id", "cast(null as int) as y", "text")
    model, priors, _ = EM.fit(only, NB.tokens(only).drop("y"), 1, 1)
    assert model.count() == 0 and priors.count() == 0


def test_posteriors_are_a_row_a_document(spark):
    """a document's words are one row, its posteriors another; unknown words and none at all leave the priors."""
    bags = spark.createDataFrame([(1, [("a", 2), ("zzz", 5)]), (2, [("b", 1)])], "id long, bag array<struct<w:string,tf:long>>")
    model = spark.createDataFrame([(0, "a", -1.0), (1, "a", -3.0), (0, "b", -2.0), (1, "b", -0.5)], "y int, w string, log_p double")
    priors = spark.createDataFrame([(1, math.log(0.25)), (0, math.log(0.75))], "y int, log_prior double")
    ids = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    got = {r["id"]: {c["y"]: c["p"] for c in r["post"]} for r in EM.posteriors(ids, bags, model, priors).collect()}
    odds = {1: math.exp(-2) * 3 / math.exp(-6), 2: math.exp(-2) * 3 / math.exp(-0.5), 3: 3.0}
    assert len(got) == 3
    for i, o in odds.items():
        assert got[i] == {0: pytest.approx(o / (1 + o)), 1: pytest.approx(1 / (1 + o))}
