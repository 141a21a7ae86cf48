"""SURVEY §5.4: the same result whatever the input partitioning."""

import pytest

from quarry.operators import bayes as NB
from quarry.operators import recommend as M
from quarry.operators import tree as T
from tests.conftest import SF001, rows

PARTS = (1, 4, 13)


def test_tree_fit_invariant(spark):
    from quarry.plans.tree import CLF_FEATURES
    from quarry.sources.fixtures import feature_rows

    df = feature_rows(spark, SF001)
    ref = rows(T.fit_levelwise(df, CLF_FEATURES, 2, "gini", [0, 1]))
    for n in PARTS:
        assert rows(T.fit_levelwise(df.repartition(n), CLF_FEATURES, 2, "gini", [0, 1])) == ref


def test_bayes_scores_invariant(spark):
    from quarry.sources.fixtures import labelled_text

    docs = labelled_text(spark, SF001)

    def scores(d):
        tok = NB.tokens(d)
        pri = NB.class_priors(d, [0, 1])
        model = NB.fit_bernoulli(NB.class_counts(tok, None, [0, 1], 2), pri)
        s = NB.score(tok, model, pri, [0, 1])
        return sorted((r["id"], r["y"], r["score"]) for r in s.collect())

    # sums of logs in a partition-dependent order: equal up to rounding error
    ref = scores(docs)
    for n in PARTS:
        got = scores(docs.repartition(n))
        assert [(i, y) for i, y, _ in got] == [(i, y) for i, y, _ in ref]
        assert [x for _, _, x in got] == pytest.approx([x for _, _, x in ref], abs=1e-9)


def test_item_similarity_invariant(spark):
    from quarry.plans.recommend import _facts

    r = M.ratings(_facts(spark, SF001))
    ref = sorted((x["item_a"], x["item_b"], x["n_common"], x["similarity"])
                 for x in M.item_similarity(r).collect())
    for n in PARTS:
        got = sorted((x["item_a"], x["item_b"], x["n_common"], x["similarity"])
                     for x in M.item_similarity(r.repartition(n)).collect())
        assert [g[:3] for g in got] == [f[:3] for f in ref]
        assert [g[3] for g in got] == pytest.approx([f[3] for f in ref], abs=1e-12)
