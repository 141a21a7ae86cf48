"""Operator families: affinity, tree, bayes, neighbours, recommend, evaluate."""
