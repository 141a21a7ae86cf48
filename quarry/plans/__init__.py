"""Registered plans: one callable (spark, sf_dir) -> DataFrame per key, plus
the DuckDB twin SQL for every key that has an exact relational equivalent."""

from __future__ import annotations

from quarry.plans import affinity, bayes, evaluate, movie_sql, neighbours, recommend, tree

_FAMILIES = (affinity, movie_sql, evaluate, bayes, neighbours, tree, recommend)


def all_queries() -> dict:
    return {key: q for m in _FAMILIES for key, q in m.QUERIES.items()}


def all_oracles() -> dict:
    return {key: sql for m in _FAMILIES for key, sql in m.ORACLE.items()}
