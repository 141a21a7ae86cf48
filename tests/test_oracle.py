"""Every registered query against its DuckDB twin on sf0.001 (the driver
gate runs the same comparison on sf0.01)."""

import datetime
import math

import duckdb
import pytest

from quarry.plans import all_oracles, all_queries
from quarry.sources.tables import TABLES, table_path
from tests.conftest import SF001

ORACLES = all_oracles()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def _key(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{table_path(SF001, t)}'")
    return con


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(all_queries())


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_duckdb(spark, duck, key):
    df = all_queries()[key](spark, SF001)
    res = duck.sql(ORACLES[key])
    assert sorted(df.columns) == sorted(res.columns)
    s, o = [tuple(r) for r in df.collect()], res.fetchall()
    assert len(s) == len(o)
    assert _key(s, df.columns) == _key(o, res.columns)


ROWS_ONLY = {  # key -> columns that identify a row
    "tree_clf_ml": ["id"], "tree_reg_ml": ["id"], "mov_als": ["user", "rank"], "knn_lsh": ["id", "rank"],
    "sketch_tree_split": ["feature", "threshold"], "sketch_tree_fit": ["node"], "sql_raters_rollup": ["item", "month", "level"]}


@pytest.mark.parametrize("key", sorted(set(all_queries()) - set(ORACLES)))
def test_queries_without_a_twin(spark, key):
    """One row per identity, and none missing; their values are tested by family."""
    df = all_queries()[key](spark, SF001)
    got = df.collect()
    assert got and len({tuple(r[c] for c in ROWS_ONLY[key]) for r in got}) == len(got)
    if key.startswith("tree"):
        test = all_queries()["eval_split"](spark, SF001).where("is_test").count()
        assert len(got) == test


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
