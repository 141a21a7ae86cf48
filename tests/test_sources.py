import os

from pyspark.sql import functions as F

from quarry.session import checkpoint_dir
from quarry.sources.tables import TABLES, read_csv, read_table, register_views
from tests.conftest import SF001, rows


def test_csv_with_fixed_schema_round_trip(spark, tmp_path):
    nation = read_table(spark, SF001, "nation")
    out = os.path.join(str(tmp_path), "nation_csv")
    nation.write.option("header", "true").csv(out)
    back = read_csv(spark, out, "n_nationkey int, n_name string, n_regionkey int")
    assert back.dtypes == nation.dtypes
    assert rows(back) == rows(nation)


def test_read_table_prunes_columns(spark):
    df = read_table(spark, SF001, "lineitem", ["l_orderkey", "l_partkey"]).where(F.col("l_orderkey") > 5)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan
    assert "PushedFilters: [IsNotNull(l_orderkey), GreaterThan(l_orderkey,5)]" in plan


def test_register_views(spark):
    names = register_views(spark, SF001)
    assert set(names) == set(TABLES)
    assert spark.sql("SELECT count(*) FROM region").first()[0] == 5


def test_spread_follows_the_session(spark):
    from quarry.session import TEXT_PARTITIONS

    doc = read_table(spark, SF001, "documents", ["doc_id"])
    spread = read_table(spark, SF001, "documents", ["doc_id"], spread=True)
    assert spread.rdd.getNumPartitions() == int(spark.conf.get(TEXT_PARTITIONS))
    assert rows(spread) == rows(doc)


def test_checkpoint_dir_comes_from_session(spark):
    d = checkpoint_dir(spark)
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        assert conf.rstrip("/").split("/")[-1] in d


def test_entry_without_the_optional_part(monkeypatch):
    """A missing folder or library costs only the queries that need it."""
    import importlib

    import __spark_entry__ as entry

    real = importlib.import_module

    def absent(name, *args):
        if name.startswith(("quarry.llm", "corpus_pipeline")):
            raise ModuleNotFoundError(f"No module named {name}")
        return real(name, *args)

    monkeypatch.setattr(importlib, "import_module", absent)
    assert "knn" in entry.queries() and "pipeline" not in entry.queries()
    assert not [k for k in entry.oracle_sql() if k.startswith("op")]
