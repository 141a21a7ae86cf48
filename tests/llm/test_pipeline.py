"""The pipeline and its stages against plain Python on small tables."""

from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from quarry.llm import common, mixing, quality
from quarry.llm.queries import vocabulary
from tests.conftest import SF001
from tests.llm import plain
from tests.llm.test_tokens import BYTE, library


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    """A folder with odd documents (and clashing columns) and labels for some."""
    d = str(tmp_path_factory.mktemp("tables"))
    plain.table(spark, plain.odd_rows()).write.parquet(f"{d}/documents.parquet")
    junk = [(1000 + i, "buy!! " * 50 + str(i), "en", "s9", 1) for i in range(20)]
    plain.table(spark, junk).write.mode("append").parquet(f"{d}/documents.parquet")
    labels = [(i, 1, 0) for i in (1, 3, 6, 7, 11, 12, *range(100, 130))] + [(1000 + i, 0, 0) for i in range(20)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("which", ["odd", "documents"])
def test_stages_in_turn(spark, written, which):
    sf_dir = written if which == "odd" else SF001
    docs = common.read(spark, sf_dir, "documents")
    seen = pairs(docs)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]
    for name, stage in list(stages.items())[:-1]:
        out = common.materialise(stage(spark, docs, sf_dir), "test-stage")
        assert out.columns == docs.columns
        rows = pairs(out)
        if name == "quality":
            scored = quality.score_documents(docs, common.read(spark, sf_dir, "labels")).collect()
            assert Counter(i for i, _ in rows) == Counter(r.doc_id for r in scored if r.predicted)
        elif name == "exact_dedup":
            expect = {}
            for i, t in seen:
                expect[t or ""] = max(expect.get(t or "", (False, 0)), (i is not None, i or 0))
            assert Counter(((i is not None, i or 0), t or "") for i, t in rows) == Counter((v, k) for k, v in expect.items())
        elif name == "near_dedup":
            found, n = plain.near_components(seen, corpus_pipeline.NEAR_PERCENT)
            assert len(rows) == n and {i for i, _ in rows} == {c for _, _, c in found}
        else:
            sampled = mixing.sample(docs).collect()
            assert Counter(i for i, _ in rows) == Counter(r.doc_id for r in sampled if r.kept)
        assert not Counter(rows) - Counter(seen)
        docs, seen = out, rows
    pieces = stages["packing"](spark, docs, sf_dir).collect()
    sizes = Counter()
    for p in pieces:
        sizes[p.doc_id] += p.length
    expect = Counter()
    for (i, _), ids in zip(seen, library(BYTE, [t for _, t in seen], 1)):
        expect[i] += len(ids)
    assert sizes == expect
    whole = Counter(p.sequence_id for p in pieces for _ in range(p.length))
    assert all(n == 2048 for s, n in whole.items() if s != max(whole)) and sum(whole.values()) == sum(expect.values())


def test_run(spark, written):
    out = corpus_pipeline.run(spark, written)
    rows = out.collect()
    assert rows and {"doc_id", "sequence_id", "offset", "ids_crc32"} <= set(out.columns)
    assert not {r.doc_id for r in rows} & set(range(1000, 1020))  # the junk is gone
    assert len({r.doc_id for r in rows} & set(range(100, 130))) <= 1  # one of the copies


def test_empty_documents(spark, written, tmp_path):
    none = common.read(spark, written, "documents").filter("false")
    none.write.parquet(f"{tmp_path}/documents.parquet")
    common.read(spark, written, "labels").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered():
    q, o = entry.queries(), entry.oracle_sql()
    assert q["pipeline"] is corpus_pipeline.run and "pipeline" not in o
    assert sorted(int(k[2:].split("_")[0]) for k in q if k.startswith("op")) == list(range(1, 14))
    assert set(o) <= set(q)
    assert np.dtype("<u2").itemsize == 2 and vocabulary(BYTE).endswith(BYTE)
