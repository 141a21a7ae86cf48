"""A training corpus in five stages: quality, exact and near copies, mixture, packing.

``run`` applies ``STAGES`` to ``documents``; each stage's rows are written as
Parquet to the shared folder and read again by the next.  Each takes
(spark, docs, sf_dir); all but the last return the columns of ``docs``.  Rows
with nulls, empty texts, repeated rows and extra columns pass as the operators'
docstrings say; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import common, exact_dedup, mixing, near_dedup, packing, quality
from quarry.llm.queries import vocabulary

#: Similarity of near copies, in percent of the five-word shingles of both.
NEAR_PERCENT = 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality.drop_rejected(docs, common.read(spark, sf_dir, "labels", "doc_id", "quality"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the largest doc_id's."""
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies, of similarity 0.8 or more: the smallest doc_id's."""
    return near_dedup.drop_near_copies(docs, percent=NEAR_PERCENT)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample in the calibrated proportions of source, language and topic."""
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 ids, neighbours along the curve."""
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"), end_id=1, with_ids=False)


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: The classifier and the vocabulary have no SQL form; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
