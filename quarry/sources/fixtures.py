"""Operator inputs derived from the driver tables.

Each builder returns the logical table one operator family consumes, read
from the whole input tables (no id subsets, no row caps).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.numeric import quantise
from quarry.functions.text import letter_share, word_count
from quarry.operators.affinity import baskets
from quarry.sources.tables import read_table


def order_baskets(spark: SparkSession, sf_dir: str, item: str = "p_brand") -> DataFrame:
    """(basket, item): one row per order and distinct ``part.<item>``.

    lineitem ⋈ part is left to the planner: AQE broadcasts ``part`` when
    its runtime size is under the broadcast threshold and falls back to a
    sort-merge join when it is not (``part`` grows with the scale factor).
    """
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", item])
    lines = li.join(part, li.l_partkey == part.p_partkey)
    return baskets(lines, "l_orderkey", item)


def rating_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating event per order line: (user, partkey, rating, rated_at).

    ``rating`` is the line quantity (1..50); ``rated_at`` the order date.
    """
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_quantity"])
    od = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .select(F.col("o_custkey").alias("user"),
                    F.col("l_partkey").alias("partkey"),
                    F.col("l_quantity").alias("rating"),
                    F.col("o_orderdate").alias("rated_at")))


def rating_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating events with the item title: (user, item, rating, rated_at)."""
    ev = rating_events(spark, sf_dir)
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name"])
    return (ev.join(part, ev.partkey == part.p_partkey)
            .select("user", F.col("p_name").alias("item"), "rating", "rated_at"))


def feature_rows(spark: SparkSession, sf_dir: str, task: str = "classification") -> DataFrame:
    """Tree inputs from labels ⋈ documents.

    classification: y = quality (0/1); regression: y = n_chars (double).
    letter_share is quantised to 2 digits so candidate thresholds are a
    bounded set (at most 101 values) however many documents there are.
    """
    lab = read_table(spark, sf_dir, "labels", ["doc_id", "quality"])
    doc = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "n_chars"], spread=True)
    df = lab.join(doc, "doc_id")
    y = (F.col("quality").cast("int") if task == "classification"
         else F.col("n_chars").cast("double"))
    return df.select(
        F.col("doc_id").alias("id"),
        quantise(letter_share("text"), 2).alias("letter_share"),
        word_count("text").alias("n_words"),
        F.col("n_chars"),
        F.col("lang"),
        y.alias("y"),
    )


def labelled_text(spark: SparkSession, sf_dir: str, label: str = "toxic") -> DataFrame:
    """(id, text, y) from labels ⋈ documents, y = toxic by default."""
    lab = read_table(spark, sf_dir, "labels", ["doc_id", label])
    doc = read_table(spark, sf_dir, "documents", ["doc_id", "text"], spread=True)
    return (lab.join(doc, "doc_id")
            .select(F.col("doc_id").alias("id"), "text", F.col(label).cast("int").alias("y")))


def partly_labelled_text(spark: SparkSession, sf_dir: str, label: str = "toxic") -> DataFrame:
    """(id, text, y) of all ``documents``, y null where ``labels`` has none."""
    lab = read_table(spark, sf_dir, "labels", ["doc_id", label])
    doc = read_table(spark, sf_dir, "documents", ["doc_id", "text"], spread=True)
    return (doc.join(lab, "doc_id", "left")
            .select(F.col("doc_id").alias("id"), "text", F.col(label).cast("int").alias("y")))


def labelled_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, v array<double>, label) from ``embeddings``."""
    emb = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    return emb.select(F.col("vec_id").alias("id"),
                      F.col("embedding").cast("array<double>").alias("v"),
                      F.col("label").cast("int").alias("label"))
