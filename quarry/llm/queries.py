"""The operators' queries over their whole tables, and SQL where it can express one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (common, exact_dedup, language, mixing, near_dedup, neighbours, packing,
                        passage_dedup, quality, secret_scan, setm, sim_balls, token_files, turn_trie)


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def q_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (quality.score_documents(common.read(spark, sf_dir, "documents", "doc_id", "text"),
                                    common.read(spark, sf_dir, "labels", "doc_id", "quality"))
            .select("doc_id", "held_out", "score", "predicted"))


def q_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.scratch(spark, "token-files")
    token_files.write_token_files(common.read(spark, sf_dir, "documents", "doc_id", "text"), path,
                                  vocabulary("word_bpe_49k.json"), end_id=2)
    return token_files.read_token_files(spark, path, with_ids=False)


def q_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(common.read(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def q_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (passage_dedup.cut_passages(common.read(spark, sf_dir, "documents", "doc_id", "text"))
            .select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")))


def q_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (near_dedup.near_groups(common.read(spark, sf_dir, "documents", "doc_id", "text"))
            .select("doc_id", "n_shingles", "component_id", "kept", "n_links"))


def q_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict_language(common.read(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def q_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (exact_dedup.exact_groups(common.read(spark, sf_dir, "documents", "doc_id", "text"))
            .select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))


def q_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(common.read(spark, sf_dir, "documents", "doc_id", "text"),
                                  vocabulary("byte_bpe_50k.json"), end_id=1, with_ids=False)


def q_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(common.read(spark, sf_dir, "documents", "doc_id", "text"))
    spans = F.col("spans")
    return found.select(
        "doc_id", *[secret_scan.counted(spans, k).alias(f"n_{k}") for k in secret_scan.STRONG],
        F.sha2(secret_scan.listed(spans, secret_scan.STRONG), 256).alias("base_sha256"),
        secret_scan.listed(spans).alias("spans"))


def q_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # its SQL twin fixes the scale: the greatest ratio
    return mixing.sample(common.read(spark, sf_dir, "documents", "doc_id", "text", "source", "lang"), keep=0.0).drop("text_key")


def q_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setm.collocations(common.read(spark, sf_dir, "documents", "lang", "text"))


def q_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_trie.conversation_trie(common.read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def q_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sim_balls.near_groups(common.read(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {
    "op1_quality": q_quality,
    "op2_token_files": q_token_files,
    "op3_neighbours": q_neighbours,
    "op4_passage_dedup": q_passage_dedup,
    "op5_near_dedup": q_near_dedup,
    "op6_language": q_language,
    "op7_exact_dedup": q_exact_dedup,
    "op8_packing": q_packing,
    "op9_secret_scan": q_secret_scan,
    "op10_mixing": q_mixing,
    "op11_collocations": q_collocations,
    "op12_turn_trie": q_turn_trie,
    "op13_simhash": q_simhash,
}

ORACLE = {
    "op10_mixing": mixing.oracle(),
    "op11_collocations": setm.ORACLE,
    "op12_turn_trie": turn_trie.ORACLE,
    "op7_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
}
