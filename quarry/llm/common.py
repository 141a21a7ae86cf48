"""Helpers shared by the operators: reading, materialising, row keys."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import checkpoint_dir
from quarry.sources.tables import table_path

#: ``[^\x20\x09-\x0D]+`` as a Java regex: the words of the contracts.
WORD_SPLIT = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, table))
    return df.select(*columns) if columns else df


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage durably: a lost executor costs a reread, and a Python
    pass or a row number behind it is never evaluated twice.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(text: str | Column = "text") -> Column:
    """64-bit hash of a text; with doc_id it tells the rows of ``documents`` apart."""
    return F.xxhash64(F.col(text) if isinstance(text, str) else text)


def same_key(a: DataFrame, b: DataFrame, *cols: str) -> Column:
    """Null-safe equality of ``cols``; Spark plans it as an equi-join."""
    cond = a[cols[0]].eqNullSafe(b[cols[0]])
    for c in cols[1:]:
        cond = cond & a[c].eqNullSafe(b[c])
    return cond


def keep_rows(docs: DataFrame, keep: DataFrame, one_per_key: bool = False) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, row key of the text) is in ``keep`` (doc_id, text_key).

    With ``one_per_key`` a row that is repeated as it is stays once.  All
    columns of ``docs`` come back, whatever they are called.
    """
    mark = f"key_{uuid.uuid4().hex}"
    k = keep.select(F.col("doc_id").alias("id_of_kept"), F.col("text_key").alias("key_of_kept"))
    marked = docs.withColumn(mark, row_key())
    out = marked.join(k, marked["doc_id"].eqNullSafe(k["id_of_kept"])
                      & marked[mark].eqNullSafe(k["key_of_kept"]), "left_semi")
    if one_per_key:
        out = out.dropDuplicates(["doc_id", mark])
    return out.drop(mark)
