"""Readers for the star-schema tables.

Parquet is read lazily with only the requested columns, so Catalyst pushes
the projection and any later filter into the scan (``ReadSchema`` /
``PushedFilters`` in the plan).  CSV always takes an explicit schema: schema
inference would scan the whole input once more before the query starts.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from quarry.session import TEXT_PARTITIONS

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | tuple[str, ...] | None = None,
               spread: bool = False) -> DataFrame:
    """Read one Parquet table; ``columns`` prunes the scan.

    ``spread=True`` is for inputs of CPU-heavy per-row work (regex over whole
    texts): where the session names a partition count (``TEXT_PARTITIONS``),
    rows are dealt over that many, so a table stored as one row group does
    not run as one task.
    """
    df = spark.read.parquet(table_path(sf_dir, name))
    if columns:
        df = df.select(*columns)
    n = spark.conf.get(TEXT_PARTITIONS, None) if spread else None
    return df.repartition(int(n)) if n else df


def read_csv(spark: SparkSession, path: str, schema: StructType | str,
             header: bool = True, sep: str = ",") -> DataFrame:
    """Headered CSV with a fixed schema; malformed rows fail the job."""
    return (spark.read.schema(schema)
            .option("header", str(header).lower())
            .option("sep", sep)
            .option("mode", "FAILFAST")
            .csv(path))


def register_views(spark: SparkSession, sf_dir: str,
                   names: tuple[str, ...] = TABLES) -> list[str]:
    """Register every table as a temp view of the same name (for spark.sql)."""
    for name in names:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)
    return list(names)
