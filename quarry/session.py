"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every plan in this package relies on.  AQE re-plans joins at
# shuffle boundaries (runtime broadcast of small sides, coalescing of tiny
# partitions, splitting of skewed partitions in sort-merge joins).
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Number of partitions to deal texts over before regex work on them; unset
# (the default on a cluster) they are read as they are stored.
TEXT_PARTITIONS = "spark.quarry.textPartitions"


def get_session(master: str | None = None, app: str = "quarry",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; the
    shuffle partition count should then be sized to the data (roughly
    input bytes / 128 MB), which AQE coalesces downwards at runtime.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        b = b.config(TEXT_PARTITIONS, str(shuffle_partitions or 8))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it up if needed.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that is
    always used.  Only a local-mode session without the setting (tests)
    gets a fresh scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="quarry-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; name a shared (HDFS/S3/ABFS) folder")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Survives executor loss, is computed once however many consumers it has,
    and later reads prune columns.  The folder belongs to the application.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/quarry-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partition_for_expansion(df: DataFrame, *cols: str) -> DataFrame:
    """Hash-partition ``df`` on ``cols`` into ``spark.sql.shuffle.partitions``
    partitions, for inputs of a join that multiplies rows (self-joins,
    rating × similarity).  AQE sizes a plain ``repartition(col)`` by its
    input bytes and would coalesce a small input into a few partitions,
    leaving the expanded work to a few tasks; a fixed count keeps it spread.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *cols)

