"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Semantics: naive UTC timestamps, and the last value wins for a JSON key written twice.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Physical defaults for large tables; every one is a runtime setting.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins whose build side proves small per partition skip the sort of the wide side.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Collecting a handful of currencies per group must not fall back to sorting.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
}


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply the two settings that results depend on to an existing session."""
    for key, value in SEMANTIC_CONF.items():
        spark.conf.set(key, value)
    return spark


def tune_session(spark: SparkSession) -> SparkSession:
    """Apply the physical settings too; they change no result."""
    for key, value in ADAPTIVE_CONF.items():
        spark.conf.set(key, value)
    return prepare_session(spark)


# How stored and intermediate tables are packed: ids and hashes take half the room of snappy.
COMPRESSION = "zstd"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``.  Only a local session,
    where driver and executors share one disk, may fall back to a temporary
    folder of its own.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    root = getattr(context, "_ledgerline_scratch", None)
    if root is None:
        root = tempfile.mkdtemp(prefix="ledgerline-")
        context._ledgerline_scratch = root
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage of ``df`` by writing it as a columnar table and reading it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=COMPRESSION)
    return spark.read.schema(df.schema).parquet(path)
