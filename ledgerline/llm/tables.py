"""The given tables, and a session whose workers can import this package."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import the package from where the driver has it.

    On a cluster whose executors get the package by ``--py-files`` or an image,
    the extra entry of the search path is of no effect.
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(":")
    if ROOT not in paths:
        environment["PYTHONPATH"] = ":".join(p for p in [ROOT, *paths] if p)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def unused(docs: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
