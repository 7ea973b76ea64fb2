"""Key upsert: a row of the batch replaces the row of the same key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class BatchKeyConflict(ValueError):
    """Two rows of one batch claim the same key."""


def upsert(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The target without the rows the batch replaces, plus the batch.

    The batch must hold each key once; see :func:`assert_unique` and
    :func:`latest_per_key`.
    """
    kept = target.join(batch.select(key), key, "left_anti")
    return kept.unionByName(batch)


def repeated_keys(batch: DataFrame, key: str) -> DataFrame:
    return batch.groupBy(key).count().where("count > 1").select(key)


def assert_unique(batch: DataFrame, key: str) -> None:
    """Fail when a key occurs twice in the batch."""
    found = repeated_keys(batch, key).limit(1).collect()
    if found:
        raise BatchKeyConflict(f"duplicate key in batch: {key} = {found[0][0]!r}")


def latest_per_key(batch: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key: the greatest by ``order``, then by the remaining columns.

    A running maximum per key, so a key with very many rows is reduced inside
    each task before the shuffle.
    """
    rest = [c for c in batch.columns if c not in order and c != key]
    best = F.max(F.struct(*order, *rest)).alias("_best")
    return batch.groupBy(key).agg(best).select(
        *[F.col(key) if c == key else F.col(f"_best.{c}") for c in batch.columns]
    )
