"""Flagging natural-key duplicates with a deterministic survivor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A group of this many rows or more is joined by broadcast instead of by shuffle.
HOT_GROUP_ROWS = 1_000_000
# At most this many such groups are broadcast, the largest first, one row of a
# key and an id each: some 20 MB.  A group left to the shuffle is therefore
# smaller than HOT_GROUP_ROWS or than one HOT_GROUPS-th of the table.
HOT_GROUPS = 100_000
# So many groups at most, written beforehand, are all joined by broadcast: some 150 MB.
FEW_GROUPS = 1_000_000
# More of them are looked up where a task gets so many at most, some 30 MB; else sorted.
GROUPS_A_TASK = 200_000


def repeated_hashes(rows: DataFrame, key: str = "natural_key_hash") -> DataFrame:
    """The 64-bit hashes, ``_key_hash``, that more than one row's key has.

    Every group with more than one row has such a hash; a hash that two keys share by
    chance is listed too.  A number is shuffled for a row, not its key, time and id.
    """
    hashes = rows.groupBy(F.xxhash64(key).alias("_key_hash")).agg(F.count("*").alias("_rows"))
    return hashes.where("_rows > 1").select("_key_hash")


def duplicate_groups(
    rows: DataFrame,
    key: str = "natural_key_hash",
    order: str = "transaction_date",
    row_id: str = "transaction_id",
    repeated: DataFrame | None = None,
    few_groups: int = FEW_GROUPS,
) -> DataFrame:
    """Size and survivor of every group with more than one row.

    The survivor is the earliest row, ties broken by the lowest id.  Partial
    aggregation leaves one row per group and task before the shuffle.

    ``repeated`` is :func:`repeated_hashes` of the same rows, written beforehand.  If
    there are at most ``few_groups`` of them, they are broadcast and only rows of their
    groups are shuffled.  The result is the same.
    """
    if repeated is not None and repeated.count() <= few_groups:
        listed = F.xxhash64(key) == F.col("_key_hash")
        rows = rows.join(F.broadcast(repeated), listed, "left_semi")
    return (
        rows.groupBy(key)
        .agg(
            F.min(F.struct(order, row_id))[row_id].alias("_survivor"),
            F.count("*").alias("_group_size"),
        )
        .where(F.col("_group_size") > 1)
    )


def flag_duplicates(
    rows: DataFrame,
    key: str = "natural_key_hash",
    order: str = "transaction_date",
    row_id: str = "transaction_id",
    hot_group_rows: int = HOT_GROUP_ROWS,
    hot_groups: int = HOT_GROUPS,
    groups: DataFrame | None = None,
    few_groups: int = FEW_GROUPS,
) -> DataFrame:
    """Set ``is_duplicate`` and ``duplicate_of_transaction_id`` over the whole table.

    Rows meet their group's survivor instead of being sorted together in one
    task.  The largest groups receive theirs by broadcast, bounded by
    ``hot_groups`` rows, and their rows take a join key of their own so that
    they spread evenly; all other rows are joined by a shuffle on the key.
    Neither bound changes the result.

    ``groups`` is :func:`duplicate_groups` of the same rows, written beforehand.  If
    there are at most ``few_groups`` of them, all are joined by broadcast and no row is
    shuffled; else they are divided as above.  Then their number also tells whether a task's
    share of them can be held as a table to look up, so that its rows need not be sorted.
    """
    survivor = F.coalesce("_hot_survivor", "_survivor")
    n_groups = None if groups is None else groups.count()
    if groups is not None and n_groups <= few_groups:
        few = groups.select(F.col(key).alias("_join_key"), "_survivor")
        joined = rows.join(F.broadcast(few), F.col(key) == F.col("_join_key"), "left")
        survivor = F.col("_survivor")
    else:
        joined = _joined(rows, groups, n_groups, key, order, row_id, hot_group_rows, hot_groups)
    is_duplicate = F.coalesce(survivor != F.col(row_id), F.lit(False))
    flags = {
        "is_duplicate": is_duplicate,
        "duplicate_of_transaction_id": F.when(is_duplicate, survivor),
    }
    kept = [flags.pop(c).alias(c) if c in flags else F.col(c) for c in rows.columns]
    return joined.select(*kept, *[c.alias(name) for name, c in flags.items()])


def _joined(
    rows: DataFrame,
    groups: DataFrame | None,
    n_groups: int | None,
    key: str,
    order: str,
    row_id: str,
    hot_group_rows: int,
    hot_groups: int,
) -> DataFrame:
    """The rows with ``_hot_survivor`` or ``_survivor`` of their group."""
    if groups is None:
        groups = duplicate_groups(rows, key, order, row_id)
    hot = (
        groups.where(F.col("_group_size") >= hot_group_rows)
        .orderBy(F.desc("_group_size"), key)
        .limit(hot_groups)
        .select(F.col(key).alias("_hot_key"), F.col("_survivor").alias("_hot_survivor"))
    )
    cold = groups.select(F.col(key).alias("_join_key"), "_survivor")
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if n_groups is not None and n_groups <= GROUPS_A_TASK * tasks:
        cold = cold.hint("shuffle_hash")
    spread_key = F.when(F.col("_hot_key").isNull(), F.col(key)).otherwise(
        F.concat(F.lit("hot row "), F.col(row_id))
    )
    return (
        rows.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
        .withColumn("_join_key", spread_key)
        .join(cold, "_join_key", "left")
    )


def flagged_count(flagged: DataFrame) -> DataFrame:
    return flagged.agg(F.count_if("is_duplicate").alias("duplicates"))


def duplicate_members(flagged: DataFrame) -> DataFrame:
    """Every row of a group that holds a duplicate.

    Duplicates qualify by their flag, survivors by being pointed at, so only
    unique ids are joined and a large group meets no single task.
    """
    duplicates = flagged.where("is_duplicate")
    pointed_at = duplicates.select(
        F.col("duplicate_of_transaction_id").alias("transaction_id")
    ).distinct()
    survivors = flagged.where(~F.col("is_duplicate")).join(
        pointed_at, "transaction_id", "left_semi"
    )
    return duplicates.unionByName(survivors)
