"""Positions in the order of a whole table, from one range sort and one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.session import materialize

# A row number within a partition takes so many bits of an id that rises over all of them.
_ROW_BITS = 33
ROWS_PER_PART = 1 << 20


def with_positions(
    rows: DataFrame, order: Sequence[str], parts: int | None = None, name: str = "position"
) -> DataFrame:
    """``rows`` with their position, from 0, in the order of some columns; nulls come last.

    The table is dealt out by ranges of the order and sorted once, and written so; each
    row's place within its range is known from the write.  The number of rows before a
    range follows from one count per range, so no window runs over rows, and nothing is
    collected.  Ties are told apart by the other columns; equal rows share no position.
    """
    parts = parts or max(rows.sparkSession.sparkContext.defaultParallelism, rows.count() // ROWS_PER_PART)
    keys = [F.col(c).asc_nulls_last() for c in order]
    keys.append(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]).asc())
    at = F.monotonically_increasing_id().alias("_at")
    ranged = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).select("*", at)
    held = materialize(ranged, "ordered")
    part = F.shiftright("_at", _ROW_BITS).alias("_part")
    # One row per range.
    sizes = held.groupBy(part).agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    place = F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1)
    return (
        held.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + place)
        .select(*[F.col(f"`{c}`") for c in rows.columns], name)
    )


def ordered_pages(rows: DataFrame, page_rows: int, order: Sequence[str], parts: int | None = None) -> DataFrame:
    """``rows`` with ``page`` and ``position``: all pages of a walk in stable order at once.

    A page is ``page_rows`` rows, the last one what is left.  Pages follow from the
    position, so any number of them are written or read side by side.
    """
    placed = with_positions(rows, order, parts)
    return placed.withColumn("page", F.floor(F.col("position") / page_rows).cast("long"))
