"""Bloom filters of the ids that each stored day holds.

A filter is a table of blocks of 256 bits, four numbers of 64.  An id belongs to one
block and sets two bits in each number.  Filters of one size can be merged by a bitwise
or, so they are built with partial aggregation, and a filter over a longer time follows
from those of its days.  An id whose bits are not all set is certainly not there; one
that is not there passes with a chance of about one in a million (``BITS_PER_ID``).
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BITS_PER_ID = 48
BLOCK_BITS = 256
NUMBERS = [f"b{i}" for i in range(BLOCK_BITS // 64)]
FILTER = StructType().add("size", "integer").add("block", "long")
for _name in NUMBERS:
    FILTER = FILTER.add(_name, "long")


def size_for(ids: Column) -> Column:
    """The size of a filter for so many ids: its blocks are two to that power."""
    blocks = F.greatest(F.lit(1), F.ceil(ids * BITS_PER_ID / BLOCK_BITS))
    return F.ceil(F.log2(blocks.cast("double"))).cast("int")


def _masks(key: Column) -> list[Column]:
    h = F.xxhash64(key, F.lit("bits"))
    one = F.lit(1).cast("long")

    def bit(i: int) -> Column:
        return F.call_function("shiftleft", one, F.shiftrightunsigned(h, 6 * i).bitwiseAND(63).cast("int"))

    return [bit(2 * i).bitwiseOR(bit(2 * i + 1)) for i in range(len(NUMBERS))]


def _block(key: Column, size: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.call_function("shiftleft", F.lit(1).cast("long"), size))


def id_filters(rows: DataFrame, group: str, key: str) -> DataFrame:
    """``group`` with the blocks of its filter over ``key``.  ``rows`` has a column ``size``."""
    held = rows.select(
        group, "size", _block(F.col(key), F.col("size")).alias("block"),
        *[m.alias(n) for m, n in zip(_masks(F.col(key)), NUMBERS, strict=True)],
    )
    return merged(held, group)


def merged(filters: DataFrame, *groups: str) -> DataFrame:
    """Filters of one size as one, per group: its ids are those of all."""
    return filters.groupBy(*groups, "size", "block").agg(*[F.bit_or(n).alias(n) for n in NUMBERS])


def may_hold(filters: DataFrame, ids: DataFrame, group: str, key: str, sizes: list[int]) -> DataFrame:
    """``group``, ``key``: where an id may be.  Ids and blocks meet by an equi-join.

    ``sizes`` are those that filters have, a few powers of two.  A null id is nowhere.
    """
    probes = (
        ids.where(F.col(key).isNotNull())
        .select(key, F.explode(F.array(*[F.lit(s) for s in sizes])).alias("size"))
        .withColumn("block", _block(F.col(key), F.col("size")))
        .withColumns({f"m{n}": m for m, n in zip(_masks(F.col(key)), NUMBERS, strict=True)})
    )
    set_all = reduce(and_, [F.col(n).bitwiseAND(F.col(f"m{n}")) == F.col(f"m{n}") for n in NUMBERS])
    return filters.join(probes, ["size", "block"]).where(set_all).select(group, key)
