"""Putting small results together without a cross join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def side_by_side(*one_row_tables: DataFrame) -> DataFrame:
    """One row with the columns of several one-row tables."""
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), one_row_tables
    )
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
