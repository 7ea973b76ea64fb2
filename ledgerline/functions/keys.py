"""Identity of records: natural key, payload key and row hashes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.contract import Contract


def two_decimals(text: Column) -> Column:
    """A decimal text with exactly two decimals, half-even; unreadable texts stay as they are."""
    rounded = F.bround(text.try_cast("decimal(38,10)"), 2).cast("decimal(30,2)")
    return (
        F.when(text.rlike(r"^(0|[1-9][0-9]*)\.[0-9]{2}\z"), text)
        .when(text.rlike(r"^(0|[1-9][0-9]*)\.[0-9]\z"), F.concat(text, F.lit("0")))
        .otherwise(F.coalesce(rounded.cast("string"), text))
    )


def natural_key(contract: Contract, values: Mapping[str, Column]) -> Column:
    """All business fields except the id as ``name=value`` parts joined by pipes."""
    parts = []
    for name in contract.natural_key_fields:
        text = two_decimals(values[name]) if name == "amount" else values[name]
        parts.append(F.concat(F.lit(f"{name}="), F.coalesce(text, F.lit("None"))))
    return F.concat_ws("|", *parts)


def natural_key_hash(contract: Contract, values: Mapping[str, Column]) -> Column:
    return F.sha2(natural_key(contract, values), 256)


def payload_key(canonical: Column) -> Column:
    """Identity of a payload from its canonical text: compact, keys sorted, ASCII."""
    return F.sha2(canonical, 256)


def row_digest(columns: Sequence[Column]) -> Column:
    """A 64-bit hash of the row as an exact number; NULL and empty text differ."""
    tagged = [F.struct(c.isNull(), c) for c in columns]
    return F.xxhash64(*tagged).cast("decimal(38,0)")
