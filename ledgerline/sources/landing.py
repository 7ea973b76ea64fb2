"""Reading raw records from a landing folder of JSON lines, as a batch or a stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime, timedelta
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.contract import Contract
from ledgerline.functions.checks import RecordView
from ledgerline.functions.text import has_fraction, marked_numbers, unmarked_numbers
from ledgerline.functions.times import back_days, format_utc


def read_landing(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per JSON line of a folder or of several, in the column ``payload``."""
    return spark.read.text(path).withColumnRenamed("value", "payload")


def stream_landing(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same rows as an unbounded table that grows with the folder."""
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path).withColumnRenamed("value", "payload")


# Whether a record is wanted, from its date as text and from whether it is an object.
Taken = Callable[[Column, Column], Column]


def parse_records(
    records: DataFrame, contract: Contract, taken: Taken | None = None
) -> DataFrame:
    """Parse ``payload`` once and lay its parts next to it.

    Each contract field becomes a text column; ``_json`` is the payload with
    sorted keys and ``_keys`` lists its members, both NULL for what is no JSON
    or no object.  One projection per step, so that no step runs twice.  The parsed
    value drops ``.0`` from numbers, so a payload that holds a fraction is parsed
    again with such numbers set aside, for ``_json`` alone: 1 and 1.0 stay apart.

    The parser stops after one value.  Read as the only element of an array,
    a line that holds more than one record is refused instead of losing all
    but the first.

    Of records that ``taken`` refuses only ``transaction_date`` and ``_keys`` are laid
    out; the other columns are NULL.
    """
    listed = records.withColumn(
        "_list", F.try_parse_json(F.concat(F.lit("["), "payload", F.lit("]")))
    )
    alone = F.try_variant_get("_list", "$[1]", "variant").isNull()
    parsed = listed.withColumn(
        "_record", F.when(alone, F.try_variant_get("_list", "$[0]", "variant"))
    ).drop("_list")
    texts = {
        name: F.try_variant_get("_record", f"$.{name}", "string") for name in contract.record_fields
    }
    keys = F.map_keys(F.try_variant_get("_record", "$", "map<string,variant>"))
    date = texts["transaction_date"]
    wanted = (lambda c: c) if taken is None else partial(F.when, taken(date, keys.isNotNull()))
    fields = [
        text.alias(name) if name == "transaction_date" else wanted(text).alias(name)
        for name, text in texts.items()
    ]
    apart = F.try_parse_json(marked_numbers(F.col("payload")))
    exact = F.when(
        F.col("_record").isNotNull() & has_fraction(F.col("payload")),
        unmarked_numbers(F.to_json(apart)),
    )
    return parsed.select(
        "*",
        *fields,
        wanted(F.coalesce(exact, F.to_json("_record"))).alias("_json"),
        keys.alias("_keys"),
    )


def json_view(contract: Contract) -> RecordView:
    """View of the rows that :func:`parse_records` returns."""
    known = F.array(*[F.lit(f) for f in contract.record_fields + contract.metadata_fields])
    kinds = {
        f: F.schema_of_variant(F.try_variant_get("_record", f"$.{f}", "variant"))
        for f in contract.record_fields
    }
    return RecordView(
        texts={f: F.col(f) for f in contract.record_fields},
        kinds=kinds,
        printed={
            # The payload's own text keeps the order of an object's members.
            f: F.when(
                kinds[f].rlike("^(ARRAY|OBJECT)"), F.get_json_object("payload", f"$.{f}")
            ).otherwise(F.col(f))
            for f in contract.record_fields
        },
        unexpected=F.sort_array(F.array_except("_keys", known)),
        is_object=F.col("_keys").isNotNull(),
    )


def since(date_text: Column, requested_from: Column) -> Column:
    """The source filter of an incremental read: inclusive and on the raw text.

    The comparison is lexical, so a record with a malformed date is still
    fetched and checked; a record without any date is not.
    """
    return date_text >= format_utc(requested_from)


def incremental_scan(
    records: DataFrame, watermark: Column, lookback_days: int, date_field: str = "transaction_date"
) -> DataFrame:
    """Records dated at or after the watermark less the lookback."""
    return records.where(since(F.col(date_field), back_days(watermark, lookback_days)))


def keyset_page(
    records: DataFrame,
    limit: int,
    after: tuple[str, str] | None = None,
    order: tuple[str, str] = ("transaction_date", "transaction_id"),
) -> DataFrame:
    """The next ``limit`` records in stable order after the last record seen.

    A page costs one filtered top-k, however far into the table it lies.
    """
    first, second = F.col(order[0]), F.col(order[1])
    if after is not None:
        records = records.where(
            (first >= after[0]) & ((first > after[0]) | (second > after[1]))
        )
    return records.orderBy(first, second).limit(limit)


def offset_page(
    records: DataFrame,
    limit: int,
    offset: int,
    order: tuple[str, str] = ("transaction_date", "transaction_id"),
) -> DataFrame:
    """Page by position; meant for the first pages only, later ones use :func:`keyset_page`."""
    return records.orderBy(*order).offset(offset).limit(limit)


def iter_pages(
    records: DataFrame,
    limit: int,
    order: tuple[str, str] = ("transaction_date", "transaction_id"),
) -> Iterator[list]:
    """Walk the records page by page for a client; a short page ends the walk."""
    after = None
    while True:
        page = keyset_page(records, limit, after, order).collect()
        yield page
        if len(page) < limit:
            return
        after = (page[-1][order[0]], page[-1][order[1]])


def requested_from(watermark: datetime | None, lookback_days: int) -> datetime | None:
    """Where an incremental read starts; None asks for everything."""
    return None if watermark is None else watermark - timedelta(days=lookback_days)
