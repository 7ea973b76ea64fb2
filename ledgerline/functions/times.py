"""UTC timestamps as strict text and as naive timestamps."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed pattern: yyyy-MM-ddTHH:mm:ssZ with ranged fields, no fraction.
UTC_TEXT = (
    r"^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])"
    r"T([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]Z\z"
)


def calendar_time(text: Column) -> Column:
    """Naive UTC timestamp of a well-formed text; NULL when no such day exists."""
    return F.when(~text.startswith("0000"), F.substring(text, 1, 19).try_cast("timestamp_ntz"))


def parse_utc(text: Column) -> Column:
    """Naive UTC timestamp of a text; NULL when malformed or not on the calendar."""
    return F.when(text.rlike(UTC_TEXT), calendar_time(text))


def format_utc(timestamp: Column) -> Column:
    """Strict text of a naive UTC timestamp, cut to whole seconds."""
    plain = F.substring(timestamp.cast("timestamp_ntz").cast("string"), 1, 19)
    return F.concat(F.translate(plain, " ", "T"), F.lit("Z"))


def utc_literal(value: datetime | None) -> Column:
    """A naive UTC timestamp literal."""
    if value is None:
        return F.lit(None).cast("timestamp_ntz")
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def back_days(timestamp: Column, days: int) -> Column:
    """The timestamp ``days`` days earlier."""
    return timestamp - F.make_dt_interval(F.lit(days))
