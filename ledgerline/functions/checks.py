"""The record checks as column expressions.

Every check is a condition plus the text reported when it holds.  All checks
of a record are evaluated together; none hides another, except that a field's
later checks only look at values its earlier checks let through.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.contract import Contract
from ledgerline.functions.text import shown
from ledgerline.functions.times import UTC_TEXT, calendar_time

# Fixed patterns of the contract; \z also refuses a final newline.
TRANSACTION_ID = r"^TXN-[A-Za-z0-9]+\z"
ACCOUNT_ID = r"^ACC-[0-9]{4}\z"
DECIMAL_TEXT = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z"
# What nearly every amount looks like: positive, at most two decimals, storable.
ORDINARY_AMOUNT = r"^(?=[0.]*[1-9])[0-9]{1,16}(\.[0-9]{1,2})?\z"
BLANK = r"(?U)^[\s\x1c-\x1f]*\z"
COUNTRY_SHAPE = r"(?s)^(?=.?[A-Z])[\x00-\x60\x7B-\x7F]{2}\z"


@dataclass(frozen=True)
class RecordView:
    """A record as the checks see it.

    ``texts`` holds each field as text, NULL when absent or null.  ``kinds``
    holds the JSON type of each field; empty when every field is a string.
    ``printed`` holds what a violation text prints, where that is not the text.
    ``unexpected`` lists the field names outside the contract, sorted, and
    ``is_object`` tells whether the payload is an object at all.
    """

    texts: Mapping[str, Column]
    kinds: Mapping[str, Column]
    printed: Mapping[str, Column] = field(default_factory=dict)
    unexpected: Column | None = None
    is_object: Column | None = None


def label(field: str, code: str, expected: str = "") -> str:
    """The fixed part of a violation text that shows the offending value."""
    return f"{field}: {code} ({expected}got "


@dataclass(frozen=True)
class FieldCheck:
    """What is wrong with one field: a label, or NULL when it is fine or absent.

    A field's checks build on each other, so at most one of them applies.
    """

    field: str
    problem: Column
    value: Column
    kind: Column | None

    @property
    def text(self) -> Column:
        return F.concat(self.problem, shown(self.value, self.kind), F.lit(")"))


def text_view(contract: Contract) -> RecordView:
    """View of a table that holds every contract field as a string column."""
    return RecordView({f: F.col(f) for f in contract.record_fields}, {})


def _written_decimals(text: Column) -> Column:
    """Digits after the point as written, less the exponent."""
    fraction = F.length(F.regexp_extract(text, r"\.([0-9]*)", 1))
    exponent = F.regexp_extract(text, r"[eE]([+-]?[0-9]+)", 1).try_cast("double")
    return fraction - F.coalesce(exponent, F.lit(0.0))


def _first_of(field: str, cases: list[tuple[Column, str]], expected: str = "") -> Column:
    chain = F
    for condition, code in cases:
        chain = chain.when(condition, label(field, code, expected))
    return chain


def field_checks(contract: Contract, view: RecordView) -> list[FieldCheck]:
    """The checks of each field, in reporting order."""
    v = view.texts
    date, amount, country = v["transaction_date"], v["amount"], v["country_code"]

    date_cases = [
        (~date.rlike(UTC_TEXT), "invalid_iso8601_utc_format"),
        (calendar_time(date).isNull(), "not_a_real_calendar_date"),
    ]
    if contract.strict_window:
        # Well-formed texts sort as their times do.
        outside = (date < contract.window_start) | (date > contract.window_end)
        date_cases.append((outside, f"outside_expected_window_{contract.window_label}"))

    name = v["merchant_name"]
    unnamed = name.rlike(BLANK)
    if "merchant_name" in view.kinds:
        unnamed = name.isNotNull() & (unnamed | (view.kinds["merchant_name"] != "STRING"))

    def outside_of(field: str, allowed: tuple[str, ...], code: str) -> Column:
        return F.when(~v[field].isin(*allowed), label(field, code))

    problems = {
        "transaction_id": _first_of(
            "transaction_id",
            [(~v["transaction_id"].rlike(TRANSACTION_ID), "invalid_format")],
            "expected TXN-NNNN, ",
        ),
        "account_id": _first_of(
            "account_id",
            [(~v["account_id"].rlike(ACCOUNT_ID), "invalid_format")],
            "expected ACC-NNNN, ",
        ),
        "transaction_date": F.when(
            date.isNotNull(), _first_of("transaction_date", date_cases)
        ),
        "amount": F.when(
            ~amount.rlike(ORDINARY_AMOUNT),
            _first_of(
                "amount",
                [
                    (~amount.rlike(DECIMAL_TEXT), "not_numeric"),
                    (
                        amount.rlike(r"^\s*-") | ~amount.rlike(r"^[^eE]*[1-9]"),
                        "not_strictly_positive",
                    ),
                    (_written_decimals(amount) > 2, "more_than_two_decimal_places"),
                    # An extension: the amount could not be stored.
                    (amount.try_cast("decimal(18,2)").isNull(), "out_of_range"),
                ],
            ),
        ),
        "currency": outside_of("currency", contract.currencies, "invalid_currency_code"),
        "transaction_type": outside_of(
            "transaction_type", contract.transaction_types, "invalid_transaction_type"
        ),
        "merchant_category": outside_of(
            "merchant_category", contract.categories, "invalid_merchant_category"
        ),
        "status": outside_of("status", contract.statuses, "invalid_status"),
        "merchant_name": _first_of(
            "merchant_name", [(unnamed, "empty_or_whitespace_only")]
        ),
        "country_code": _first_of(
            "country_code",
            [
                (~country.rlike(COUNTRY_SHAPE), "invalid_format"),
                (~country.isin(*contract.countries), "not_an_assigned_iso3166_code"),
            ],
        ),
    }
    return [
        FieldCheck(f, p, view.printed.get(f, v[f]), view.kinds.get(f))
        for f, p in problems.items()
    ]


def violations(contract: Contract, view: RecordView) -> Column:
    """All violation texts of a record in reporting order; empty for a valid record.

    The conditions run for every record, collecting and printing only for a
    record that fails one of them.
    """
    none = F.lit(None).cast("string")
    checks = field_checks(contract, view)

    def finding(label: Column, value: Column = none, kind: Column | None = none) -> Column:
        kind = none if kind is None else kind
        return F.struct(label.alias("label"), value.alias("value"), kind.alias("kind"))

    def collected(found: list[Column]) -> Column:
        return F.array_compact(F.array(*found))

    absent = {f: view.texts[f].isNull() for f in contract.record_fields}
    parts = [
        collected(
            [
                F.when(gone, finding(F.lit(f"{f}: missing_required_field")))
                for f, gone in absent.items()
            ]
        ),
        collected(
            [
                F.when(c.problem.isNotNull(), finding(c.problem, c.value, c.kind))
                for c in checks
            ]
        ),
    ]
    failed = reduce(or_, absent.values()) | F.coalesce(*[c.problem for c in checks]).isNotNull()
    if view.unexpected is not None:
        failed = failed | (F.size(view.unexpected) > 0)
        unexpected = F.transform(
            view.unexpected,
            lambda name: finding(F.concat(name, F.lit(": unexpected_field"))),
        )
        parts.insert(1, unexpected)

    typed = bool(view.kinds)
    texts = F.transform(
        F.concat(*parts),
        lambda f: F.when(f["value"].isNull(), f["label"]).otherwise(
            F.concat(f["label"], shown(f["value"], f["kind"] if typed else None), F.lit(")"))
        ),
    )
    found = F.when(failed, texts).otherwise(F.array().cast("array<string>"))
    if view.is_object is None:
        return found
    # An extension: what is not a JSON object has no fields to check.
    return F.when(view.is_object, found).otherwise(F.array(F.lit("payload: not_an_object")))
