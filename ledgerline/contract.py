"""The record contract: which fields a payment record has and what they may hold."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields, replace
from typing import Any

from pyspark.sql import SparkSession

# Fixed values of the record contract.
CONTRACT_FIELDS = (
    "transaction_id",
    "account_id",
    "transaction_date",
    "amount",
    "currency",
    "transaction_type",
    "merchant_name",
    "merchant_category",
    "status",
    "country_code",
)
METADATA_FIELDS = ("id", "created_at", "inserted_at", "updated_at")
CURRENCIES = ("USD", "EUR", "GBP", "CHF", "JPY", "AUD", "CAD")
TRANSACTION_TYPES = ("debit", "credit")
STATUSES = ("completed", "pending", "failed", "reversed")
CATEGORIES = (
    "e-commerce",
    "travel",
    "food_and_beverage",
    "groceries",
    "electronics",
    "retail",
    "entertainment",
    "health",
    "transportation",
    "home_and_garden",
    "payroll",
    "transfer",
)
WINDOW_START = "2024-01-01T00:00:00Z"
WINDOW_END = "2024-03-31T23:59:59Z"
WINDOW_LABEL = "2024Q1"


def assigned_countries(spark: SparkSession) -> tuple[str, ...]:
    """Assigned ISO 3166-1 alpha-2 codes, as the driver's Java runtime lists them."""
    return tuple(sorted(spark._jvm.java.util.Locale.getISOCountries()))


@dataclass(frozen=True)
class Contract:
    """Parameters of the checks; the defaults are the published contract."""

    countries: tuple[str, ...]
    record_fields: tuple[str, ...] = CONTRACT_FIELDS
    metadata_fields: tuple[str, ...] = METADATA_FIELDS
    currencies: tuple[str, ...] = CURRENCIES
    transaction_types: tuple[str, ...] = TRANSACTION_TYPES
    statuses: tuple[str, ...] = STATUSES
    categories: tuple[str, ...] = CATEGORIES
    window_start: str = WINDOW_START
    window_end: str = WINDOW_END
    window_label: str = WINDOW_LABEL
    strict_window: bool = True

    @classmethod
    def default(cls, spark: SparkSession, **overrides: Any) -> Contract:
        return replace(cls(countries=assigned_countries(spark)), **overrides)

    @classmethod
    def from_mapping(cls, spark: SparkSession, settings: Mapping[str, Any]) -> Contract:
        """Build a contract from configuration, e.g. a parsed YAML or JSON document."""
        known = {f.name for f in fields(cls)}
        unknown = sorted(set(settings) - known)
        if unknown:
            raise ValueError(f"unknown contract settings: {', '.join(unknown)}")
        values = {k: tuple(v) if isinstance(v, list) else v for k, v in settings.items()}
        return cls.default(spark, **values)

    @property
    def natural_key_fields(self) -> tuple[str, ...]:
        return tuple(f for f in self.record_fields if f != "transaction_id")
