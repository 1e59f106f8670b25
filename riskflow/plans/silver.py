"""Silver domains: how each raw feed is cleaned, checked, split and deduplicated."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.functions import cleaning as c
from riskflow.operators import quality
from riskflow.operators.dedup import latest_per_key
from riskflow.operators.rules import Clock
from riskflow.sources.readers import RESCUED

References = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Domain:
    """One feed: its key, cleaning expressions, reference checks and hidden columns."""

    name: str
    key: str
    columns: Callable[[], dict[str, Column]]
    # dimension name -> key column that must exist in it
    references: dict[str, str] = field(default_factory=dict)
    # raw columns that are not published
    hidden: tuple[str, ...] = ()
    late_flag: bool = False
    one_reject_per_key: bool = False

    def clean(self, raw: DataFrame, clock: Clock = Clock()) -> DataFrame:
        return raw.drop(RESCUED).withColumns({**self.columns(), "_silver_processed_at": clock.timestamp})

    def validate(self, cleaned: DataFrame, references: References | None = None, clock: Clock = Clock()) -> DataFrame:
        """Add the match columns, ``rejected_reasons`` and, where used, ``is_late_arrival``."""
        checked = cleaned
        for dimension, key in self.references.items():
            checked = quality.with_reference(checked, (references or {})[dimension], key)
        checked = quality.with_reasons(checked, self.name, clock)
        return checked.withColumn("is_late_arrival", quality.late_arrival()) if self.late_flag else checked

    def accepted(self, validated: DataFrame) -> DataFrame:
        return quality.accepted(validated, *self.hidden)

    def latest(self, validated: DataFrame) -> DataFrame:
        """Accepted rows, the newest per key. A rejected newer row hides nothing."""
        return latest_per_key(self.accepted(validated), [self.key])

    def rejected(self, validated: DataFrame, clock: Clock = Clock()) -> DataFrame:
        rows = quality.rejected(validated, *self.hidden, clock=clock)
        return latest_per_key(rows, [self.key]) if self.one_reject_per_key else rows


def _provenance() -> dict[str, Column]:
    return {
        "adf_run_id": F.trim("adf_run_id"),
        "_ingested_at": c.parse_timestamp("_ingested_at"),
        "source_file": F.trim("source_file"),
    }


def _customer_columns() -> dict[str, Column]:
    return {
        "customer_id": c.clean_formatted_customer_id("customer_id"),
        "full_name": c.clean_name("full_name"),
        "emirates_id": c.clean_emirates_id("emirates_id"),
        "email": c.clean_email("email"),
        "phone": c.clean_phone("phone"),
        "nationality": c.clean_nationality("nationality"),
        "date_of_birth": c.parse_mixed_date("date_of_birth"),
        "account_opened_date": c.parse_mixed_date("account_opened_date"),
        "risk_tier": c.clean_text("risk_tier"),
        **_provenance(),
    }


def _account_columns() -> dict[str, Column]:
    return {
        "account_id": c.clean_formatted_account_id("account_id"),
        "customer_id": c.clean_formatted_customer_id("customer_id"),
        "account_type": c.clean_account_type("account_type"),
        "account_status": c.clean_account_status("status"),
        "account_currency": c.clean_account_currency("currency"),
        "opened_date": c.parse_mixed_date("opened_date"),
        **_provenance(),
    }


def _payment_columns() -> dict[str, Column]:
    """What transactions and card swipes have in common."""
    return {
        "card_id": c.clean_formatted_card_id("card_id"),
        "customer_id": c.clean_formatted_customer_id("customer_id"),
        "account_id": c.clean_formatted_account_id("account_id"),
        "merchant": c.clean_merchant("merchant"),
        "mcc_code": c.parse_mcc_code("mcc_code"),
        "city": c.clean_city("city"),
    }


def _transaction_columns() -> dict[str, Column]:
    return {
        "transaction_id": c.clean_formatted_transaction_id("transaction_id"),
        **_payment_columns(),
        "transaction_amount": c.parse_amount("amount"),
        "account_currency": c.clean_account_currency("currency"),
        "transaction_timestamp": c.parse_timestamp("timestamp"),
        "auth_code": c.clean_text("auth_code"),
        "transaction_status": c.clean_text("status"),
        **_provenance(),
    }


def _swipe_columns() -> dict[str, Column]:
    return {
        "swipe_id": F.trim("swipe_id"),
        **_payment_columns(),
        "card_swipe_amount": c.parse_amount("amount"),
        "country": F.trim("country"),
        "swipe_card_currency": c.clean_account_currency("currency"),
        "swipe_timestamp": c.parse_timestamp("event_ts"),
        "adf_run_id": F.trim("adf_run_id"),
        "_ingested_at": c.parse_timestamp("ingested_at"),
        "source_file": F.trim("file_name"),
    }


def _sanction_columns() -> dict[str, Column]:
    return {
        "entry_id": F.trim("entry_id"),
        "name": F.initcap(F.trim("name")),
        "aliases": c.alias_list("aliases"),
        "date_of_birth": c.parse_mixed_date("date_of_birth"),
        "nationality": F.trim("nationality"),
        "entity_type": c.clean_text("entity_type"),
        "list_source": F.trim("list_source"),
        **_provenance(),
    }


CUSTOMERS = Domain("customers", "customer_id", _customer_columns)
ACCOUNTS = Domain(
    "accounts",
    "account_id",
    _account_columns,
    references={"customers": "customer_id"},
    hidden=("status", "currency"),
)
TRANSACTIONS = Domain(
    "transactions",
    "transaction_id",
    _transaction_columns,
    references={"customers": "customer_id", "accounts": "account_id"},
    hidden=("status", "currency", "timestamp"),
    late_flag=True,
)
SWIPES = Domain(
    "swipes",
    "swipe_id",
    _swipe_columns,
    references={"customers": "customer_id", "accounts": "account_id"},
    hidden=("event_ts", "currency", "amount", "file_name", "ingested_at"),
)
SANCTIONS = Domain("sanctions", "entry_id", _sanction_columns, one_reject_per_key=True)

DOMAINS = {d.name: d for d in (CUSTOMERS, ACCOUNTS, TRANSACTIONS, SWIPES, SANCTIONS)}
