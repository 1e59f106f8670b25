"""Row rules and data-quality expectations, declared as data.

A rule pairs a rejection code with a condition that *fires* on a bad row; an
expectation pairs a name with a condition that should *hold*. Conditions are
functions of a ``Clock`` so that a run can be pinned to one instant.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskflow.functions.cleaning import is_city


@dataclass(frozen=True)
class Clock:
    """The instant a run takes as now; ``None`` is the time of execution."""

    now: Column | None = None

    @property
    def timestamp(self) -> Column:
        return F.current_timestamp() if self.now is None else self.now

    @property
    def date(self) -> Column:
        return F.current_date() if self.now is None else self.now.cast("date")


Condition = Callable[[Clock], Column]


#: What a rule of time waits for.
CLOCK = "clock"


@dataclass(frozen=True)
class Rule:
    """``waits``: what may come later and stop the rule from firing on the same row, the dimension that lacks its key or the
    CLOCK; None if the row's own columns decide for good."""

    code: str
    fires: Condition
    waits: str | None = None


@dataclass(frozen=True)
class Expectation:
    name: str
    holds: Condition


# Conditions that fire on bad values. SQL logic applies: a NULL never fires
# unless the condition asks for it.


def missing(c: str) -> Condition:
    return lambda clock: F.col(c).isNull()


def blank(c: str) -> Condition:
    return lambda clock: F.col(c).isNull() | (F.trim(F.col(c)) == "")


def malformed(c: str, pattern: str, optional: bool = False) -> Condition:
    if optional:
        return lambda clock: ~F.col(c).rlike(pattern)
    return lambda clock: F.col(c).isNull() | ~F.col(c).rlike(pattern)


def outside(c: str, allowed: tuple[str, ...]) -> Condition:
    return lambda clock: F.col(c).isNull() | ~F.col(c).isin(*allowed)


def not_positive(c: str) -> Condition:
    return lambda clock: F.col(c).isNull() | (F.col(c) <= 0)


def future_date(c: str) -> Condition:
    return lambda clock: F.col(c) > clock.date


def missing_or_future(c: str) -> Condition:
    return lambda clock: F.col(c).isNull() | (F.col(c) > clock.timestamp)


def unknown_reference(c: str, match: str) -> Condition:
    return lambda clock: F.col(c).isNotNull() & F.col(match).isNull()


# Conditions that hold on good values.


def matches(c: str, pattern: str) -> Condition:
    return lambda clock: F.col(c).rlike(pattern)


def present_and_matches(c: str, pattern: str) -> Condition:
    return lambda clock: F.col(c).isNotNull() & F.col(c).rlike(pattern)


def absent_or_matches(c: str, pattern: str) -> Condition:
    return lambda clock: F.col(c).isNull() | F.col(c).rlike(pattern)


def present(c: str) -> Condition:
    return lambda clock: F.col(c).isNotNull()


def filled(c: str) -> Condition:
    return lambda clock: F.col(c).isNotNull() & (F.trim(F.col(c)) != "")


def absent_or_filled(c: str) -> Condition:
    return lambda clock: F.col(c).isNull() | (F.trim(F.col(c)) != "")


def one_of(c: str, allowed: tuple[str, ...]) -> Condition:
    return lambda clock: F.col(c).isin(*allowed)


def present_and_one_of(c: str, allowed: tuple[str, ...]) -> Condition:
    return lambda clock: F.col(c).isNotNull() & F.col(c).isin(*allowed)


def positive(c: str) -> Condition:
    return lambda clock: F.col(c).isNotNull() & (F.col(c) > 0)


def not_future_date(c: str) -> Condition:
    return lambda clock: F.col(c) <= clock.date


def present_and_past(c: str) -> Condition:
    return lambda clock: F.col(c).isNotNull() & (F.col(c) <= clock.timestamp)


def absent_or_between(c: str, low: int, high: int) -> Condition:
    return lambda clock: F.col(c).isNull() | F.col(c).between(low, high)


def _approved_without_code(clock: Clock) -> Column:
    return (F.col("transaction_status") == "APPROVED") & malformed("auth_code", AUTH_CODE)(clock)


def _approved_with_code(clock: Clock) -> Column:
    return (F.col("transaction_status") != "APPROVED") | present_and_matches("auth_code", AUTH_CODE)(clock)


# Identifier layouts, allowed values, rule codes and expectation names.
CUSTOMER_ID = "^CUST[0-9]{6}$"
ACCOUNT_ID = "^ACC[0-9]{7}$"
TRANSACTION_ID = "^TXN[0-9]{14}$"
CARD_ID = "^CARD[0-9]{6}$"
AUTH_CODE = "^AUTH[0-9]{6}$"
SANCTION_ID = "^SANC[0-9]{4,}$"
SWIPE_ID = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
EMIRATES_ID = "^[0-9]{3}-[0-9]{4}-[0-9]{7}-[0-9]$"
EMAIL = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z]+$"
PHONE = "^[+]971-[0-9]{2}-[0-9]{3}-[0-9]{4}$"
RISK_TIERS = ("LOW", "MEDIUM", "HIGH")
ACCOUNT_TYPES = ("SALARY", "SAVINGS", "CREDIT_CARD", "CURRENT")
ACCOUNT_STATUSES = ("ACTIVE", "DORMANT", "CLOSED")
CURRENCIES = ("AED", "EUR", "USD")
TRANSACTION_STATUSES = ("APPROVED", "DECLINED")
ENTITY_TYPES = ("INDIVIDUAL", "ORGANIZATION")
LIST_SOURCES = ("EU Sanctions (mock)", "UN Consolidated List", "OFAC SDN (mock)")
MCC_RANGE = (1000, 9999)

RULES: dict[str, tuple[Rule, ...]] = {
    "customers": (
        Rule("INVALID_CUSTOMER_ID_FORMAT", malformed("customer_id", CUSTOMER_ID)),
        Rule("FULL_NAME_IS_NOT_PROVIDED", blank("full_name")),
        Rule("EMIRATES_ID_NOT_PROVIDED", blank("emirates_id")),
        Rule("INVALID_EMIRATES_ID_FORMAT", malformed("emirates_id", EMIRATES_ID, optional=True)),
        Rule("NATIONALIITY_IS_NOT_PROVIDED", blank("nationality")),
        Rule("DATE_OF_BIRTH_NOT_PROVIDED", missing("date_of_birth")),
        Rule("DATE_OF_BIRTH_IN_FUTURE", future_date("date_of_birth"), CLOCK),
        Rule("ACCOUNT_OPENED_DATE_NOT_PROVIDED", missing("account_opened_date")),
        Rule("ACCOUNT_OPENED_DATE_IN_FUTURE", future_date("account_opened_date"), CLOCK),
        Rule("ACCOUNT_OPENED_DATE_BEFORE_DOB", lambda clock: F.col("account_opened_date") < F.col("date_of_birth")),
        Rule("INVALID_RISK_TIER", outside("risk_tier", RISK_TIERS)),
        Rule("INVALID_EMAIL_FORMAT", malformed("email", EMAIL, optional=True)),
        Rule("INVALID_PHONE_FORMAT", malformed("phone", PHONE, optional=True)),
        Rule("ADF_RUN_ID_IS_NOT_PROVIDED", blank("adf_run_id")),
        Rule("INGESTION_DATE_IS_NOT_PROVIDED", missing("_ingested_at")),
    ),
    "accounts": (
        Rule("INVALID_CUSTOMER_ID_FORMAT", malformed("customer_id", CUSTOMER_ID)),
        Rule("CUSTOMER_NOT_FOUND", unknown_reference("customer_id", "_matched_customer_id"), "customers"),
        Rule("INVALID_ACCOUNT_ID_FORMAT", malformed("account_id", ACCOUNT_ID)),
        Rule("INVALID_ACCOUNT_TYPE", outside("account_type", ACCOUNT_TYPES)),
        Rule("INVALID_ACCOUNT_STATUS", outside("account_status", ACCOUNT_STATUSES)),
        Rule("INVALID_ACCOUNT_CURRENCY", outside("account_currency", CURRENCIES)),
        Rule("OPENED_DATE_REQUIRED", missing("opened_date")),
        Rule("OPENED_DATE_IN_FUTURE", future_date("opened_date"), CLOCK),
        Rule("INVALID_ADF_RUN_ID", blank("adf_run_id")),
        Rule("INVALID_INGESTED_AT", missing("_ingested_at")),
    ),
    "transactions": (
        Rule("INVALID_TRANSACTION_ID", malformed("transaction_id", TRANSACTION_ID)),
        Rule("INVALID_CARD_ID", malformed("card_id", CARD_ID)),
        Rule("INVALID_CUSTOMER_ID", malformed("customer_id", CUSTOMER_ID)),
        Rule("CUSTOMER_ID_DOES_NOT_EXIST", unknown_reference("customer_id", "_matched_customer_id"), "customers"),
        Rule("INVALID_ACCOUNT_ID", malformed("account_id", ACCOUNT_ID)),
        Rule("ACCOUNT_ID_DOES_NOT_EXIST", unknown_reference("account_id", "_matched_account_id"), "accounts"),
        Rule("INVALID_TRANSACTION_AMOUNT", not_positive("transaction_amount")),
        Rule("INVALID_TRANSACTION_TIMESTAMP", missing_or_future("transaction_timestamp"), CLOCK),
        Rule("INVALID_AUTH_CODE", _approved_without_code),
        Rule("INVALID_TRANSACTION_STATUS", outside("transaction_status", TRANSACTION_STATUSES)),
    ),
    "swipes": (
        Rule("INVALID_SWIPE_ID", malformed("swipe_id", SWIPE_ID)),
        Rule("INVALID_CUSTOMER_ID", malformed("customer_id", CUSTOMER_ID)),
        Rule("CUSTOMER_ID_DOES_NOT_EXIST", unknown_reference("customer_id", "_matched_customer_id"), "customers"),
        Rule("INVALID_ACCOUNT_ID", malformed("account_id", ACCOUNT_ID)),
        Rule("ACCOUNT_ID_DOES_NOT_EXIST", unknown_reference("account_id", "_matched_account_id"), "accounts"),
        Rule("INVALID_CARD_ID", malformed("card_id", CARD_ID)),
        Rule("INVALID_COUNTRY", blank("country")),
        Rule("INVALID_CARD_SWIPE_AMOUNT", not_positive("card_swipe_amount")),
        Rule("INVALID_TIMESTAMP", missing_or_future("swipe_timestamp"), CLOCK),
    ),
    "sanctions": (
        Rule("INVALID_ENTITY_TYPE", missing("entity_type")),
        Rule("INVALID_LIST_SOURCE", missing("list_source")),
        Rule("INVALID_NAME", missing("name")),
        Rule("INVALID_ENTRY_ID", malformed("entry_id", SANCTION_ID)),
    ),
}

_RUN_ID = Expectation("valid_adf_run_id", filled("adf_run_id"))
_INGESTED_AT = Expectation("valid_ingested_at", present("_ingested_at"))
_SOURCE_FILE = Expectation("valid_source_file", filled("source_file"))
_CITY = Expectation("valid_city", lambda clock: F.col("city").isNull() | is_city("city"))
_MCC_CODE = Expectation("valid_mcc_code", absent_or_between("mcc_code", *MCC_RANGE))
_MERCHANT = Expectation("valid_merchant", absent_or_filled("merchant"))

EXPECTATIONS: dict[str, tuple[Expectation, ...]] = {
    "customers": (
        Expectation("valid_customer_id_format", matches("customer_id", CUSTOMER_ID)),
        Expectation("valid_full_name", filled("full_name")),
        Expectation("emirates_id_present", filled("emirates_id")),
        Expectation("valid_emirates_id_format", matches("emirates_id", EMIRATES_ID)),
        Expectation("valid_nationality", filled("nationality")),
        Expectation("dob_not_in_future", not_future_date("date_of_birth")),
        Expectation("account_opened_date_not_in_future", not_future_date("account_opened_date")),
        Expectation("account_opened_after_dob", lambda clock: F.col("account_opened_date") >= F.col("date_of_birth")),
        Expectation("valid_risk_tier", one_of("risk_tier", RISK_TIERS)),
        Expectation("valid_email_format", absent_or_matches("email", EMAIL)),
        Expectation("valid_phone_format", absent_or_matches("phone", PHONE)),
        _RUN_ID,
        _INGESTED_AT,
        _SOURCE_FILE,
    ),
    "accounts": (
        Expectation("valid_account_id_format", matches("account_id", ACCOUNT_ID)),
        Expectation("valid_customer_id_format", matches("customer_id", CUSTOMER_ID)),
        Expectation("valid_account_type", one_of("account_type", ACCOUNT_TYPES)),
        Expectation("valid_account_status", one_of("account_status", ACCOUNT_STATUSES)),
        Expectation("valid_account_currency", one_of("account_currency", CURRENCIES)),
        Expectation("valid_opened_required", present("opened_date")),
        Expectation("valid_opened_date", not_future_date("opened_date")),
        _RUN_ID,
        _INGESTED_AT,
        _SOURCE_FILE,
    ),
    "transactions": (
        Expectation("valid_transaction_id", present_and_matches("transaction_id", TRANSACTION_ID)),
        Expectation("valid_card_id", present_and_matches("card_id", CARD_ID)),
        Expectation("valid_customer_id", present_and_matches("customer_id", CUSTOMER_ID)),
        Expectation("valid_account_id", present_and_matches("account_id", ACCOUNT_ID)),
        Expectation("valid_transaction_amount", positive("transaction_amount")),
        Expectation("valid_transaction_timestamp", present_and_past("transaction_timestamp")),
        Expectation("valid_account_currency", present_and_one_of("account_currency", CURRENCIES)),
        _CITY,
        Expectation("valid_transaction_status", one_of("transaction_status", TRANSACTION_STATUSES)),
        _RUN_ID,
        _INGESTED_AT,
        _MCC_CODE,
        _MERCHANT,
        Expectation("valid_auth_code", _approved_with_code),
        _SOURCE_FILE,
    ),
    "swipes": (
        Expectation("valid_card_id", present_and_matches("card_id", CARD_ID)),
        Expectation("valid_customer_id", present_and_matches("customer_id", CUSTOMER_ID)),
        Expectation("valid_account_id", present_and_matches("account_id", ACCOUNT_ID)),
        Expectation("valid_swipe_id", present_and_matches("swipe_id", SWIPE_ID)),
        Expectation("valid_card_swipe_amount", positive("card_swipe_amount")),
        Expectation("valid_swipe_timestamp", present_and_past("swipe_timestamp")),
        Expectation("valid_country", filled("country")),
        _CITY,
        Expectation("valid_swipe_card_currency", present_and_one_of("swipe_card_currency", CURRENCIES)),
        _MCC_CODE,
        _MERCHANT,
        _SOURCE_FILE,
        _RUN_ID,
        _INGESTED_AT,
    ),
    "sanctions": (
        Expectation("valid_entity_type", present_and_one_of("entity_type", ENTITY_TYPES)),
        Expectation("valid_list_source", present_and_one_of("list_source", LIST_SOURCES)),
        Expectation("valid_name", filled("name")),
        Expectation("valid_entry_id", present_and_matches("entry_id", SANCTION_ID)),
        _SOURCE_FILE,
        _RUN_ID,
        _INGESTED_AT,
    ),
}
