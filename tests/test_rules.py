"""Every rejection code fires on a bad row and only there; expectations count."""

import datetime as dt
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskflow.operators import quality
from riskflow.operators.rules import EXPECTATIONS, RULES, Clock

NOW = dt.datetime(2024, 6, 1, 12)
TODAY, TOMORROW, PAST = dt.date(2024, 6, 1), dt.date(2024, 6, 2), dt.date(1990, 1, 2)

GOOD = {
    "customers": {
        "customer_id": ("string", "CUST000001"), "full_name": ("string", "Ali"),
        "emirates_id": ("string", "784-1990-1234567-1"), "email": ("string", "a@b.com"),
        "phone": ("string", "+971-50-123-4567"), "nationality": ("string", "AE"),
        "date_of_birth": ("date", PAST), "account_opened_date": ("date", TODAY), "risk_tier": ("string", "LOW"),
    },
    "accounts": {
        "account_id": ("string", "ACC0000001"), "customer_id": ("string", "CUST000001"),
        "_matched_customer_id": ("string", "CUST000001"), "account_type": ("string", "SALARY"),
        "account_status": ("string", "ACTIVE"), "account_currency": ("string", "AED"), "opened_date": ("date", TODAY),
    },
    "transactions": {
        "transaction_id": ("string", "TXN00000000000001"), "card_id": ("string", "CARD000001"),
        "customer_id": ("string", "CUST000001"), "_matched_customer_id": ("string", "CUST000001"),
        "account_id": ("string", "ACC0000001"), "_matched_account_id": ("string", "ACC0000001"),
        "transaction_amount": ("decimal(18,2)", Decimal("0.01")), "transaction_timestamp": ("timestamp", NOW),
        "transaction_status": ("string", "APPROVED"), "auth_code": ("string", "AUTH000001"),
        "account_currency": ("string", "AED"), "city": ("string", "DUBAI"), "mcc_code": ("int", 5411),
        "merchant": ("string", "M"),
    },
    "swipes": {
        "swipe_id": ("string", str(uuid.UUID(int=5))), "card_id": ("string", "CARD000001"),
        "customer_id": ("string", "CUST000001"), "_matched_customer_id": ("string", "CUST000001"),
        "account_id": ("string", "ACC0000001"), "_matched_account_id": ("string", "ACC0000001"),
        "country": ("string", "AE"), "card_swipe_amount": ("decimal(18,2)", Decimal("5")),
        "swipe_timestamp": ("timestamp", NOW), "swipe_card_currency": ("string", "AED"), "city": ("string", "DUBAI"),
        "mcc_code": ("int", 5411), "merchant": ("string", "M"),
    },
    "sanctions": {
        "entry_id": ("string", "SANC0001"), "name": ("string", "Ali"), "entity_type": ("string", "INDIVIDUAL"),
        "list_source": ("string", "UN Consolidated List"),
    },
}
STAMPS = {
    "adf_run_id": ("string", "r1"),
    "_ingested_at": ("timestamp", NOW),
    "source_file": ("string", "f"),
}
CUSTOMER = "INVALID_CUSTOMER_ID"

# (domain, changed columns, codes that must fire)
BAD = [
    ("customers", {"customer_id": None}, ["INVALID_CUSTOMER_ID_FORMAT"]),
    ("customers", {"customer_id": "CUST0000011"}, ["INVALID_CUSTOMER_ID_FORMAT"]),
    ("customers", {"full_name": " "}, ["FULL_NAME_IS_NOT_PROVIDED"]),
    ("customers", {"emirates_id": None}, ["EMIRATES_ID_NOT_PROVIDED"]),
    ("customers", {"emirates_id": ""}, ["EMIRATES_ID_NOT_PROVIDED", "INVALID_EMIRATES_ID_FORMAT"]),
    ("customers", {"emirates_id": "7841990"}, ["INVALID_EMIRATES_ID_FORMAT"]),
    ("customers", {"nationality": None}, ["NATIONALIITY_IS_NOT_PROVIDED"]),
    ("customers", {"date_of_birth": None}, ["DATE_OF_BIRTH_NOT_PROVIDED"]),
    ("customers", {"date_of_birth": TOMORROW}, ["DATE_OF_BIRTH_IN_FUTURE", "ACCOUNT_OPENED_DATE_BEFORE_DOB"]),
    ("customers", {"account_opened_date": None}, ["ACCOUNT_OPENED_DATE_NOT_PROVIDED"]),
    ("customers", {"account_opened_date": TOMORROW}, ["ACCOUNT_OPENED_DATE_IN_FUTURE"]),
    ("customers", {"account_opened_date": dt.date(1990, 1, 1)}, ["ACCOUNT_OPENED_DATE_BEFORE_DOB"]),
    ("customers", {"risk_tier": "NONE"}, ["INVALID_RISK_TIER"]),
    ("customers", {"email": "a@b.co.ae"}, ["INVALID_EMAIL_FORMAT"]),
    ("customers", {"phone": ""}, ["INVALID_PHONE_FORMAT"]),
    ("customers", {"adf_run_id": ""}, ["ADF_RUN_ID_IS_NOT_PROVIDED"]),
    ("customers", {"_ingested_at": None}, ["INGESTION_DATE_IS_NOT_PROVIDED"]),
    ("customers", {"email": None, "phone": None, "account_opened_date": PAST}, []),
    ("accounts", {"customer_id": "X", "_matched_customer_id": "X"}, ["INVALID_CUSTOMER_ID_FORMAT"]),
    ("accounts", {"customer_id": None, "_matched_customer_id": None}, ["INVALID_CUSTOMER_ID_FORMAT"]),
    ("accounts", {"_matched_customer_id": None}, ["CUSTOMER_NOT_FOUND"]),
    ("accounts", {"account_id": "BADID"}, ["INVALID_ACCOUNT_ID_FORMAT"]),
    ("accounts", {"account_type": "LOAN"}, ["INVALID_ACCOUNT_TYPE"]),
    ("accounts", {"account_status": None}, ["INVALID_ACCOUNT_STATUS"]),
    ("accounts", {"account_currency": "GBP"}, ["INVALID_ACCOUNT_CURRENCY"]),
    ("accounts", {"opened_date": None}, ["OPENED_DATE_REQUIRED"]),
    ("accounts", {"opened_date": TOMORROW}, ["OPENED_DATE_IN_FUTURE"]),
    ("accounts", {"adf_run_id": None}, ["INVALID_ADF_RUN_ID"]),
    ("accounts", {"_ingested_at": None}, ["INVALID_INGESTED_AT"]),
    ("transactions", {"transaction_id": "TXN1"}, ["INVALID_TRANSACTION_ID"]),
    ("transactions", {"card_id": None}, ["INVALID_CARD_ID"]),
    ("transactions", {"customer_id": "C"}, [CUSTOMER]),
    ("transactions", {"_matched_customer_id": None}, ["CUSTOMER_ID_DOES_NOT_EXIST"]),
    ("transactions", {"account_id": None, "_matched_account_id": None}, ["INVALID_ACCOUNT_ID"]),
    ("transactions", {"_matched_account_id": None}, ["ACCOUNT_ID_DOES_NOT_EXIST"]),
    ("transactions", {"transaction_amount": Decimal("0")}, ["INVALID_TRANSACTION_AMOUNT"]),
    ("transactions", {"transaction_timestamp": NOW + dt.timedelta(seconds=1)}, ["INVALID_TRANSACTION_TIMESTAMP"]),
    ("transactions", {"auth_code": None}, ["INVALID_AUTH_CODE"]),
    ("transactions", {"auth_code": None, "transaction_status": "DECLINED"}, []),
    ("transactions", {"transaction_status": "PENDING"}, ["INVALID_TRANSACTION_STATUS"]),
    ("transactions", {"city": None, "mcc_code": None, "account_currency": "GBP"}, []),
    ("swipes", {"swipe_id": "1"}, ["INVALID_SWIPE_ID"]),
    ("swipes", {"customer_id": None, "_matched_customer_id": None}, [CUSTOMER]),
    ("swipes", {"_matched_customer_id": None}, ["CUSTOMER_ID_DOES_NOT_EXIST"]),
    ("swipes", {"account_id": "A"}, ["INVALID_ACCOUNT_ID"]),
    ("swipes", {"_matched_account_id": None}, ["ACCOUNT_ID_DOES_NOT_EXIST"]),
    ("swipes", {"card_id": "CARD1"}, ["INVALID_CARD_ID"]),
    ("swipes", {"country": " "}, ["INVALID_COUNTRY"]),
    ("swipes", {"card_swipe_amount": None}, ["INVALID_CARD_SWIPE_AMOUNT"]),
    ("swipes", {"swipe_timestamp": None}, ["INVALID_TIMESTAMP"]),
    ("swipes", {"swipe_card_currency": "GBP"}, []),
    ("sanctions", {"entity_type": None}, ["INVALID_ENTITY_TYPE"]),
    ("sanctions", {"list_source": None}, ["INVALID_LIST_SOURCE"]),
    ("sanctions", {"name": None}, ["INVALID_NAME"]),
    ("sanctions", {"entry_id": "SANC001"}, ["INVALID_ENTRY_ID"]),
    ("sanctions", {"entity_type": "OTHER", "list_source": "Other"}, []),
]


def clock():
    return Clock(F.lit(NOW).cast("timestamp"))


def frame(spark, domain, changes):
    columns = {**GOOD[domain], **STAMPS}
    rows = [tuple({**{k: v for k, (_, v) in columns.items()}, **change}.values()) for change in changes]
    return spark.createDataFrame(rows, ", ".join(f"{k} {t}" for k, (t, _) in columns.items()))


@pytest.mark.parametrize("domain", RULES)
def test_rules(spark, domain):
    cases = [({}, [])] + [(change, codes) for d, change, codes in BAD if d == domain]
    df = frame(spark, domain, [c for c, _ in cases]).coalesce(1).withColumn("n", F.monotonically_increasing_id())
    found = quality.with_reasons(df, domain, clock()).orderBy("n").collect()
    assert [r.rejected_reasons for r in found] == [codes for _, codes in cases]


def test_every_code_is_covered():
    tested = {(d, code) for d, _, codes in BAD for code in codes}
    assert tested == {(d, rule.code) for d, rules in RULES.items() for rule in rules}
    assert sum(len(r) for r in RULES.values()) == 48
    assert sum(len(e) for e in EXPECTATIONS.values()) == 60


@pytest.mark.parametrize("domain", EXPECTATIONS)
def test_good_row_meets_all_expectations(spark, domain):
    metrics = quality.expectation_metrics(frame(spark, domain, [{}]), domain, clock()).collect()
    assert {(m.passed, m.failed, m.unknown) for m in metrics} == {(1, 0, 0)}
    assert [m.expectation for m in metrics] == [e.name for e in EXPECTATIONS[domain]]


def test_expectations_count_unknown(spark):
    rows = [{}, {"customer_id": None}, {"customer_id": "X"}, {"date_of_birth": None}]
    metrics = {m.expectation: (m.passed, m.failed, m.unknown)
               for m in quality.expectation_metrics(frame(spark, "customers", rows), "customers", clock()).collect()}
    assert metrics["valid_customer_id_format"] == (2, 1, 1)
    assert metrics["dob_not_in_future"] == (3, 0, 1)
    assert metrics["valid_full_name"] == (4, 0, 0)


def test_late_arrival_is_strictly_after_a_day(spark):
    rows = [(NOW, NOW + dt.timedelta(hours=24)), (NOW, NOW + dt.timedelta(hours=24, seconds=1)), (None, NOW)]
    df = spark.createDataFrame(rows, "transaction_timestamp timestamp, _ingested_at timestamp")
    assert [r[0] for r in df.select(quality.late_arrival()).collect()] == [False, True, None]
