import datetime as dt

from pyspark.sql import functions as F

from riskflow.operators import quality
from riskflow.operators.dedup import latest_per_key
from riskflow.plans.silver import ACCOUNTS, CUSTOMERS, SANCTIONS, TRANSACTIONS

ACCOUNT = "account_id string, customer_id string, account_type string, account_status string, account_currency string, opened_date date, adf_run_id string, _ingested_at string, source_file string"


def account(**changes):
    row = {"account_id": "ACC1234567", "customer_id": "CUST123456", "account_type": "SAVINGS", "account_status": "ACTIVE",
           "account_currency": "AED", "opened_date": dt.date(2023, 1, 1), "adf_run_id": "RUN001",
           "_ingested_at": "2023-01-01T00:00:00", "source_file": "file1.csv"}
    return tuple({**row, **changes}.values())


def reasons(spark, row):
    customers = spark.createDataFrame([("CUST123456",)], "customer_id string")
    validated = ACCOUNTS.validate(spark.createDataFrame([row], ACCOUNT), {"customers": customers})
    return validated.first()["rejected_reasons"]


def test_valid_account_has_no_rejection(spark):
    assert reasons(spark, account()) == []


def test_invalid_account_id_is_rejected(spark):
    assert "INVALID_ACCOUNT_ID_FORMAT" in reasons(spark, account(account_id="BADID"))


def test_unknown_customer_is_rejected(spark):
    assert "CUSTOMER_NOT_FOUND" in reasons(spark, account(customer_id="CUST999999"))


def test_future_opening_is_rejected(spark):
    soon = dt.date.today() + dt.timedelta(days=10)
    assert "OPENED_DATE_IN_FUTURE" in reasons(spark, account(opened_date=soon))


def test_dimension_versions_do_not_multiply_rows(spark):
    accounts = spark.createDataFrame([account(), account(customer_id=None)], ACCOUNT)
    customers = spark.createDataFrame([("CUST123456",), ("CUST123456",), (None,)], "customer_id string")
    checked = quality.with_reference(accounts, customers, "customer_id")
    assert sorted(r._matched_customer_id or "" for r in checked.collect()) == ["", "CUST123456"]


VALIDATED = "account_id string, customer_id string, _ingested_at string, source_file string, rejected_reasons array<string>"


def test_latest_ingest_wins(spark):
    rows = [("ACC1234567", "CUST123456", "2023-01-01T00:00:00", "file1.csv", []),
            ("ACC1234567", "CUST123456", "2023-06-01T00:00:00", "file2.csv", [])]
    latest = ACCOUNTS.latest(spark.createDataFrame(rows, VALIDATED)).collect()
    assert [r.source_file for r in latest] == ["file2.csv"]


def test_rejected_newer_row_hides_nothing(spark):
    rows = [("A", "C", "2023-01-01", "f1", []), ("A", "C", "2023-06-01", "f2", ["X"])]
    validated = spark.createDataFrame(rows, VALIDATED)
    assert [r.source_file for r in ACCOUNTS.latest(validated).collect()] == ["f1"]
    assert [r.source_file for r in ACCOUNTS.rejected(validated).collect()] == ["f2"]


def test_rejected_returns_flagged_rows_only(spark):
    df = spark.createDataFrame([("A", []), ("B", ["X"])], "account_id string, rejected_reasons array<string>")
    out = ACCOUNTS.rejected(df)
    assert [(r.account_id, r.rejected_reasons) for r in out.collect()] == [("B", ["X"])]
    assert "rejected_at" in out.columns


def test_ties_are_decided_by_all_columns(spark):
    rows = [("A", "t", "f", i) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, _ingested_at string, source_file string, v int")
    assert {latest_per_key(df.repartition(n), ["k"]).first().v for n in (1, 3, 7)} == {49}


def test_sanction_rejects_are_one_per_key(spark):
    rows = [(None, "a", "2023-01-01", "f1"), (None, "b", "2023-02-01", "f2"), ("SANC0001", None, "2023-01-01", "f1")]
    df = spark.createDataFrame(rows, "entry_id string, name string, _ingested_at string, source_file string")
    df = df.withColumns({c: F.lit("x") for c in ("entity_type", "list_source")})
    rejected = SANCTIONS.rejected(quality.with_reasons(df, "sanctions")).collect()
    assert sorted((r.entry_id or "", r.source_file) for r in rejected) == [("", "f2"), ("SANC0001", "f1")]


def test_published_columns(spark):
    raw = "transaction_id,card_id,customer_id,account_id,merchant,mcc_code,amount,currency,city,timestamp,auth_code,status,_ingested_at,adf_run_id,source_file,_rescued_data"
    df = spark.createDataFrame([], ", ".join(f"{c} string" for c in raw.split(",")))
    known = {"customers": df.select("customer_id"), "accounts": df.select("account_id")}
    out = TRANSACTIONS.latest(TRANSACTIONS.validate(TRANSACTIONS.clean(df), known)).columns
    assert set(out) == {
        "transaction_id", "card_id", "customer_id", "account_id", "merchant", "mcc_code", "amount", "city", "auth_code",
        "_ingested_at", "adf_run_id", "source_file", "transaction_amount", "account_currency", "transaction_timestamp",
        "transaction_status", "is_late_arrival", "_silver_processed_at",
    }


def test_cleaning_is_not_expanded_into_the_filter(spark):
    """Rules read cleaned columns; the plan must clean each column once."""
    names = "customer_id,full_name,emirates_id,email,phone,nationality,date_of_birth,account_opened_date,risk_tier,adf_run_id,_ingested_at,source_file"
    df = spark.createDataFrame([], ", ".join(f"{c} string" for c in names.split(",")))
    plan = CUSTOMERS.latest(CUSTOMERS.validate(CUSTOMERS.clean(df)))._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not any("regexp_replace" in line for line in filters)
