import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskflow.operators import alerts, watchlist

START = dt.datetime(2024, 1, 1, 10)


def score(spark, tier, hint, customer="CUST001", kind="boolean"):
    swipes = spark.createDataFrame([("SW001", "CUST001", hint)], f"swipe_id string, customer_id string, _flag_hint {kind}")
    customers = spark.createDataFrame([(customer, tier)], "customer_id string, risk_tier string")
    return [(r.risk_score, r.hint_score, r.fraud_score) for r in alerts.fraud_score(alerts.join_risk(swipes, customers)).collect()]


@pytest.mark.parametrize(
    "tier,hint,expected",
    [
        ("HIGH", True, [(0.6, 0.4, 1.0)]),
        ("HIGH", False, [(0.6, 0.0, 0.6)]),
        ("HIGH", None, [(0.6, 0.0, 0.6)]),
        ("MEDIUM", True, [(0.3, 0.4, 0.7)]),
        ("MEDIUM", False, []),
        ("LOW", True, [(0.1, 0.4, 0.5)]),
        ("LOW", False, []),
        (None, True, [(0.1, 0.4, 0.5)]),
    ],
)
def test_fraud_score(spark, tier, hint, expected):
    assert score(spark, tier, hint) == expected


def test_unknown_customer_is_excluded(spark):
    assert score(spark, "HIGH", True, customer="CUST_UNKNOWN") == []


def test_hint_may_arrive_as_text(spark):
    assert score(spark, "LOW", "true", kind="string") == [(0.1, 0.4, 0.5)]
    assert score(spark, "LOW", "maybe", kind="string") == []


def velocity(spark, *swipes):
    rows = [("CUST001", city, START + dt.timedelta(minutes=m)) for city, m in swipes]
    df = spark.createDataFrame(rows, "customer_id string, city string, swipe_timestamp timestamp")
    return [(r.swipe_count, r.distinct_city_count, r.window_start) for r in alerts.velocity(df).collect()]


def test_two_cities_in_a_window(spark):
    assert velocity(spark, ("Dubai", 0), ("Abu Dhabi", 2)) == [(2, 2, START)]


def test_one_city_is_no_alert(spark):
    assert velocity(spark, ("Dubai", 0), ("Dubai", 1)) == []


def test_separate_windows_are_no_alert(spark):
    assert velocity(spark, ("Dubai", 0), ("Abu Dhabi", 10)) == []
    assert velocity(spark, ("Dubai", 4), ("Abu Dhabi", 6)) == []


def test_missing_city_counts_as_swipe_only(spark):
    assert velocity(spark, ("Dubai", 0), (None, 1)) == []
    assert velocity(spark, ("Dubai", 0), (None, 1), ("Ajman", 2)) == [(3, 2, START)]


def test_all_alerts_columns(spark):
    fraud = spark.createDataFrame([("s", "c", 0.6)], "swipe_id string, customer_id string, fraud_score double")
    fast = spark.createDataFrame([("c", 3)], "customer_id string, swipe_count bigint")
    out = alerts.all_alerts(fraud, fast)
    assert out.columns == ["swipe_id", "customer_id", "fraud_score", "alert_type", "swipe_count"]
    assert {(r.alert_type, r.swipe_id, r.swipe_count) for r in out.collect()} == {("risk_hint", "s", None), ("velocity", None, 3)}


def test_sanction_hits(spark):
    born = dt.date(1990, 1, 1)
    customers = spark.createDataFrame(
        [("C1", "Ali Alsayed", born, "AE"), ("C2", "Ali Alsayed", None, "AE"), ("C3", "Sara", born, "India")],
        "customer_id string, full_name string, date_of_birth date, nationality string",
    )
    entries = spark.createDataFrame(
        [("S1", "Ali Al-sayed", born, "ae", "UN"), ("S2", "Ali Alsayed", None, "AE", "UN"), ("S3", "Sara", born, "India", "EU")],
        "entry_id string, name string, date_of_birth date, nationality string, list_source string",
    )
    strict = watchlist.hits(customers, entries)
    assert strict.columns == ["hit_id", "customer_id", "full_name", "entry_id", "list_source"]
    assert {(r.customer_id, r.entry_id) for r in strict.collect()} == {("C3", "S3")}
    assert strict.first().hit_id == strict.select(F.sha2(F.lit("C3||S3"), 256)).first()[0]
    loose = watchlist.hits(customers, entries, normalise=True)
    assert {(r.customer_id, r.entry_id) for r in loose.collect()} == {("C1", "S1"), ("C3", "S3")}

    facts = spark.createDataFrame([("C3", "T1", "A1"), ("C3", "T2", "A1"), ("C1", "T3", "A2")], "customer_id string, transaction_id string, account_id string")
    found = watchlist.alerts_on_transactions(strict, facts)
    assert found.columns == ["customer_id", "full_name", "entry_id", "list_source", "transaction_id", "account_id"]
    assert {r.transaction_id for r in found.collect()} == {"T1", "T2"}
