"""The whole run over raw files: two runs, with a change, a delete and a return."""

import json
import os

import pytest
from pyspark.sql import functions as F

from riskflow.operators.history import END, START
from riskflow.operators.rules import Clock
from riskflow.plans.medallion import IngestError, Medallion
from riskflow.plans.silver import ACCOUNTS, CUSTOMERS, TRANSACTIONS

SWIPE = "0000000a-00bc-4000-8000-00000000000%d"


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def customers_csv(*rows):
    head = "customer_id,full_name,emirates_id,email,phone,nationality,date_of_birth,account_opened_date,risk_tier"
    return "\n".join([head, *rows]) + "\n"


ALI = 'cust-000001,ali khan,784199012345671,a@b.com,0501234567,ae,17/01/1991,2020-01-05,high'
SARA = 'CUST000002,Sara Lee,784-1990-1234567-2,,,India,1992-02-03,2021/05/06,low'
BAD = 'CUST3,No Id,784199012345671,a@b.com,0501234567,ae,17/01/1991,2020-01-05,high'


def transaction(n, account="ACC0000001", customer="CUST000001", **more):
    return {
        "transaction_id": f"TXN{n:014d}", "card_id": "CARD000001", "customer_id": customer, "account_id": account,
        "merchant": "shop", "mcc_code": "5411", "amount": "AED 10.50", "currency": "aed", "city": "dubai",
        "timestamp": "2024-01-01 10:00:00", "auth_code": "AUTH000001", "status": "approved", **more,
    }


def swipe(n, city, minute, **more):
    return json.dumps({
        "swipe_id": SWIPE % n, "account_id": "ACC0000001", "customer_id": "CUST000001", "card_id": "CARD000001",
        "amount": "5.00", "city": city, "country": "AE", "currency": "AED", "event_ts": f"2024-01-01 10:{minute:02d}:00",
        "merchant": "m", "mcc_code": "5411", "_flag_hint": True, **more,
    })


@pytest.fixture()
def landing(tmp_path):
    raw = tmp_path / "raw"
    write(raw / "customers" / "c1.csv", customers_csv(ALI, SARA, BAD))
    write(raw / "accounts" / "a1.csv", "account_id,customer_id,account_type,status,currency,opened_date\n"
          "ACC0000001,CUST000001,salary,active,aed,2020-02-01\nACC0000002,CUST000009,salary,active,aed,2020-02-01\n")  # fmt: skip
    write(raw / "transactions" / "t1.json", json.dumps([transaction(1), transaction(2, customer="CUST000077"), transaction(3, surprise="x")], indent=1))
    write(raw / "sanctions" / "s1.json", json.dumps([{
        "entry_id": "SANC0001", "name": "ali khan", "aliases": "[\"A K\"]", "date_of_birth": "1991-01-17",
        "nationality": "AE", "entity_type": "individual", "list_source": "UN Consolidated List"}]))
    lines = [swipe(1, "Dubai", 0), swipe(2, "Abu Dhabi", 2), swipe(2, "Abu Dhabi", 2), swipe(3, "Dubai", 30, account_id="ACC0000009")]
    write(raw / "swipes" / "s1.jsonl", "\n".join(lines) + "\n")
    sources = [
        {"source_folder": t, "source_file": "*", "file_format": f, "target_schema": "bronze", "target_table": t,
         "cluster_keys": [], "is_active": True}
        for t, f in [("customers", "csv"), ("accounts", "csv"), ("transactions", "json"), ("sanctions", "json")]
    ]
    sources[2]["cluster_keys"] = ["city", "no_such_column"]
    sources.append({**sources[0], "source_folder": "closed", "is_active": False})
    write(tmp_path / "control.json", json.dumps(sources, indent=1))
    return tmp_path


def medallion(spark, landing, run):
    return Medallion(spark, str(landing / "lake"), run, Clock(F.lit("2024-06-01 00:00:00").cast("timestamp")), timeout=600)


def run(spark, landing, name):
    m = medallion(spark, landing, name)
    m.run(str(landing / "control.json"), str(landing / "raw"), str(landing / "raw" / "swipes"), str(landing / "archive"))
    return m


def test_two_runs(spark, landing):
    m = run(spark, landing, "r1")
    lake = m.lake

    rejected = m.rejected(CUSTOMERS).collect()
    assert [r.rejected_reasons for r in rejected] == [["INVALID_CUSTOMER_ID_FORMAT"]]
    assert m.rejected(ACCOUNTS).first().rejected_reasons == ["CUSTOMER_NOT_FOUND"]
    assert m.rejected(TRANSACTIONS).first().rejected_reasons == ["CUSTOMER_ID_DOES_NOT_EXIST"]
    bronze = spark.read.parquet(lake.path("bronze", "transactions"))
    assert [r.surprise for r in bronze.where("surprise is not null").collect()] == ["x"]
    metrics = {r.expectation: (r.passed, r.failed) for r in lake.read("monitoring", "dq_swipes", "r1").collect()}
    assert metrics["valid_card_id"] == (2, 0)

    hit = lake.read("gold", "dim_sanction_hits", "r1").first()
    assert (hit.customer_id, hit.entry_id) == ("CUST000001", "SANC0001")
    alerts = lake.read("gold", "sanction_alerts_transactions", "r1")
    assert {r.transaction_id for r in alerts.collect()} == {f"TXN{1:014d}", f"TXN{3:014d}"}
    assert m.swipes.read("silver_card_swipes").count() == 2
    assert m.swipes.read("rejected_card_swipes").first().rejected_reasons == ["ACCOUNT_ID_DOES_NOT_EXIST"]
    assert m.swipes.read("fraud_alerts").count() == 2
    assert m.swipes.read("sanction_alerts_swipes").count() == 2
    both = lake.read("gold", "all_alerts", "r1")
    assert {r.alert_type for r in both.collect()} == {"risk_hint"}  # the velocity window is still open

    history = lake.history("silver", "dim_customers")
    assert history.where(F.col(END).isNull()).count() == 2

    # Second run: a new tier, one more customer row, and a swipe that closes the window.
    write(landing / "raw" / "customers" / "c2.csv", customers_csv(ALI.replace("high", "low")))
    write(landing / "raw" / "swipes" / "s2.jsonl", swipe(4, "Dubai", 59) + "\n")
    second = run(spark, landing, "r2")
    history = second.lake.history("silver", "dim_customers")
    versions = {(r.customer_id, r.risk_tier, r[START] is not None, r[END] is not None) for r in history.collect()}
    assert versions == {
        ("CUST000001", "HIGH", True, True),
        ("CUST000001", "LOW", True, False),
        ("CUST000002", "LOW", True, False),
    }
    velocity = second.swipes.read("velocity_alerts").collect()
    assert [(r.swipe_count, r.distinct_city_count) for r in velocity] == [(2, 2)]
    assert second.swipes.read("fraud_alerts").count() == 3  # a LOW tier with hint scores exactly 0.5

    moved = list((landing / "archive" / "customers").glob("20??/??/??/**/c1.csv"))
    assert len(moved) == 1 and not (landing / "raw" / "customers" / "c1.csv").exists()
    assert second.unknown_keys == {"transactions": ["no_such_column"]}

    log = {(r.RunId, r.PipelineName, r.Status) for r in second.lake.run_log().collect()}
    assert ("r1", "master", "Succeeded") in log and ("r2", "gold", "Succeeded") in log


def test_one_bad_source_fails_the_step_but_not_the_others(spark, landing):
    control = json.loads((landing / "control.json").read_text())
    control[0]["file_format"] = "xml"
    write(landing / "control.json", json.dumps(control))
    m = medallion(spark, landing, "r1")
    with pytest.raises(IngestError, match="customers"):
        m.ingest(str(landing / "control.json"), str(landing / "raw"))
    assert spark.read.parquet(m.lake.path("bronze", "accounts")).count() == 2
    assert m.lake.finished_runs("ingest") == []


def test_source_without_files_is_skipped(spark, landing):
    control = json.loads((landing / "control.json").read_text())
    control[0]["source_folder"] = "nothing_here"
    write(landing / "control.json", json.dumps(control))
    results = medallion(spark, landing, "r1").ingest(str(landing / "control.json"), str(landing / "raw"))
    assert [r.table for r in results if r.skipped] == ["customers"]


def versions(lake):
    history = lake.history("silver", "dim_customers").collect()
    return sorted((r.customer_id, r.risk_tier, r[END] is not None) for r in history)


def test_history_survives_a_retry(spark, landing):
    control, raw = str(landing / "control.json"), str(landing / "raw")
    first = medallion(spark, landing, "r0")
    first.run(control, raw)
    write(landing / "raw" / "customers" / "c2.csv", customers_csv(ALI.replace("high", "low")))
    second = medallion(spark, landing, "r1")
    second.ingest(control, raw)
    second.silver()
    want = [("CUST000001", "HIGH", True), ("CUST000001", "LOW", False), ("CUST000002", "LOW", False)]
    assert versions(second.lake) == want
    # Gold failed: the run's silver step is taken again, by the same process and by another one.
    second.silver()
    assert versions(second.lake) == want
    third = medallion(spark, landing, "r1")
    third.silver()
    third.gold()
    assert versions(third.lake) == want
    assert third.lake.finished_runs("silver") == ["r0", "r1"]
    assert third.lake.read("gold", "dim_customers", "r1").count() == 3


def test_a_log_that_cannot_be_read_is_no_empty_log(spark, landing):
    m = medallion(spark, landing, "r1")
    assert m.lake.finished_runs("silver") == []
    write(landing / "lake" / "monitoring" / "run_log" / "part-0.parquet", "no parquet")
    with pytest.raises(Exception):
        m.lake.finished_runs("silver")


def test_any_source_of_the_control_table(spark, landing):
    control = json.loads((landing / "control.json").read_text())
    control = [{**control[0], "source_folder": "branches", "target_table": "branches", "target_schema": "extra"}]
    write(landing / "control.json", json.dumps(control))
    write(landing / "raw" / "branches" / "b.csv", "branch_id,city\n7,Dubai\n")
    m = medallion(spark, landing, "r1")
    m.ingest(str(landing / "control.json"), str(landing / "raw"))
    row = spark.read.parquet(m.lake.path("extra", "branches")).first()
    assert (row.branch_id, row.city, row.adf_run_id) == ("7", "Dubai", "r1")
