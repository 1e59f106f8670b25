"""Silver from new rows only: each run reads its delivery, the stored state and the rejects that may have become valid."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskflow.operators.rules import Clock
from riskflow.plans.incremental import DomainState
from riskflow.plans.silver import ACCOUNTS, SANCTIONS, TRANSACTIONS
from riskflow.sources import readers, schemas
from riskflow.sources.ingest import BATCH
from riskflow.sources.lakehouse import FAILED, SUCCEEDED, Lakehouse

NOW = "2024-06-01 00:00:00"


def at(text):
    return Clock(F.lit(text).cast("timestamp"))


def transaction(n, **more):
    return {
        "transaction_id": f"TXN{n:014d}", "card_id": "CARD000001", "customer_id": "CUST000001", "account_id": "ACC0000001",
        "merchant": "shop", "mcc_code": "5411", "amount": "10.50", "currency": "aed", "city": "dubai",
        "timestamp": "2024-01-01 10:00:00", "auth_code": "AUTH000001", "status": "approved", **more,
    }


def account(n, **more):
    return {"account_id": f"ACC{n:07d}", "customer_id": "CUST000001", "account_type": "salary", "status": "active",
            "currency": "aed", "opened_date": "2023-01-01", **more}


class Deliveries:
    def __init__(self, spark, root, domain):
        self.spark, self.root, self.domain, self.batches = spark, str(root), domain, 0

    def land(self, rows, ingested="2024-05-01 00:00:00"):
        schema = readers.bronze_schema(schemas.FEEDS[self.domain.name])
        stamps = {"_ingested_at": dt.datetime.fromisoformat(ingested), "source_file": "f.csv", "adf_run_id": "r"}
        data = [tuple({**r, **stamps}.get(c) for c in schema.names) for r in rows]
        path = f"{self.root}/bronze/{self.domain.name}/{BATCH}={self.batches}"
        self.spark.createDataFrame(data, schema).write.parquet(path)
        self.batches += 1

    def run(self, name, clock=NOW, status=SUCCEEDED, **references):
        lake = Lakehouse(self.spark, self.root, name)
        state = DomainState(lake, self.domain, at(clock))
        lake.begin("silver")
        frames = {d: self.spark.createDataFrame([(k,) for k in keys], f"{self.domain.references[d]} string") for d, keys in references.items()}
        newest = state.advance(frames)
        lake.report("silver", status)
        return state, newest


def reasons(state):
    return sorted((r[state.domain.key], *r.rejected_reasons) for r in state.rejected().collect())


@pytest.fixture()
def transactions(spark, tmp_path):
    return Deliveries(spark, tmp_path, TRANSACTIONS)


def ids(newest):
    return sorted(int(r.transaction_id[3:]) for r in newest.collect())


def test_a_reject_becomes_valid_when_its_keys_arrive(transactions):
    d = transactions
    d.land([transaction(1), transaction(2, customer_id="CUST000002", account_id="ACC0000002"), transaction(3, status="odd")])
    state, newest = d.run("r1", customers=["CUST000001"], accounts=["ACC0000001"])
    assert ids(newest) == [1]
    late = ("TXN00000000000002", "CUSTOMER_ID_DOES_NOT_EXIST", "ACCOUNT_ID_DOES_NOT_EXIST")
    assert reasons(state) == [late, ("TXN00000000000003", "INVALID_TRANSACTION_STATUS")]
    # One of its two keys: checked again, one reason less.
    state, newest = d.run("r2", customers=["CUST000001", "CUST000002"], accounts=["ACC0000001"])
    assert ids(newest) == [1] and reasons(state)[0] == ("TXN00000000000002", "ACCOUNT_ID_DOES_NOT_EXIST")
    state, newest = d.run("r3", customers=["CUST000001", "CUST000002"], accounts=["ACC0000001", "ACC0000002"])
    assert ids(newest) == [1, 2] and reasons(state) == [("TXN00000000000003", "INVALID_TRANSACTION_STATUS")]


def test_a_reject_of_time_becomes_valid_when_its_time_has_passed(transactions):
    d = transactions
    d.land([transaction(1, timestamp="2024-07-01 00:00:00"), transaction(2, timestamp=None)])
    known = {"customers": ["CUST000001"], "accounts": ["ACC0000001"]}
    assert ids(d.run("r1", **known)[1]) == []
    assert ids(d.run("r2", **known)[1]) == []
    state, newest = d.run("r3", clock="2024-07-02 00:00:00", **known)
    assert ids(newest) == [1] and reasons(state) == [("TXN00000000000002", "INVALID_TRANSACTION_TIMESTAMP")]


def test_newest_row_wins_over_deliveries(transactions):
    d = transactions
    known = {"customers": ["CUST000001", "CUST000002"], "accounts": ["ACC0000001"]}
    d.land([transaction(1, city="first"), transaction(2, city="newer")], "2024-05-02 00:00:00")
    d.run("r1", **known)
    d.land([transaction(1, city="second")], "2024-05-03 00:00:00")
    d.land([transaction(2, city="older"), transaction(1, city="bad", amount="0")], "2024-05-01 00:00:00")
    newest = d.run("r2", **known)[1]
    assert {int(r.transaction_id[3:]): r.city for r in newest.collect()} == {1: "SECOND", 2: "NEWER"}


def test_a_run_reads_its_batches_only(spark, transactions):
    d = transactions
    known = {"customers": ["CUST000001"], "accounts": ["ACC0000001"]}
    for i in range(3):
        d.land([transaction(i)])
        state, newest = d.run(f"r{i}", **known)
    assert ids(newest) == [0, 1, 2]
    d.land([transaction(3)])
    later = DomainState(Lakehouse(spark, d.root, "r3"), TRANSACTIONS, at(NOW))
    raw = later.delivery()
    assert {r[0] for r in raw.select(BATCH).distinct().collect()} == {3}
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({BATCH}" in plan and "> 2)" in plan
    # Nothing new: nothing read, nothing changed.
    lake = Lakehouse(spark, d.root, "r2")
    assert DomainState(lake, TRANSACTIONS, at(NOW)).last_batch() == 1  # what a retry of that run builds on


def test_a_failed_and_a_repeated_run_lose_and_double_nothing(transactions):
    d = transactions
    known = {"customers": ["CUST000001"], "accounts": ["ACC0000001"]}
    d.land([transaction(1), transaction(9, status="odd")])
    d.run("r1", **known)
    d.land([transaction(2), transaction(8, status="odd")])
    d.run("r2", status=FAILED, **known)
    state, newest = d.run("r2", **known)
    assert ids(newest) == [1, 2] and len(reasons(state)) == 2
    state, newest = d.run("r2", **known)
    assert ids(newest) == [1, 2] and len(reasons(state)) == 2
    state, newest = d.run("r3", **known)
    assert ids(newest) == [1, 2] and len(reasons(state)) == 2


def test_accounts_wait_for_customers(spark, tmp_path):
    d = Deliveries(spark, tmp_path, ACCOUNTS)
    d.land([account(1), account(2, customer_id="CUST000002"), account(3, customer_id=None)])
    state, newest = d.run("r1", customers=["CUST000001"])
    assert newest.count() == 1
    state, newest = d.run("r2", customers=["CUST000001", "CUST000002"])
    assert newest.count() == 2 and reasons(state) == [("ACC0000003", "INVALID_CUSTOMER_ID_FORMAT")]


def test_one_reject_per_key_over_deliveries(spark, tmp_path):
    d = Deliveries(spark, tmp_path, SANCTIONS)
    row = {"entry_id": "SANC0001", "name": "x", "aliases": "[]", "entity_type": "individual", "list_source": None}
    d.land([row, {**row, "entry_id": None}], "2024-05-01 00:00:00")
    d.run("r1")
    d.land([{**row, "name": None}, {**row, "entry_id": None, "name": "later"}], "2024-05-02 00:00:00")
    state, newest = d.run("r2")
    assert newest.count() == 0
    assert sorted((r.entry_id or "", r.name or "") for r in state.rejected().collect()) == [("", "Later"), ("SANC0001", "")]


def test_rows_go_from_bronze_to_every_outcome_without_a_shuffle(spark, transactions, monkeypatch):
    """Moving all rows for even files, and interpreting the rules, took most of the time of a run."""
    d, plans = transactions, {}
    publish = Lakehouse.publish

    def seen(lake, layer, table, df, *rest, balance=True, **layout):
        plans[table] = (balance, df._jdf.queryExecution().executedPlan().toString())
        return publish(lake, layer, table, df, *rest, balance=balance, **layout)

    monkeypatch.setattr(Lakehouse, "publish", seen)
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    known = {"customers": ["CUST000001"], "accounts": ["ACC0000001"]}
    for i in range(2):
        d.land([transaction(i), transaction(9 + i, customer_id="CUST000002")])
        d.run(f"r{i}", **known)
    for table in ("validated", "open", "closed_rejects", "open_rejects"):
        balance, plan = plans[f"{table}_transactions"]
        moved = [line for line in plan.splitlines() if "Exchange" in line and "BroadcastExchange" not in line]
        # The only rows that may move are keys of a dimension.
        assert not balance and all("_matched_" in line or "_id" in line for line in moved), (table, moved)
    assert not plans["newest_transactions"][0]
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_a_feed_is_dealt_to_as_many_tasks_as_asked(spark):
    from workload import feeds

    folder = "/root/testdata/sf0.001"
    plain, dealt = (feeds.as_spark(spark, folder, feeds.TRANSACTIONS, n) for n in (None, 5))
    held = dealt.select("transaction_id", F.spark_partition_id().alias("at")).distinct()
    assert held.select("at").distinct().count() == 5
    assert dealt.exceptAll(plain).isEmpty() and plain.exceptAll(dealt).isEmpty()
