"""What the plans must look like to hold at scale, and that hot keys are split."""

import contextlib

import pytest
from pyspark.sql import functions as F

from riskflow.operators import alerts, history, monitoring, quality, watchlist
from riskflow.operators.dedup import latest_per_key


@contextlib.contextmanager
def conf(spark, **settings):
    names = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


SPLIT_EARLY = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "1KB",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "64KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
}


def executed(df) -> str:
    """The plan as it ran, after adaptive changes."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def facts(spark):
    """One customer owns half of the rows, a tenth have none."""
    key = F.when(F.col("id") % 2 == 0, F.lit("hot")).when(F.col("id") % 10 == 1, None).otherwise(F.col("id").cast("string"))
    return spark.range(0, 40000, 1, 8).select(
        "id", key.alias("customer_id"), F.sha2(F.col("id").cast("string"), 512).alias("payload")
    )


@pytest.fixture()
def customers(spark):
    known = spark.range(0, 40000, 3, 4).select(F.col("id").cast("string").alias("customer_id"), F.lit("HIGH").alias("risk_tier"))
    return known.union(spark.createDataFrame([("hot", "LOW")], "customer_id string, risk_tier string"))


def test_reference_check_splits_a_hot_key(spark, facts, customers):
    with conf(spark, **SPLIT_EARLY):
        checked = quality.with_reference(facts, customers, "customer_id")
        plan = executed(checked)
        assert "SortMergeJoin(skew=true)" in plan
        rows = checked.agg(F.count("*"), F.count("_matched_customer_id")).first()
    assert rows[0] == 40000
    matched = facts.where("customer_id = 'hot' OR (customer_id IS NOT NULL AND id % 3 = 0)").count()
    assert rows[1] == matched


def test_risk_join_splits_a_hot_key(spark, facts, customers):
    swipes = facts.withColumnRenamed("id", "swipe_id").withColumn("_flag_hint", F.lit(True))
    with conf(spark, **SPLIT_EARLY):
        joined = alerts.join_risk(swipes, customers)
        assert "SortMergeJoin(skew=true)" in executed(joined)


def test_sanction_activity_splits_a_hot_customer(spark, facts):
    hits = spark.createDataFrame([("hot", "n", "S1", "UN"), ("hot", "n", "S2", "UN")], "customer_id string, full_name string, entry_id string, list_source string")
    activity = facts.select("customer_id", F.col("id").alias("transaction_id"), F.col("payload").alias("account_id"))
    with conf(spark, **SPLIT_EARLY):
        found = watchlist.alerts_on_transactions(hits, activity)
        assert "skew=true" in executed(found)
        assert found.count() == 40000


def test_small_dimension_is_broadcast_and_large_is_not(spark, facts, customers, tmp_path):
    customers.write.parquet(f"{tmp_path}/c")
    dimension = spark.read.parquet(f"{tmp_path}/c")
    assert "BroadcastHashJoin" in executed(quality.with_reference(facts, dimension, "customer_id"))
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="1KB"):
        assert "SortMergeJoin" in executed(quality.with_reference(facts, dimension, "customer_id"))


def test_latest_limits_before_and_after_the_shuffle(spark, facts):
    plan = planned(latest_per_key(facts, ["customer_id"], ["id"]))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.count("Exchange") == 1


def test_latest_sends_one_hot_row_per_task(spark, facts):
    """20000 copies of the hot key leave eight map tasks as eight rows."""
    keyed = facts.where("customer_id = 'hot'")
    latest = latest_per_key(keyed, ["customer_id"], ["id"])
    assert latest.first().id == 39998
    latest.collect()
    plan = latest._jdf.queryExecution().executedPlan()
    shuffle = plan.executedPlan()
    while not shuffle.nodeName().startswith("ShuffleQueryStage"):
        shuffle = shuffle.plan() if "QueryStage" in shuffle.nodeName() else shuffle.children().head()
    written = shuffle.plan().metrics().get("shuffleRecordsWritten").get().value()
    assert written == 8


def test_velocity_counts_partially_before_each_shuffle(spark):
    swipes = spark.range(1).selectExpr("cast(id AS string) customer_id", "'x' city", "current_timestamp() swipe_timestamp")
    plan = planned(alerts.velocity(swipes))
    assert plan.count("partial_count") == 2 and plan.count("Exchange") == 2
    assert "collect_set" not in plan and "ObjectHashAggregate" not in plan


def test_metrics_send_one_row_per_task(spark):
    from riskflow.operators.rules import EXPECTATIONS

    columns = {"entry_id", "name", "entity_type", "list_source", "source_file", "adf_run_id", "_ingested_at"}
    df = spark.range(1).select(*[F.lit("x").alias(c) for c in columns])
    plan = planned(quality.expectation_metrics(df, "sanctions"))
    assert plan.count("Exchange SinglePartition") == 1 and "partial_count_if" in plan or "partial_count" in plan
    assert len(EXPECTATIONS["sanctions"]) == 7


def test_incremental_history_is_one_join(spark):
    current = spark.createDataFrame([], "k string, v string, __START_AT int, __END_AT int")
    snapshot = spark.createDataFrame([], "k string, v string")
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        plan = planned(history.scd2_changes(current, snapshot, ["k"], F.lit(1)))
    assert plan.count("Join") == 1 and "FullOuter" in plan


def test_scans_read_only_needed_columns(spark):
    folder = "/root/testdata/sf0.001"
    events = spark.read.parquet(f"{folder}/events.parquet").selectExpr(
        "event_id swipe_id", "user_id customer_id", "event_type city", "ts swipe_timestamp", "props", "value"
    )
    plan = planned(alerts.velocity(events).where("customer_id = 3"))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan
    assert "EqualTo(user_id,3)" in plan


def test_late_runs_combine_per_run(spark):
    runs = spark.createDataFrame([], "RunId string, PipelineName string, Status string, Start timestamp, TimeGenerated timestamp")
    plan = planned(monitoring.late_runs(runs))
    assert "partial_max_by" in plan and plan.count("Exchange") == 1
