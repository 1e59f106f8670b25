"""Streams over files: results equal batch, late data, bounded and exact deduplication."""

import datetime as dt

from pyspark.sql import functions as F

from riskflow.operators import alerts, quality
from riskflow.operators.dedup import EVENT_DAY, late_rows, near_days, stream_dedup, with_event_day
from riskflow.sources.readers import stream_table
from riskflow.sources.writers import append_available_now
from riskflow.streaming.flows import SwipeFlows, append_late

SCHEMA = "customer_id string, city string, swipe_id string, swipe_timestamp timestamp"
START = dt.datetime(2024, 1, 1, 10)


class Feed:
    """Batches of rows that arrive one after another."""

    def __init__(self, spark, root):
        self.spark, self.root, self.n = spark, root, 0

    def arrive(self, *rows):
        rows = [(c, city, s, START + dt.timedelta(minutes=m)) for c, city, s, m in rows]
        self.n += 1
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{self.root}/in/b={self.n}")

    def all(self):
        return self.spark.read.schema(SCHEMA).parquet(f"{self.root}/in").drop("b")

    def accept(self):
        """Accepted rows in folders by event day."""
        out = with_event_day(stream_dedup(stream_table(self.spark, f"{self.root}/in", self.all().schema)))
        append_available_now(out, f"{self.root}/accepted", f"{self.root}/_accepted", [EVENT_DAY], 300)
        return self.spark.read.schema(out.schema).parquet(f"{self.root}/accepted")

    def late(self, accepted):
        append_late(stream_table(self.spark, f"{self.root}/in", self.all().schema), accepted, f"{self.root}/late", f"{self.root}/_late", 300)
        return self.spark.read.schema(accepted.schema).parquet(f"{self.root}/late")

    def run(self, transform, name="out"):
        stream = stream_table(self.spark, f"{self.root}/in", self.all().schema)
        out = transform(stream)
        append_available_now(out, f"{self.root}/{name}", f"{self.root}/_{name}", timeout=300)
        return self.spark.read.schema(out.schema).parquet(f"{self.root}/{name}")


def windows(df):
    return {(r.customer_id, r.window_start, r.swipe_count, r.distinct_city_count) for r in df.collect()}


def test_velocity_stream_equals_batch_for_closed_windows(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.arrive(("A", "Dubai", "1", 0), ("A", "Ajman", "2", 2), ("B", "Dubai", "3", 1))
    assert windows(feed.run(alerts.velocity)) == set()  # no window has closed yet
    feed.arrive(("A", "Sharjah", "4", 4), ("B", "Ajman", "5", 3), ("C", None, "6", 8), ("C", "Dubai", "7", 9))
    feed.run(alerts.velocity)
    feed.arrive(("Z", "Dubai", "9", 60))
    result = windows(feed.run(alerts.velocity))
    closed = windows(alerts.velocity(feed.all().where(F.col("swipe_timestamp") < START + dt.timedelta(minutes=50))))
    assert result == closed == {("A", START, 3, 3), ("B", START, 2, 2)}


def test_late_swipe_is_dropped(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.arrive(("A", "Dubai", "1", 0), ("Z", "Dubai", "2", 60))
    feed.run(alerts.velocity)
    feed.arrive(("A", "Ajman", "3", 1), ("Z", "Dubai", "4", 120))
    assert windows(feed.run(alerts.velocity)) == set()


def ids(df):
    return sorted(r.swipe_id for r in df.collect())


def test_dedup_within_watermark_and_exact(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    day = 24 * 60
    batches = [
        [("A", "x", "1", 0), ("A", "y", "1", 1), ("A", "x", "2", 5)],
        [("A", "x", "1", 10), ("A", "x", "3", 3 * day)],
        [("A", "x", "4", 3 * day + 1)],
        [("A", "x", "1", 3 * day + 5), ("A", "x", "3", 3 * day + 6)],
    ]
    for batch in batches:
        feed.arrive(*batch)
        bounded = feed.run(stream_dedup, "bounded")
        single = feed.run(lambda s: stream_dedup(s, spread=1), "single")
        exact = feed.run(lambda s: stream_dedup(s, exact=True), "exact")
    assert ids(exact) == ["1", "2", "3", "4"]
    assert ids(bounded) == ids(single) == ["1", "1", "2", "3", "4"]  # swipe 1 came back after its day had passed


def test_no_swipe_disappears(spark, tmp_path):
    """Accepted, late and copies are the whole input, over several batches and runs."""
    feed = Feed(spark, tmp_path)
    day = 24 * 60
    batches = [
        [("A", "x", "1", 10 * day), ("A", "x", "1", 10 * day + 1), ("A", "x", "2", 10 * day)],
        [("A", "x", "3", day), ("A", "x", "4", 10 * day + 2)],
        [("A", "x", "5", 2 * day), ("A", "x", "5", 2 * day), ("A", "x", "1", 10 * day + 3), ("A", "x", "6", 11 * day)],
    ]
    for batch in batches:
        feed.arrive(*batch)
        accepted = feed.accept()
        late = feed.late(accepted)
        exact = feed.run(lambda s: stream_dedup(s, exact=True), "exact")
    assert ids(accepted) == ["1", "2", "4", "6"] and ids(late) == ["3", "5"]
    assert ids(exact) == ["1", "2", "3", "4", "5", "6"]
    copies = feed.all().join(accepted.select("swipe_id").unionByName(late.select("swipe_id")), "swipe_id", "left_semi").count()
    assert copies == feed.all().count()


def test_a_late_row_delivered_again_is_kept_once(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    day = 24 * 60
    batches = [
        [("A", "x", "1", 10 * day)],
        [("A", "x", "3", day), ("A", "x", "3", day + 1), ("A", "y", "3", day)],
        [("A", "x", "3", day), ("A", "x", "4", day + 5)],
        [("A", "x", "4", day + 6), ("A", "x", "1", 10 * day), ("A", "x", "3", 5 * day)],
    ]
    for batch in batches:
        feed.arrive(*batch)
        late = feed.late(feed.accept())
    # A row of the same key days later is another event, not a copy.
    assert sorted((r.swipe_id, r.swipe_timestamp.day) for r in late.collect()) == [("3", 2), ("3", 6), ("4", 2)]


def test_late_rows_read_the_days_around_the_batch_only(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    day = 24 * 60
    feed.arrive(*[("A", "x", str(i), i * day) for i in range(30)])
    accepted = feed.accept()
    batch = spark.createDataFrame([("A", "x", "new", START + dt.timedelta(days=12))], SCHEMA)
    found = late_rows(batch, accepted)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [event_day" in plan and "2024-01-12,2024-01-13,2024-01-14" in plan.replace(" ", "")
    read = accepted.where(F.col("event_day").isin(near_days(batch, "swipe_timestamp"))).select("_metadata.file_path").distinct().count()
    assert ids(found) == ["new"] and read == 3


def test_counts_of_a_repeated_batch_count_once(spark, tmp_path):
    flows = SwipeFlows(spark, str(tmp_path), timeout=300)
    columns = {c: F.lit("x") for c in ("card_id", "customer_id", "account_id", "city", "country", "swipe_card_currency", "merchant", "source_file", "adf_run_id")}
    rows = spark.range(10).select(
        F.col("id").cast("string").alias("swipe_id"), *[v.alias(c) for c, v in columns.items()], F.lit(5).alias("mcc_code"),
        F.lit(1).cast("decimal(18,2)").alias("card_swipe_amount"), F.current_timestamp().alias("swipe_timestamp"), F.current_timestamp().alias("_ingested_at"),
    )
    flows.store_counts(rows, 0)
    flows.store_counts(rows.where("id < 4"), 1)
    flows.store_counts(rows.where("id < 4"), 1)
    got = {r.expectation: (r.passed, r.failed, r.unknown) for r in flows.metrics().collect()}
    assert got["valid_card_swipe_amount"] == (14, 0, 0) and got["valid_mcc_code"] == (0, 14, 0)


def test_hot_key_is_spread_before_the_final_step(spark, tmp_path):
    rows = [("A", "x", "hot" if i % 3 == 0 else str(i), i % 50) for i in range(3000)]
    frame = spark.createDataFrame([(c, t, s, START + dt.timedelta(minutes=m)) for c, t, s, m in rows], SCHEMA)
    frame.repartition(16).write.parquet(f"{tmp_path}/in")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 * 1024 * 1024))  # one task per file
    try:
        out = stream_dedup(stream_table(spark, f"{tmp_path}/in"))
        query = append_available_now(out, f"{tmp_path}/out", f"{tmp_path}/cp", timeout=300)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    result = spark.read.parquet(f"{tmp_path}/out")
    assert result.count() == result.select("swipe_id").distinct().count() == 2001
    first = next(p for p in query.recentProgress if p.numInputRows)
    states = {s.operatorName: s.numRowsUpdated for s in first.stateOperators}
    updated = sorted(s.numRowsUpdated for s in first.stateOperators)
    # 2000 single keys; of the 1000 copies at most eight per input spread reach the last step.
    assert updated[0] == 2001 and 2001 < updated[1] <= 2008, states


def test_stateless_streams_run_adaptively(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.arrive(("A", "x", "1", 0))
    customers = spark.createDataFrame([("A", "HIGH")], "customer_id string, risk_tier string")
    stream = stream_table(spark, f"{tmp_path}/in", feed.all().schema).withColumn("_flag_hint", F.lit(True))
    query = append_available_now(
        alerts.fraud_score(alerts.join_risk(stream, customers)), f"{tmp_path}/o", f"{tmp_path}/c", timeout=300
    )
    plan = query._jsq.explainInternal(False)
    assert "AdaptiveSparkPlan" in plan


def test_stream_reports_expectations(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.arrive(("A", "x", "1", 0), ("B", "", "2", 0), ("C", None, "3", 0))
    stream = stream_table(spark, f"{tmp_path}/in", feed.all().schema).select(
        F.lit("SANC0001").alias("entry_id"), F.col("city").alias("name"), F.lit("INDIVIDUAL").alias("entity_type"),
        F.lit("Other").alias("list_source"), F.lit("f").alias("source_file"), F.lit("r").alias("adf_run_id"),
        F.col("swipe_timestamp").alias("_ingested_at"),
    )
    query = append_available_now(
        quality.observe_expectations(stream, "sanctions", "dq"), f"{tmp_path}/o", f"{tmp_path}/c", timeout=300
    )
    metrics = query.recentProgress[0].observedMetrics["dq"]
    assert (metrics["total"], metrics["valid_name"], metrics["valid_list_source"], metrics["valid_entry_id"]) == (3, 2, 3, 0)


def test_swipe_queries_show_what_the_flow_stamps():
    from workload.oracles import ORACLES, outputs

    for name in ("stream_swipes_valid", "stream_swipes_rejected"):
        shown = ORACLES[name].split(" FROM ")[0]
        assert [c for c in outputs("swipes") if c not in shown] == ["source_file"], name
