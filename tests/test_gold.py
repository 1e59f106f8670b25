import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskflow.functions import masking
from riskflow.operators import calendar, monitoring
from riskflow.operators.rules import Clock
from riskflow.plans import gold

NOW = dt.datetime(2024, 6, 1, 12, 0, 30)


def clock():
    return Clock(F.lit(NOW).cast("timestamp"))


MASKED = [
    ("784-1990-1234567-1", "national_id", "***-67-1"),
    ("someone@bank.com", "email", "som***@***bank.com"),
    ("a@b.com", "email", "a@b***@***b.com"),
    ("noat", "email", "***MASKED***"),
    ("+971-50-123-4567", "phone", "+971******67"),
    ("12", "phone", "12******12"),
    ("x", "other", "***MASKED***"),
    (None, "email", None),
    (None, "phone", None),
]


@pytest.mark.parametrize("value,category,expected", MASKED)
def test_mask(spark, value, category, expected):
    df = spark.createDataFrame([(value, category)], "v string, c string")
    masking.register_mask(spark)
    row = df.select(
        masking.mask("v", category).alias("by_name"),
        masking.mask("v", F.col("c")).alias("by_column"),
        F.expr("governed_mask(v, c)").alias("by_sql"),
    ).first()
    assert tuple(row) == (expected, expected, expected)


def test_masked_view_follows_tags(spark):
    df = spark.createDataFrame([("i", "a@b.c", "0501234567", "n")], "emirates_id string, email string, phone string, name string")
    tagged = masking.tag(df).where("name = 'n'").select("name", "email", "phone")
    assert tuple(masking.masked_view(tagged, "analyst").first()) == ("n", "a@b***@***b.c", "0501******67")
    assert tuple(masking.masked_view(tagged, "data_engineers").first()) == ("n", "a@b.c", "0501234567")


def test_calendar(spark):
    days = calendar.dim_date(spark)
    assert days.count() == 4383
    row = days.where("date = date'2024-06-01'").first()
    assert tuple(row) == (20240601, dt.date(2024, 6, 1), 1, 6, "June", 2, 2024, True)
    assert days.where("date = date'2024-06-03'").first().is_weekend is False


def test_dim_customers(spark):
    df = spark.createDataFrame([("c", dt.date(2020, 1, 1))], "customer_id string, account_opened_date date")
    assert gold.dim_customers(df).columns == ["customer_id", "_gold_processed_at"]
    assert gold.fact_transactions(df).columns == ["customer_id", "account_opened_date", "_gold_processed_at"]


def test_recent_alerts(spark):
    times = [NOW - dt.timedelta(minutes=m) for m in [0, 59, 60, 61]] + [NOW]
    df = spark.createDataFrame([(t,) for t in times], "alert_timestamp timestamp")
    assert tuple(monitoring.recent_alert_count(df, clock(), threshold=2).first()) == (3, True)
    assert tuple(monitoring.recent_alert_count(df, clock()).first()) == (3, False)


RUNS = "RunId string, PipelineName string, Status string, Start timestamp, TimeGenerated timestamp"


def at(minutes, seconds=0):
    return NOW - dt.timedelta(minutes=minutes, seconds=-seconds)


def test_late_runs(spark):
    rows = [
        ("late", "ingest", "InProgress", at(30), at(29)), ("late", "ingest", "InProgress", at(30), at(1)),
        ("done", "ingest", "InProgress", at(30), at(29)), ("done", "ingest", "Succeeded", at(30), at(5)),
        ("in time", "silver", "InProgress", at(10), at(9)),
        ("boundary", "silver", "InProgress", at(11, 29), at(9)),  # 12:00 against 11:49: eleven boundaries
        ("other", "unknown", "InProgress", at(500), at(9)),
    ]
    late = monitoring.late_runs(spark.createDataFrame(rows, RUNS), clock=clock())
    assert {(r.RunId, r.RunningMinutes) for r in late.collect()} == {("late", 30), ("boundary", 11)}
    counts = monitoring.late_run_alerts(late).collect()
    assert {(r.PipelineName, r.late_runs) for r in counts} == {("ingest", 1), ("silver", 1)}


def test_late_runs_with_equal_times_do_not_depend_on_order(spark):
    rows = [("r", "ingest", "InProgress", at(30), at(5)), ("r", "ingest", "Succeeded", at(30), at(5)), ("s", "ingest", "InProgress", at(30), at(5))]
    for some in (rows, rows[::-1]):
        late = monitoring.late_runs(spark.createDataFrame(some, RUNS).coalesce(1), clock=clock())
        assert [r.RunId for r in late.collect()] == ["s"]


def test_sliding_breaches(spark):
    base = dt.datetime(2024, 6, 1, 10)
    rows = [("r", "gold", "Failed", base, base + dt.timedelta(minutes=m)) for m in (3, 12)]
    rows.append(("r", "gold", "Succeeded", base, base + dt.timedelta(minutes=4)))
    out = monitoring.sliding_breaches(monitoring.failed_runs(spark.createDataFrame(rows, RUNS)))
    assert {(r.window_start.strftime("%H:%M"), r.total) for r in out.collect()} == {("09:50", 1), ("10:00", 2), ("10:10", 1)}


def test_overtime_and_duration(spark):
    base = dt.datetime(2024, 6, 1, 10)
    rows = [(str(m), "silver", s, base, base + dt.timedelta(minutes=m)) for m, s in [(10, "Succeeded"), (11, "Succeeded"), (12, "InProgress"), (13, "Failed")]]
    assert {r.RunId for r in monitoring.overtime_runs(spark.createDataFrame(rows, RUNS)).collect()} == {"11", "13"}
    jobs = spark.createDataFrame([("bronze", 900), ("bronze", 901), ("gold", 700), ("none", 9999)], "job string, run_seconds bigint")
    found = monitoring.duration_breaches(jobs).collect()
    assert {(r.job, r.run_seconds, r.limit_seconds) for r in found} == {("bronze", 901, 900), ("gold", 700, 600)}


def test_latest_reports_do_not_depend_on_the_deliveries(spark):
    rows = [(f"r{i % 7}", "ingest", ["InProgress", "Failed", "Succeeded"][i % 3], at(30), at(30 - i // 2)) for i in range(40)]
    whole = {tuple(r) for r in monitoring.latest_reports(spark.createDataFrame(rows, RUNS)).collect()}
    assert len(whole) == 7
    for step in (1, 5, 13):
        stored = None
        for low in range(0, 40, step * 4):
            delivered = spark.createDataFrame(rows[low : low + step * 4], RUNS)
            stored = spark.createDataFrame(monitoring.latest_reports(delivered, stored).collect(), RUNS)
        assert {tuple(r) for r in stored.collect()} == whole
