"""Alert conditions over alert tables and the run log.

The run log has one row per status report of a run:
RunId, PipelineName, Status, Start, TimeGenerated.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.operators.rules import Clock

# Limits and windows of the alerts.
FRAUD_ALERTS_PER_HOUR = 50
RUN_LIMIT_MINUTES = {"ingest": 15, "silver": 10, "gold": 10, "master": 40}
JOB_LIMIT_SECONDS = {"bronze": 900, "silver": 600, "gold": 600}
LATE_CHECK = "5 minutes"
BREACH_WINDOW, BREACH_EVERY = "15 minutes", "10 minutes"


def _limit(name: str, limits: Mapping[str, int]) -> Column:
    """The limit of each name; NULL where none is set. A handful of literals."""
    pairs = [F.lit(x) for pair in limits.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), F.col(name))


def recent_alert_count(
    alerts: DataFrame, clock: Clock = Clock(), period: str = "1 HOUR", threshold: int = FRAUD_ALERTS_PER_HOUR
) -> DataFrame:
    """One row: number of alerts in the last hour, and whether that is too many."""
    recent = alerts.where(F.col("alert_timestamp") > clock.timestamp - F.expr(f"INTERVAL {period}"))
    return recent.agg(F.count(F.lit(1)).alias("fraud_count")).withColumn("breached", F.col("fraud_count") > threshold)


REPORT = ("RunId", "PipelineName", "Status", "Start", "TimeGenerated")


def latest_reports(runs: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """The latest report of every run (columns REPORT), of the ``stored`` latest ones and those delivered since.

    Storing the result keeps the state of all runs at one row each: a delivery is merged with it, and the log is not read again.
    It is an aggregate with map-side combine: a run with very many reports sends one row per task. Of reports at one instant a
    finished one is the later, then the greater status; the result does not depend on how the log was delivered.
    """
    reports = runs.select(*REPORT)
    if stored is not None:
        reports = reports.unionByName(stored.select(*REPORT))
    finished = F.col("Status") != "InProgress"
    order = F.struct("TimeGenerated", finished, "Status", "PipelineName", "Start")
    latest = reports.groupBy("RunId").agg(F.max_by(F.struct(*REPORT[1:]), order).alias("_last"))
    return latest.select("RunId", "_last.*")


def late_runs(
    runs: DataFrame, limits: Mapping[str, int] = RUN_LIMIT_MINUTES, clock: Clock = Clock()
) -> DataFrame:
    """Runs whose latest report says in progress and that exceed their limit. ``runs``: the whole log, or the stored latest
    reports.

    The latest report is picked first, so a finished run never shows up. Minutes count crossed minute boundaries.
    """

    def minute(c: Column) -> Column:
        return F.unix_timestamp(F.date_trunc("minute", c).cast("timestamp"))

    return (
        latest_reports(runs)
        .where(F.col("Status") == "InProgress")
        .withColumn("RunningMinutes", ((minute(clock.timestamp) - minute(F.col("Start"))) / 60).cast("bigint"))
        .where(F.col("RunningMinutes") > _limit("PipelineName", limits))
    )


def late_run_alerts(late: DataFrame, window: str = LATE_CHECK) -> DataFrame:
    """Number of late runs per pipeline and check interval; any is an alert."""
    return (
        late.groupBy("PipelineName", F.window("TimeGenerated", window).alias("window"))
        .agg(F.count(F.lit(1)).alias("late_runs"))
        .select("PipelineName", F.col("window.start").alias("window_start"), "late_runs")
    )


def failed_runs(runs: DataFrame) -> DataFrame:
    return runs.where(F.col("Status") == "Failed")


def overtime_runs(runs: DataFrame, limits: Mapping[str, int] = RUN_LIMIT_MINUTES) -> DataFrame:
    """Completed runs that took longer than their pipeline's limit in minutes."""
    took = F.unix_timestamp(F.col("TimeGenerated").cast("timestamp")) - F.unix_timestamp(F.col("Start").cast("timestamp"))
    return runs.where((F.col("Status") != "InProgress") & (took > 60 * _limit("PipelineName", limits)))


def sliding_breaches(
    events: DataFrame,
    name: str = "PipelineName",
    at: str = "TimeGenerated",
    window: str = BREACH_WINDOW,
    every: str = BREACH_EVERY,
    threshold: int = 0,
) -> DataFrame:
    """Events per name and sliding window, where there are more than ``threshold``."""
    return (
        events.groupBy(name, F.window(at, window, every).alias("window"))
        .agg(F.count(F.lit(1)).alias("total"))
        .where(F.col("total") > threshold)
        .select(name, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "total")
    )


def duration_breaches(
    runs: DataFrame, limits: Mapping[str, int] = JOB_LIMIT_SECONDS, job: str = "job", seconds: str = "run_seconds"
) -> DataFrame:
    """Runs longer than the health limit of their job."""
    return runs.withColumn("limit_seconds", _limit(job, limits)).where(F.col(seconds) > F.col("limit_seconds"))
