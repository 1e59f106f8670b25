"""Tables of a lakehouse as versioned Parquet folders, and the log of runs.

A table keeps one folder per run and attempt (``run=<id>/attempt=<id>``); what readers see is decided by the run log, so a
failed run leaves nothing behind that anyone reads, and no table is ever overwritten: a step that is run again writes new
folders, and its last attempt that succeeded counts.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.operators.history import END
from riskflow.sources.readers import is_missing
from riskflow.sources.writers import write_clustered, write_table

RUN_LOG = "RunId string, PipelineName string, Status string, Start timestamp, TimeGenerated timestamp, Attempt string"
# The step that writes a layer.
STEP = {"staging": "silver", "state": "silver", "silver": "silver", "monitoring": "silver", "gold": "gold"}
IN_PROGRESS, SUCCEEDED, FAILED = "InProgress", "Succeeded", "Failed"
OPEN, CLOSED = "open", "closed"


class Lakehouse:
    """``root`` must be storage that all executors share."""

    def __init__(self, spark: SparkSession, root: str, run_id: str):
        self.spark, self.root, self.run_id = spark, root.rstrip("/"), run_id
        self.started = datetime.now(timezone.utc)
        # Steps of this run that are under way or done, by their attempt.
        self.attempts: dict[str, str] = {}

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def begin(self, pipeline: str) -> None:
        """A new attempt of a step."""
        self.attempts[pipeline] = uuid.uuid4().hex

    def _run_path(self, layer: str, table: str, run: str) -> str:
        step = STEP.get(layer, layer)
        if run == self.run_id and step in self.attempts:
            attempt = self.attempts[step]
        else:
            attempt = self._succeeded(step).get(run, "none")
        return f"{self.path(layer, table)}/run={run}/attempt={attempt}"

    # -- run log --

    def report(self, pipeline: str, status: str) -> None:
        now = datetime.now(timezone.utc)
        row = [(self.run_id, pipeline, status, self.started, now, self.attempts.get(pipeline))]
        self.spark.createDataFrame(row, RUN_LOG).coalesce(1).write.mode("append").parquet(self.path("monitoring", "run_log"))

    def run_log(self) -> DataFrame:
        return self.spark.read.schema(RUN_LOG).parquet(self.path("monitoring", "run_log"))

    def _succeeded(self, pipeline: str) -> dict[str, str]:
        """The last succeeded attempt of each run of a step, runs in the order they first succeeded in. One row per run."""
        try:
            log = self.run_log().where((F.col("PipelineName") == pipeline) & (F.col("Status") == SUCCEEDED))
            runs = log.groupBy("RunId").agg(F.min("TimeGenerated").alias("first"), F.max_by("Attempt", "TimeGenerated").alias("attempt"))
            return {r.RunId: r.attempt for r in runs.orderBy("first", "RunId").collect()}
        except AnalysisException as e:
            if not is_missing(e):
                raise
            return {}

    def finished_runs(self, pipeline: str) -> list[str]:
        """Ids of succeeded runs, oldest first, each once."""
        return list(self._succeeded(pipeline))

    def other_runs(self, pipeline: str) -> list[str]:
        """Succeeded runs but this one: what a retry of this run builds on."""
        return [r for r in self.finished_runs(pipeline) if r != self.run_id]

    # -- tables --

    def publish(self, layer: str, table: str, df: DataFrame, cluster_by: Sequence[str] = (), **layout) -> DataFrame:
        """Store this run's version of a table and return it as stored."""
        path = self._run_path(layer, table, self.run_id)
        if cluster_by:
            write_clustered(df, path, cluster_by, curve=True)
        else:
            write_table(df, path, **layout)
        return self.spark.read.schema(df.schema).parquet(path)

    def read(self, layer: str, table: str, run: str) -> DataFrame:
        return self.spark.read.parquet(self._run_path(layer, table, run))

    def read_runs(self, layer: str, table: str) -> DataFrame:
        """What all succeeded runs and the present one wrote to a table that every run adds to."""
        runs = list(dict.fromkeys([*self.finished_runs(STEP.get(layer, layer)), self.run_id]))
        return self.spark.read.parquet(*[self._run_path(layer, table, r) for r in runs])

    def previous(self, layer: str, table: str) -> DataFrame | None:
        """The table as of the last succeeded run of its layer other than this one, if there is one."""
        runs = self.other_runs(STEP.get(layer, layer))
        return self.read(layer, table, runs[-1]) if runs else None

    # -- type 2 history --

    def publish_history(self, layer: str, table: str, changes: DataFrame, cluster_by: Sequence[str]) -> None:
        """Store the open rows after this run, and the rows this run closed.

        Closed rows are written once and never again; only open rows are
        rewritten by each run.
        """
        path = self._run_path(layer, table, self.run_id)
        staged = self.publish("staging", table, changes)
        write_clustered(staged.where(F.col(END).isNull()), f"{path}/state={OPEN}", cluster_by, curve=True)
        write_clustered(staged.where(F.col(END).isNotNull()), f"{path}/state={CLOSED}", cluster_by, curve=True)

    def open_rows(self, layer: str, table: str, run: str | None = None) -> DataFrame | None:
        """Current rows as of ``run`` (default: the last succeeded one other than this)."""
        runs = [run] if run else self.other_runs(STEP.get(layer, layer))
        if not runs:
            return None
        return self.spark.read.parquet(f"{self._run_path(layer, table, runs[-1])}/state={OPEN}")

    def history(self, layer: str, table: str) -> DataFrame:
        """All rows: those closed by any succeeded run, and the open ones."""
        runs = self.finished_runs(layer)
        closed = self.spark.read.parquet(*[f"{self._run_path(layer, table, r)}/state={CLOSED}" for r in runs])
        return self.open_rows(layer, table, runs[-1]).unionByName(closed)
