"""The batch run: control table to bronze, bronze to silver, silver to gold.

Each step reads stored tables and writes stored tables, so a lost executor
costs the tasks it ran and a failed step is repeated from the tables before
it. The steps log their start and end; the log feeds the run alerts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.operators import alerts, calendar, history, quality, watchlist
from riskflow.operators.rules import Clock
from riskflow.plans import gold
from riskflow.plans.incremental import DomainState
from riskflow.plans.silver import ACCOUNTS, CUSTOMERS, SANCTIONS, TRANSACTIONS, Domain
from riskflow.sources import ingest, readers, schemas
from riskflow.sources.lakehouse import FAILED, IN_PROGRESS, SUCCEEDED, Lakehouse
from riskflow.streaming.flows import SwipeFlows

# Columns the stored tables are ordered by, unless the control table names others:
# what their readers join and filter on.
CLUSTER_BY = {
    "customers": ("customer_id",),
    "accounts": ("account_id",),
    "transactions": ("customer_id", "transaction_timestamp"),
    "sanctions": ("entry_id",),
}
GOLD_CLUSTER_BY = {
    "dim_customers": ("customer_id",),
    "dim_accounts": ("account_id", "customer_id"),
    "fact_transactions": ("customer_id", "transaction_timestamp"),
    "dim_sanction_hits": ("customer_id", "entry_id"),
}


class IngestError(RuntimeError):
    """At least one source failed; the others were ingested."""


@dataclass(frozen=True)
class SourceResult:
    table: str
    error: str | None = None
    skipped: bool = False


class Medallion:
    """One run over the lakehouse below ``root``."""

    def __init__(self, spark: SparkSession, root: str, run_id: str, clock: Clock = Clock(), timeout: int | None = None):
        self.spark, self.run_id, self.clock, self.timeout = spark, run_id, clock, timeout
        self.lake = Lakehouse(spark, root, run_id)
        self.swipes = SwipeFlows(spark, f"{self.lake.root}/swipes", clock, timeout)
        self.cluster_by: dict[str, Sequence[str]] = dict(CLUSTER_BY)
        # Cluster keys that a source names and its silver table does not have.
        self.unknown_keys: dict[str, list[str]] = {}

    @contextmanager
    def logged(self, name: str):
        self.lake.begin(name)
        self.lake.report(name, IN_PROGRESS)
        try:
            yield
        except BaseException:
            self.lake.report(name, FAILED)
            raise
        self.lake.report(name, SUCCEEDED)

    def run(
        self, control_path: str, raw_root: str, swipes_folder: str | None = None, archive_root: str | None = None
    ) -> None:
        with self.logged("master"):
            self.ingest(control_path, raw_root, swipes_folder, archive_root)
            self.silver(with_swipes=swipes_folder is not None)
            self.gold(with_swipes=swipes_folder is not None)

    # -- bronze --

    def ingest(
        self, control_path: str, raw_root: str, swipes_folder: str | None = None, archive_root: str | None = None
    ) -> list[SourceResult]:
        """Append the new files of every active source to its bronze table.

        A source without files is skipped. One that fails does not keep the
        others from being ingested, but the step fails at its end. With
        ``archive_root`` ingested files move there, by source folder and day.
        Cluster keys of a source order the silver table made from it.
        """
        with self.logged("ingest"):
            sources = readers.active_sources(readers.control_table(self.spark, control_path))
            self.cluster_by |= {s.target_table: s.cluster_keys for s in sources if s.cluster_keys}
            results = [self._ingest_one(s, raw_root, archive_root) for s in sources]
            if swipes_folder:
                raw = readers.read_swipes(self.spark, swipes_folder, schemas.FEEDS["swipes"], self.run_id)
                self.swipes.ingest(raw)
            failed = [f"{r.table}: {r.error}" for r in results if r.error]
            if failed:
                raise IngestError("; ".join(failed))
        return results

    def _ingest_one(self, source, raw_root: str, archive_root: str | None) -> SourceResult:
        table, folder, files = source.target_table, source.source_folder, source.source_file or "*"
        try:
            if not readers.has_files(self.spark, f"{raw_root}/{folder}", files):
                return SourceResult(table, skipped=True)
            out = self.lake.path(source.target_schema or "bronze", table)
            checkpoint = f"{self.lake.root}/_checkpoints/{table}"
            archive = f"{archive_root}/{folder}/{self.lake.started:%Y/%m/%d}" if archive_root else None
            # A table that no feed declares has the columns its files name.
            columns = schemas.FEEDS.get(table, ())
            where = f"{raw_root}/{folder}"
            ingest.ingest_files(
                self.spark, where, out, checkpoint, columns, self.run_id, files, source.file_format, None, archive, timeout=self.timeout
            )
            return SourceResult(table)
        except Exception as e:  # recorded per source, raised for all at the end
            return SourceResult(table, str(e))

    # -- silver --

    def silver(self, with_swipes: bool = False) -> None:
        with self.logged("silver"):
            customers = self._dimension(CUSTOMERS, {})
            accounts = self._dimension(ACCOUNTS, {"customers": customers})
            known = {"customers": customers, "accounts": accounts}
            self._transactions(known)
            sanctions = self._publish_silver(SANCTIONS, self._latest(SANCTIONS, {}))
            self.lake.publish("silver", "sanction_hits", watchlist.hits(customers, sanctions))
            if with_swipes:
                self.swipes.to_silver(known)
                self.lake.publish("monitoring", "dq_swipes", self.swipes.metrics())

    def _latest(self, domain: Domain, references: Mapping[str, DataFrame]) -> DataFrame:
        """Accepted newest rows of a domain after the new batches of bronze, the only ones that are read."""
        return DomainState(self.lake, domain, self.clock).advance(references)

    def rejected(self, domain: Domain) -> DataFrame:
        """All rejected rows of a domain with their reasons, as of this run."""
        return DomainState(self.lake, domain, self.clock).rejected()

    def _cluster_keys(self, domain: Domain, df: DataFrame) -> list[str]:
        """The keys as far as the table has them; a wrong key costs order, not the run, and is noted."""
        unknown = [k for k in self.cluster_by[domain.name] if k not in df.columns]
        if unknown:
            self.unknown_keys[domain.name] = unknown
        return [k for k in self.cluster_by[domain.name] if k in df.columns]

    def _publish_silver(self, domain: Domain, df: DataFrame) -> DataFrame:
        stored = self.lake.publish("silver", domain.name, df, self._cluster_keys(domain, df))
        metrics = quality.expectation_metrics(stored, domain.name, self.clock)
        self.lake.publish("monitoring", f"dq_{domain.name}", metrics)
        return stored

    def _dimension(self, domain: Domain, references: Mapping[str, DataFrame]) -> DataFrame:
        """Extend the history of a dimension by this run's snapshot; returns the current rows."""
        table, keys = f"dim_{domain.name}", [domain.key]
        snapshot = self._publish_silver(domain, self._latest(domain, references))
        current = self.lake.open_rows("silver", table)
        if current is None:
            empty = snapshot.limit(0)
            stamp = F.lit(None).cast("timestamp")
            current = empty.withColumns({history.START: stamp, history.END: stamp})
        version = F.lit(self.lake.started).cast("timestamp")
        changes = history.scd2_changes(current, snapshot, keys, version)
        self.lake.publish_history("silver", table, changes, self._cluster_keys(domain, changes))
        return self.lake.open_rows("silver", table, self.run_id).drop(history.START, history.END)

    def _transactions(self, known: Mapping[str, DataFrame]) -> DataFrame:
        latest = self._latest(TRANSACTIONS, known)
        stored = self.lake.previous("silver", "transactions")
        if stored is not None:
            # Stored before it is laid out, which reads it twice.
            latest = self.lake.publish("staging", "transactions", history.scd1_apply(stored, latest, [TRANSACTIONS.key]))
        return self._publish_silver(TRANSACTIONS, latest)

    # -- gold --

    def _silver_run(self) -> str:
        """The newest state of silver: this run's if it has one."""
        return self.lake.finished_runs("silver")[-1]

    def gold(self, with_swipes: bool = False) -> None:
        with self.logged("gold"):
            lake, clock = self.lake, self.clock
            customers = lake.open_rows("silver", "dim_customers", self._silver_run()).drop(history.START, history.END)
            lake.publish("gold", "dim_customers", gold.dim_customers(lake.history("silver", "dim_customers"), clock), GOLD_CLUSTER_BY["dim_customers"])
            lake.publish("gold", "dim_accounts", gold.dim_accounts(lake.history("silver", "dim_accounts"), clock=clock), GOLD_CLUSTER_BY["dim_accounts"])
            lake.publish("gold", "dim_date", calendar.dim_date(self.spark))
            transactions = lake.publish(
                "gold",
                "fact_transactions",
                gold.fact_transactions(lake.read("silver", "transactions", self._silver_run()), clock=clock),
                GOLD_CLUSTER_BY["fact_transactions"],
            )
            hits = lake.publish(
                "gold",
                "dim_sanction_hits",
                gold.dim_sanction_hits(lake.read("silver", "sanction_hits", self._silver_run()), clock=clock),
                GOLD_CLUSTER_BY["dim_sanction_hits"],
            )
            lake.publish("gold", "sanction_alerts_transactions", watchlist.alerts_on_transactions(hits, transactions))
            if with_swipes:
                self.swipes.to_gold(customers, hits)
                both = alerts.all_alerts(self.swipes.read("fraud_alerts"), self.swipes.read("velocity_alerts"))
                lake.publish("gold", "all_alerts", both)
