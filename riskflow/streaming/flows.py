"""Card swipes as streams: raw files to silver, silver to gold alerts.

Each job is an available-now run with its own checkpoint: call it again to
process what has arrived since. Jobs meet in stored tables, because a query
may declare an event-time watermark only once and deduplication (24 hours)
and velocity (10 minutes) need different ones.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from riskflow.operators import alerts, quality, watchlist
from riskflow.operators.dedup import EVENT_DAY, late_rows, stream_dedup, with_event_day
from riskflow.operators.rules import Clock
from riskflow.plans import gold
from riskflow.plans.silver import SWIPES
from riskflow.sources.readers import is_missing, read_table, stream_table
from riskflow.sources.writers import append_available_now, for_each_batch

VALID, REJECTED = "valid", "rejected"
BATCH = "batch"

# A backlog is worked off in batches of this many files, each committed by itself.
FILES_PER_BATCH = 10_000


def append_late(rows: DataFrame, accepted: DataFrame, out: str, checkpoint: str, timeout: int | None = None) -> StreamingQuery:
    """Add the late rows of a stream to the table ``out``, in folders by batch and event day. ``accepted``: the rows
    ``stream_dedup`` let through, by event day."""
    schema = with_event_day(rows).schema

    def store(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        try:
            before = read_table(spark, out, StructType([*schema.fields, StructField(BATCH, LongType())]))
            before = before.where(F.col(BATCH) < number)
        except AnalysisException as e:
            if not is_missing(e):
                raise
            before = None
        found = with_event_day(late_rows(batch, accepted, before))
        found.write.mode("overwrite").partitionBy(EVENT_DAY).parquet(f"{out}/{BATCH}={number}")

    return for_each_batch(rows, store, checkpoint, timeout)


class SwipeFlows:
    """The streaming tables below one root folder, and the jobs that fill them."""

    def __init__(self, spark: SparkSession, root: str, clock: Clock = Clock(), timeout: int | None = None):
        self.spark, self.root, self.clock, self.timeout = spark, root.rstrip("/"), clock, timeout
        # Schemas of the tables filled here; a table without rows yet has no file to tell.
        self.schemas: dict[str, StructType] = {}

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str) -> DataFrame:
        return read_table(self.spark, self.path(table), self.schemas.get(table))

    def stream(self, table: str) -> DataFrame:
        return stream_table(self.spark, self.path(table), self.schemas.get(table), FILES_PER_BATCH)

    def append(self, df: DataFrame, table: str, *partition_by: str) -> StreamingQuery:
        self.schemas[table] = df.schema
        return append_available_now(
            df, self.path(table), f"{self.root}/_checkpoints/{table}", partition_by, self.timeout
        )

    def ingest(self, raw: DataFrame) -> StreamingQuery:
        """Raw swipes with provenance into the bronze table."""
        return self.append(raw, "bronze_swipes")

    def validate(self, references: Mapping[str, DataFrame]) -> StreamingQuery:
        """Bronze swipes, cleaned and checked, split by validity on disk.

        Both outcomes come from this one stateless query, so that parsing and
        reference joins are done once; later jobs read only their part.
        """
        cleaned = SWIPES.clean(self.stream("bronze_swipes"), self.clock)
        validated = SWIPES.validate(cleaned, references, self.clock)
        observed = quality.observe_expectations(validated, SWIPES.name, "swipes", self.clock)
        outcome = F.when(F.size(quality.REASONS) == 0, VALID).otherwise(REJECTED)
        # Few even files per outcome, however many tasks a batch has.
        split = observed.withColumn("outcome", outcome).hint("rebalance", "outcome")
        return self.append(split, "validated_swipes", "outcome")

    def outcome(self, name: str) -> DataFrame:
        return self.stream("validated_swipes").where(F.col("outcome") == name).drop("outcome")

    def accept(self, exact: bool = False) -> StreamingQuery:
        """Valid swipes, one row per swipe, in folders by event day."""
        single = stream_dedup(SWIPES.accepted(self.outcome(VALID)), exact=exact)
        return self.append(with_event_day(single), "silver_card_swipes", EVENT_DAY)

    def accepted(self) -> DataFrame:
        """Stream of the accepted swipes."""
        return self.stream("silver_card_swipes").drop(EVENT_DAY)

    def late(self) -> StreamingQuery:
        """Valid swipes behind the watermark, which ``accept`` dropped; it must have run on the same input before."""
        rows = SWIPES.accepted(self.outcome(VALID))
        self.schemas["late_card_swipes"] = with_event_day(rows).schema
        stored = self.read("silver_card_swipes")
        return append_late(rows, stored, self.path("late_card_swipes"), f"{self.root}/_checkpoints/late_card_swipes", self.timeout)

    def measure(self) -> StreamingQuery:
        """Expectation counts of the accepted swipes, stored per batch under its number."""
        return for_each_batch(self.accepted(), self.store_counts, f"{self.root}/_checkpoints/dq_card_swipes", self.timeout)

    def store_counts(self, batch: DataFrame, number: int) -> None:
        counts = quality.expectation_metrics(batch, SWIPES.name, self.clock)
        counts.coalesce(1).write.mode("overwrite").parquet(f"{self.path('dq_card_swipes')}/{BATCH}={number}")

    def metrics(self) -> DataFrame:
        """Expectation counts over all batches."""
        counted = read_table(self.spark, self.path("dq_card_swipes"), quality.METRICS)
        return counted.groupBy("expectation").agg(*[F.sum(c).alias(c) for c in ("passed", "failed", "unknown")])

    def reject(self) -> StreamingQuery:
        """Rejected swipes with their reasons."""
        return self.append(SWIPES.rejected(self.outcome(REJECTED), self.clock), "rejected_card_swipes")

    def publish(self) -> StreamingQuery:
        return self.append(gold.fact_card_swipes(self.accepted(), clock=self.clock), "fact_card_swipes")

    def fraud(self, customers: DataFrame) -> StreamingQuery:
        """``customers``: one current row per customer."""
        swipes = self.accepted()
        return self.append(alerts.fraud_score(alerts.join_risk(swipes, customers), self.clock), "fraud_alerts")

    def velocity(self) -> StreamingQuery:
        return self.append(alerts.velocity(self.accepted(), self.clock), "velocity_alerts")

    def sanctions(self, sanction_hits: DataFrame) -> StreamingQuery:
        swipes = self.stream("fact_card_swipes")
        return self.append(watchlist.alerts_on_swipes(sanction_hits, swipes), "sanction_alerts_swipes")

    def to_silver(self, references: Mapping[str, DataFrame], exact: bool = False) -> None:
        self.validate(references)
        self.accept(exact)
        self.late()
        self.measure()
        self.reject()

    def to_gold(self, customers: DataFrame, sanction_hits: DataFrame) -> None:
        self.publish()
        self.fraud(customers)
        self.velocity()
        self.sanctions(sanction_hits)
