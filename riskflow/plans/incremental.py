"""Silver from new rows only: a delivery of bronze is cleaned, checked and merged into stored state.

Per domain the state is

* the newest accepted row of every key,
* the rejects that may still become valid, because a rule waits for a key of a dimension or for the clock,
* the rejects that are final, written once by the run that found them and never read again by a later run,
* the keys of every dimension the rows were checked against.

A run reads the bronze batches after the last one it knows, and of the open rejects only those whose missing key is among the keys
that came since, or whose time has passed. These are checked again together with the new rows; nothing else is parsed or joined. As
bronze only grows and known keys stay known, the outcome is that of checking all of bronze again.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.operators import quality
from riskflow.operators.dedup import latest_per_key
from riskflow.operators.rules import CLOCK, RULES, Clock
from riskflow.plans.silver import Domain
from riskflow.session import keep_compiled
from riskflow.sources import readers, schemas
from riskflow.sources.ingest import BATCH
from riskflow.sources.lakehouse import CLOSED, OPEN, Lakehouse
from riskflow.sources.readers import is_missing

STATE, OUTCOME = "state", "outcome"
VALID = "valid"
PROGRESS = "last_batch long"


def waiting(domain: Domain, awaited: str) -> list[str]:
    """Codes of the rules that wait for a dimension or the clock."""
    return [r.code for r in RULES[domain.name] if r.waits == awaited]


def _any_of(codes: list[str]) -> Column:
    return F.arrays_overlap(quality.REASONS, F.array(*map(F.lit, codes))) if codes else F.lit(False)


def is_open(domain: Domain) -> Column:
    """Whether a rejected row may have fewer reasons later. Domains that keep one reject per key keep all of them open, as a
    later one may take its place."""
    if domain.one_reject_per_key:
        return F.lit(True)
    return _any_of([r.code for r in RULES[domain.name] if r.waits])


class DomainState:
    """One domain in a lakehouse. Its tables are those of the runs of the silver step: a run that is taken again starts from the
    same other run and writes folders of its own."""

    def __init__(self, lake: Lakehouse, domain: Domain, clock: Clock = Clock(), bronze: str | None = None):
        self.lake, self.domain, self.clock = lake, domain, clock
        self.bronze = bronze or lake.path("bronze", domain.name)

    @property
    def spark(self) -> SparkSession:
        return self.lake.spark

    def _name(self, table: str) -> str:
        return f"{table}_{self.domain.name}"

    def _before(self, table: str) -> DataFrame | None:
        """A state table as the last other run left it; None before the first one."""
        try:
            return self.lake.previous(STATE, self._name(table))
        except AnalysisException as e:
            if not is_missing(e):
                raise
            return None

    # -- what a run reads --

    def last_batch(self) -> int:
        """The last bronze batch an earlier run took in; -1 if none did."""
        before = self._before("progress")
        row = before.first() if before is not None else None
        return row.last_batch if row else -1

    def delivery(self) -> DataFrame:
        """Raw rows of the batches after that, with their batch number. The number is a folder name: other batches are not
        opened."""
        schema = readers.bronze_schema(schemas.FEEDS[self.domain.name]).add(BATCH, "long")
        bronze = readers.read_table(self.spark, self.bronze, schema)
        return bronze.where(F.col(BATCH) > self.last_batch())

    def _arrived(self, references: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """Keys of the dimensions that the last run did not know. Stores those known now."""
        arrived = {}
        for dimension, key in self.domain.references.items():
            keys = references[dimension].select(key).where(F.col(key).isNotNull()).distinct()
            known = self._before(f"known_{dimension}")
            now = self.lake.publish(STATE, self._name(f"known_{dimension}"), keys)
            arrived[dimension] = now if known is None else now.join(known, key, "left_anti")
        return arrived

    def _due(self, rejects: DataFrame, arrived: Mapping[str, DataFrame]) -> DataFrame:
        """Open rejects, marked ``_due`` if one of their reasons may have gone."""
        due = F.lit(False)
        for rule in RULES[self.domain.name]:
            if rule.waits == CLOCK:
                due = due | (F.array_contains(quality.REASONS, rule.code) & ~F.coalesce(rule.fires(self.clock), F.lit(False)))
        marked = rejects
        for dimension, keys in arrived.items():
            key = self.domain.references[dimension]
            marked = quality.with_reference(marked, keys, key)
            match = quality.MATCH_PREFIX + key
            due = due | (_any_of(waiting(self.domain, dimension)) & F.col(match).isNotNull())
        return marked.withColumn("_due", due).drop(*[c for c in marked.columns if c.startswith(quality.MATCH_PREFIX)])

    # -- the run --

    def advance(self, references: Mapping[str, DataFrame] | None = None) -> DataFrame:
        """Take in what is new; returns the newest accepted row of every key, as stored."""
        domain, lake, references = self.domain, self.lake, references or {}
        keep_compiled(self.spark)
        raw = self.delivery()
        arrived = self._arrived(references)
        rows = domain.clean(raw.drop(BATCH), self.clock).drop(*domain.hidden)
        rejects, kept = self._before("open_rejects"), None
        if rejects is not None:
            marked = lake.publish("staging", self._name("open"), self._due(rejects, arrived), partition_by=["_due"], balance=False)
            again = marked.where("_due").select(*rows.columns).withColumn("_silver_processed_at", self.clock.timestamp)
            rows, kept = rows.unionByName(again), marked.where("NOT _due").select(*rejects.columns)

        validated = domain.validate(rows, references, self.clock)
        outcome = F.when(F.size(quality.REASONS) == 0, VALID).when(is_open(domain), OPEN).otherwise(CLOSED)
        # Rows come from the files of bronze and go on as they lie; only dimension keys are shuffled, if they are many.
        judged = validated.withColumn(OUTCOME, outcome)
        staged = lake.publish("staging", self._name("validated"), judged, partition_by=[OUTCOME], balance=False)
        of = lambda name: staged.where(F.col(OUTCOME) == name).drop(OUTCOME)

        lake.publish(STATE, self._name("closed_rejects"), quality.rejected(of(CLOSED), clock=self.clock), balance=False)
        opened = quality.rejected(of(OPEN), clock=self.clock)
        opened = opened.unionByName(kept) if kept is not None else opened
        if domain.one_reject_per_key:
            opened = latest_per_key(opened, [domain.key])
        lake.publish(STATE, self._name("open_rejects"), opened, balance=False)

        newest = quality.accepted(of(VALID))
        before = self._before("newest")
        newest = newest.unionByName(before) if before is not None else newest
        newest = lake.publish(STATE, self._name("newest"), latest_per_key(newest, [domain.key]), balance=False)

        last = raw.agg(F.max(BATCH)).first()[0]
        progress = [(self.last_batch() if last is None else last,)]
        lake.publish(STATE, self._name("progress"), self.spark.createDataFrame(progress, PROGRESS))
        return newest

    def rejected(self) -> DataFrame:
        """All rejects as of this run: the final ones of every run and the open ones of the last."""
        opened = self.lake.read(STATE, self._name("open_rejects"), self.lake.run_id)
        closed = self.lake.read_runs(STATE, self._name("closed_rejects"))
        return opened.unionByName(closed.select(*opened.columns))
