"""Row validation: reference checks, rejection reasons, split, DQ metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.operators.rules import EXPECTATIONS, RULES, Clock

REASONS = "rejected_reasons"
METRICS = T.StructType().add("expectation", T.StringType()).add("passed", T.LongType()).add("failed", T.LongType()).add("unknown", T.LongType())
MATCH_PREFIX = "_matched_"


def with_reference(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Left join the known keys of a dimension; adds ``_matched_<key>``.

    Only the distinct key column of the dimension takes part, so a dimension
    with several versions per key adds no rows. No side is broadcast by hand:
    the key list is broadcast while its size stays under the session's bound,
    and otherwise the join shuffles and adaptive execution splits hot keys
    (a left join may split its left side at will). A streaming frame needs no
    other code: without state its micro-batches run adaptively as well.

    Adaptive splitting needs both sides fresh from a shuffle. Keys made
    distinct by the key alone would be joined as that aggregate left them, so
    they are made distinct together with their hash, which is the same set but
    has the key list shuffled once more; it is the small side.
    """
    match = MATCH_PREFIX + key
    known = (
        dimension.select(F.col(key).alias(match))
        .where(F.col(match).isNotNull())
        .select(match, F.xxhash64(match).alias("_hash"))
        .distinct()
        .drop("_hash")
    )
    return df.join(known, F.col(key) == F.col(match), "left")


def reject_reasons(domain: str, clock: Clock = Clock()) -> Column:
    """Codes of all rules of ``domain`` that fire on the row, in rule order."""
    return F.array_compact(F.array(*[F.when(rule.fires(clock), F.lit(rule.code)) for rule in RULES[domain]]))


def with_reasons(df: DataFrame, domain: str, clock: Clock = Clock()) -> DataFrame:
    """Add the reasons, computed once per row.

    The optimizer would rewrite a later filter on the reasons in terms of the
    raw columns and move it down to the scan, where all cleaning expressions
    would be expanded into all rules; one small query took minutes that way.
    It leaves filters above a column that is not deterministic, so the reasons
    hang on a condition that is always true but that it cannot know.
    """
    always = F.spark_partition_id() >= 0
    return df.withColumn(REASONS, F.when(always, reject_reasons(domain, clock)))


def accepted(validated: DataFrame, *hidden: str) -> DataFrame:
    """Rows without a reason, less the helper columns."""
    return validated.where(F.size(REASONS) == 0).drop(REASONS, *_matches(validated), *hidden)


def rejected(validated: DataFrame, *hidden: str, clock: Clock = Clock()) -> DataFrame:
    """Rows with at least one reason, stamped ``rejected_at``."""
    return (
        validated.where(F.size(REASONS) > 0)
        .withColumn("rejected_at", clock.timestamp)
        .drop(*_matches(validated), *hidden)
    )


def _matches(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith(MATCH_PREFIX)]


def late_arrival(event_time: str = "transaction_timestamp", ingest_time: str = "_ingested_at") -> Column:
    """Whether a row was ingested more than 24 hours after its event."""
    return F.col(ingest_time) > F.col(event_time) + F.expr("INTERVAL 24 HOURS")


def expectation_metrics(df: DataFrame, domain: str, clock: Clock = Clock()) -> DataFrame:
    """One row per expectation: how many rows pass, fail, or give NULL (unknown).

    All expectations are counted in one pass; each task sends one row on.
    """
    checks = {e.name: e.holds(clock) for e in EXPECTATIONS[domain]}
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(holds).alias(f"{name}_passed") for name, holds in checks.items()],
        *[F.count_if(~holds).alias(f"{name}_failed") for name, holds in checks.items()],
    )
    rows = [
        F.struct(
            F.lit(name).alias("expectation"),
            F.col(f"{name}_passed").alias("passed"),
            F.col(f"{name}_failed").alias("failed"),
            (F.col("total") - F.col(f"{name}_passed") - F.col(f"{name}_failed")).alias("unknown"),
        )
        for name in checks
    ]
    return counts.select(F.inline(F.array(*rows)))


def observe_expectations(df: DataFrame, domain: str, name: str = "dq", clock: Clock = Clock()) -> DataFrame:
    """Count failing rows per expectation while the frame is written.

    Works on a stream, where each progress report carries the counts of its
    micro-batch under ``name``. The frame itself passes through unchanged.
    """
    failures = [F.count_if(~e.holds(clock)).alias(e.name) for e in EXPECTATIONS[domain]]
    return df.observe(name, F.count(F.lit(1)).alias("total"), *failures)
