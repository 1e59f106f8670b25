"""Gold tables: published copies of silver, and the alert tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskflow.operators.rules import Clock


def publish(df: DataFrame, *drop: str, clock: Clock = Clock()) -> DataFrame:
    """A silver table as published: stamped, less the given columns."""
    return df.withColumn("_gold_processed_at", clock.timestamp).drop(*drop)


def dim_customers(customers: DataFrame, clock: Clock = Clock()) -> DataFrame:
    return publish(customers, "account_opened_date", clock=clock)


# The remaining published tables carry all columns of their silver table.
dim_accounts = publish
dim_sanction_hits = publish
fact_transactions = publish
fact_card_swipes = publish
