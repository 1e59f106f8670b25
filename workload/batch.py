"""The whole batch run over the feeds: landing files, control table, bronze, silver, gold."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from riskflow.operators.rules import Clock
from riskflow.plans.medallion import Medallion
from riskflow.sources import schemas
from workload import feeds

SOURCES = {
    "customers": feeds.CUSTOMERS,
    "accounts": feeds.ACCOUNTS,
    "transactions": feeds.TRANSACTIONS,
    "sanctions": feeds.SANCTIONS,
}


def land(spark: SparkSession, folder: str, root: str) -> None:
    """Raw files of every feed and the control table, below ``root``."""
    rows = []
    for name, text in SOURCES.items():
        feeds.as_spark(spark, folder, text).select(*schemas.FEEDS[name]).write.option("header", True).csv(f"{root}/raw/{name}")
        rows.append({"source_folder": name, "source_file": "*.csv", "file_format": "csv", "target_schema": "bronze",
                     "target_table": name, "cluster_keys": [], "is_active": True})
    feeds.as_spark(spark, folder, feeds.SWIPES).select(*schemas.FEEDS["swipes"]).write.json(f"{root}/raw/swipes")
    spark.createDataFrame([(json.dumps(rows),)], "value string").coalesce(1).write.text(f"{root}/control")


def run(spark: SparkSession, root: str) -> Medallion:
    """One run over what ``land`` has laid out."""
    medallion = Medallion(spark, f"{root}/lake", "run-1", Clock(F.lit(feeds.NOW).cast("timestamp")), timeout=1800)
    medallion.run(f"{root}/control", f"{root}/raw")
    return medallion
