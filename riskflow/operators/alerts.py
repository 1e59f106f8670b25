"""Fraud-score and card-velocity alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.operators.rules import Clock

# Weights of the score, the alert threshold, window and watermark.
TIER_SCORES = {"HIGH": 0.6, "MEDIUM": 0.3}
OTHER_TIER_SCORE = 0.1
HINT_SCORE = 0.4
FRAUD_THRESHOLD = 0.5
VELOCITY_WINDOW = "5 minutes"
VELOCITY_DELAY = "10 minutes"
VELOCITY_CITIES = 2


def join_risk(swipes: DataFrame, customers: DataFrame) -> DataFrame:
    """Swipes of known customers with the customer's risk tier.

    Only key and tier of the customers are read. The join is left to the
    planner: it broadcasts the customers below the session's size bound and
    otherwise shuffles, where hot customers are split at run time.
    """
    return swipes.join(customers.select("customer_id", "risk_tier"), "customer_id")


def fraud_score(joined: DataFrame, clock: Clock = Clock(), threshold: float = FRAUD_THRESHOLD) -> DataFrame:
    """Score = tier score + hint score; swipes at or above the threshold."""
    tier = F.lit(OTHER_TIER_SCORE)
    for name, score in TIER_SCORES.items():
        tier = F.when(F.col("risk_tier") == name, F.lit(score)).otherwise(tier)
    hint = F.when(F.col("_flag_hint").try_cast("boolean"), F.lit(HINT_SCORE)).otherwise(F.lit(0.0))
    return joined.select(
        "swipe_id",
        "customer_id",
        tier.alias("risk_score"),
        hint.alias("hint_score"),
        (tier + hint).alias("fraud_score"),
        clock.timestamp.alias("alert_timestamp"),
    ).where(F.col("fraud_score") >= threshold)


def velocity(
    swipes: DataFrame,
    clock: Clock = Clock(),
    window: str = VELOCITY_WINDOW,
    delay: str = VELOCITY_DELAY,
    min_cities: int = VELOCITY_CITIES,
) -> DataFrame:
    """Customers seen in several cities within one tumbling window.

    Counted in two steps, per city and then per window. Each step combines
    before its shuffle and holds plain counters, so neither a customer that
    owns a third of all swipes nor a window with many cities ever makes a
    large group (collecting the set of cities would). On a stream both steps
    are windowed state under one watermark, and a window is reported once the
    watermark has passed its end.
    """
    if swipes.isStreaming:
        swipes = swipes.withWatermark("swipe_timestamp", delay)
    per_city = swipes.groupBy(
        "customer_id", F.window("swipe_timestamp", window).alias("window"), "city"
    ).agg(F.count(F.lit(1)).alias("swipes"))
    return (
        per_city.groupBy("customer_id", "window")
        .agg(F.sum("swipes").alias("swipe_count"), F.count("city").cast("int").alias("distinct_city_count"))
        .where(F.col("distinct_city_count") >= min_cities)
        .select(
            "customer_id",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "swipe_count",
            "distinct_city_count",
            clock.timestamp.alias("alert_timestamp"),
        )
    )


def all_alerts(fraud: DataFrame, by_velocity: DataFrame) -> DataFrame:
    """Both alert families in one table, tagged with their type."""
    return fraud.withColumn("alert_type", F.lit("risk_hint")).unionByName(
        by_velocity.withColumn("alert_type", F.lit("velocity")), allowMissingColumns=True
    )
