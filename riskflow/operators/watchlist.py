"""Matches of customers against the sanctions list, and alerts on their activity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.functions import cleaning

MATCH_KEYS = ("full_name", "date_of_birth", "nationality")


def hits(customers: DataFrame, sanctions: DataFrame, normalise: bool = False) -> DataFrame:
    """Customers whose name, birth date and nationality equal a list entry's.

    NULL never matches. With ``normalise`` the list is brought to the text
    form of the customers first (customer names carry letters only); without
    it both sides are compared as they are.
    """
    name, nationality = F.col("name"), F.col("nationality")
    if normalise:
        name, nationality = cleaning.clean_name(name), cleaning.clean_nationality(nationality)
    entries = sanctions.select(
        name.alias("full_name"), "date_of_birth", nationality.alias("nationality"), "entry_id", "list_source"
    )
    return (
        customers.select("customer_id", *MATCH_KEYS)
        .join(entries, list(MATCH_KEYS))
        .select(
            F.sha2(F.concat_ws("||", "customer_id", "entry_id"), 256).alias("hit_id"),
            "customer_id",
            "full_name",
            "entry_id",
            "list_source",
        )
    )


def activity_alerts(sanction_hits: DataFrame, facts: DataFrame, fact_id: str) -> DataFrame:
    """One alert per hit and fact (transaction or swipe) of the same customer.

    ``facts`` may be a stream. Only three fact columns are read.
    """
    return facts.select("customer_id", fact_id, "account_id").join(
        sanction_hits.select("customer_id", "full_name", "entry_id", "list_source"), "customer_id"
    ).select("customer_id", "full_name", "entry_id", "list_source", fact_id, "account_id")


def alerts_on_transactions(sanction_hits: DataFrame, transactions: DataFrame) -> DataFrame:
    return activity_alerts(sanction_hits, transactions, "transaction_id")


def alerts_on_swipes(sanction_hits: DataFrame, swipes: DataFrame) -> DataFrame:
    return activity_alerts(sanction_hits, swipes, "swipe_id")
