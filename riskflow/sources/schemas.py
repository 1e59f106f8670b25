"""Declared columns of the raw feeds. Every raw value arrives as text."""

# Column names of the feeds.
FEEDS: dict[str, tuple[str, ...]] = {
    "customers": (
        "customer_id",
        "full_name",
        "emirates_id",
        "email",
        "phone",
        "nationality",
        "date_of_birth",
        "account_opened_date",
        "risk_tier",
    ),
    "accounts": ("account_id", "customer_id", "account_type", "status", "currency", "opened_date"),
    "transactions": (
        "transaction_id",
        "card_id",
        "customer_id",
        "account_id",
        "merchant",
        "mcc_code",
        "amount",
        "currency",
        "city",
        "timestamp",
        "auth_code",
        "status",
    ),
    "swipes": (
        "swipe_id",
        "account_id",
        "customer_id",
        "card_id",
        "amount",
        "city",
        "country",
        "currency",
        "event_ts",
        "merchant",
        "mcc_code",
        "_flag_hint",
    ),
    "sanctions": ("entry_id", "name", "aliases", "date_of_birth", "nationality", "entity_type", "list_source"),
}

CONTROL = (
    "source_folder string, source_file string, file_format string, target_schema string, "
    "target_table string, cluster_keys array<string>, is_active boolean"
)
