"""The check queries: each applies one operator, or a chain, to the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions import cleaning, masking
from riskflow.operators import alerts, calendar, history, monitoring, quality, watchlist
from riskflow.operators.dedup import EVENT_DAY, stream_dedup, with_event_day
from riskflow.operators.rules import Clock
from riskflow.plans import gold
from riskflow.plans.incremental import DomainState
from riskflow.plans.silver import ACCOUNTS, CUSTOMERS, DOMAINS, SANCTIONS, SWIPES, TRANSACTIONS, Domain
from riskflow.session import work_folder
from riskflow.sources import ingest, readers, schemas
from riskflow.sources.lakehouse import SUCCEEDED, Lakehouse
from riskflow.sources.writers import ROWS_PER_RANGE, append_available_now, write_clustered, write_table
from riskflow.streaming.flows import SwipeFlows, append_late
from workload import feeds

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
STREAM_TIMEOUT = 1800


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def clock() -> Clock:
    return Clock(F.lit(feeds.NOW).cast("timestamp"))


def feed(spark: SparkSession, folder: str, text: str) -> DataFrame:
    return feeds.as_spark(spark, folder, text)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return readers.read_table(spark, f"{folder}/{name}.parquet")


RUN_STAMPS = ("_silver_processed_at", "_gold_processed_at", "rejected_at", "alert_timestamp")


def portable(df: DataFrame) -> DataFrame:
    """Values as any engine prints them: dates, times and lists as text, decimals as double."""

    def plain(f: T.StructField) -> Column:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, "|")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        return c.alias(f.name)

    return df.select(*[plain(f) for f in df.schema.fields if f.name not in RUN_STAMPS])


# --- sources -----------------------------------------------------------------


@query
def scan_lineage(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("_metadata.file_path").alias("_path"))
    stamped = readers.with_provenance(orders, "run-1", file_path=F.regexp_extract("_path", "([^/]+)$", 1))
    return stamped.drop("_path", "_ingested_at")


@query
def control_active_sources(spark, folder):
    control = table(spark, folder, "part").select(
        F.col("p_brand").alias("source_folder"),
        F.concat(F.col("p_partkey").cast("string"), F.lit("*.csv")).alias("source_file"),
        (F.col("p_size") > 25).alias("is_active"),
    )
    return readers.active(control)


@query
def rescued_fields(spark, folder):
    """Undeclared JSON fields of the event properties are kept aside."""
    events = table(spark, folder, "events").select("event_id", "props")
    return readers.with_rescued(events, "props", ["colour"])


# --- cleaning ----------------------------------------------------------------


@query
def clean_name(spark, folder):
    raw = feed(spark, folder, feeds.CUSTOMERS)
    return raw.select(
        "full_name",
        cleaning.clean_name("full_name").alias("clean_name"),
        cleaning.clean_merchant("full_name").alias("clean_merchant"),
        cleaning.clean_text("full_name").alias("clean_text"),
    )


@query
def clean_ids(spark, folder):
    raw = feed(spark, folder, feeds.TRANSACTIONS)
    return raw.select(
        cleaning.clean_formatted_transaction_id("transaction_id").alias("transaction_id"),
        cleaning.clean_formatted_card_id("card_id").alias("card_id"),
        cleaning.clean_formatted_customer_id("customer_id").alias("customer_id"),
        cleaning.clean_formatted_account_id("account_id").alias("account_id"),
    )


def _cleaned(name: str, expression: Callable[[str], Column], column: str, text: str) -> None:
    def run(spark, folder):
        return portable(feed(spark, folder, text).select(column, expression(column).alias("cleaned")))

    QUERIES[name] = run


_cleaned("clean_emirates_id", cleaning.clean_emirates_id, "emirates_id", feeds.CUSTOMERS)
_cleaned("clean_phone", cleaning.clean_phone, "phone", feeds.CUSTOMERS)
_cleaned("clean_email", cleaning.clean_email, "email", feeds.CUSTOMERS)
_cleaned("clean_nationality", cleaning.clean_nationality, "nationality", feeds.CUSTOMERS)
_cleaned("clean_city", cleaning.clean_city, "city", feeds.TRANSACTIONS)
_cleaned("parse_mcc_code", cleaning.parse_mcc_code, "mcc_code", feeds.TRANSACTIONS)
_cleaned("parse_amount", cleaning.parse_amount, "amount", feeds.TRANSACTIONS)
_cleaned("parse_timestamps", cleaning.parse_timestamp, "timestamp", feeds.TRANSACTIONS)
_cleaned("parse_mixed_date", cleaning.parse_mixed_date, "opened_date", feeds.ACCOUNTS)
_cleaned("aliases_array", cleaning.alias_list, "aliases", feeds.SANCTIONS)


@query
def clean_codes(spark, folder):
    raw = feed(spark, folder, feeds.ACCOUNTS)
    return raw.select(
        cleaning.clean_account_type("account_type").alias("account_type"),
        cleaning.clean_account_status("status").alias("account_status"),
        cleaning.clean_account_currency("currency").alias("account_currency"),
    )


# --- silver domains ----------------------------------------------------------

FEED_OF = {
    "customers": feeds.CUSTOMERS,
    "accounts": feeds.ACCOUNTS,
    "transactions": feeds.TRANSACTIONS,
    "swipes": feeds.SWIPES,
    "sanctions": feeds.SANCTIONS,
}


def validated(spark: SparkSession, folder: str, domain: Domain) -> DataFrame:
    references = {
        "customers": feed(spark, folder, feeds.KNOWN_CUSTOMERS),
        "accounts": feed(spark, folder, feeds.KNOWN_ACCOUNTS),
    }
    cleaned = domain.clean(feed(spark, folder, FEED_OF[domain.name]), clock())
    return domain.validate(cleaned, references, clock())


def _domain_queries(domain: Domain) -> None:
    def project(spark, folder):
        return portable(domain.clean(feed(spark, folder, FEED_OF[domain.name]), clock()))

    def reject(spark, folder):
        return portable(domain.rejected(validated(spark, folder, domain), clock()))

    def clean(spark, folder):
        return portable(domain.latest(validated(spark, folder, domain)))

    def metrics(spark, folder):
        cleaned = domain.clean(feed(spark, folder, FEED_OF[domain.name]), clock())
        return quality.expectation_metrics(cleaned, domain.name, clock())

    QUERIES[f"project_{domain.name}"] = project
    QUERIES[f"reject_{domain.name}"] = reject
    QUERIES[f"clean_{domain.name}"] = clean
    QUERIES[f"dq_metrics_{domain.name}"] = metrics


for _domain in DOMAINS.values():
    _domain_queries(_domain)


def _move(spark: SparkSession, folder: str, to: str) -> None:
    """Move a folder, through the file system it is on; one without rows is not there, and an empty one is made."""
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (folder, to))
    files = source.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(target.getParent())
    if not (files.rename(source, target) if files.exists(source) else files.mkdirs(target)):
        raise OSError(f"{folder} could not be moved to {to}")


def _delivered(spark: SparkSession, folder: str) -> DomainState:
    """The transactions in three deliveries, dimensions growing with them; each delivery is taken in by a run of its own."""
    root, domain = work_folder(spark, "incremental"), TRANSACTIONS
    schema = readers.bronze_schema(schemas.FEEDS[domain.name])
    dealt = feeds.as_spark(spark, folder, feeds.TRANSACTIONS, 2 * spark.sparkContext.defaultParallelism)
    raw = dealt.withColumn(readers.RESCUED, F.lit(None).cast("string"))
    raw = raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    delivery = F.pmod(F.xxhash64(*schema.names), F.lit(3))
    grown = lambda df, key, parts, upto: df.where(F.pmod(F.xxhash64(key), F.lit(parts)) < upto)
    customers, accounts = feed(spark, folder, feeds.KNOWN_CUSTOMERS), feed(spark, folder, feeds.KNOWN_ACCOUNTS)
    # The feed is built once, in a folder per delivery, which is moved to bronze when its turn comes.
    raw.withColumn("delivery", delivery).write.partitionBy("delivery").parquet(f"{root}/landed")
    for i in range(3):
        lake = Lakehouse(spark, root, f"run-{i}")
        _move(spark, f"{root}/landed/delivery={i}", f"{lake.path('bronze', domain.name)}/{ingest.BATCH}={i}")
        state = DomainState(lake, domain, clock())
        lake.begin("silver")
        state.advance({"customers": grown(customers, "customer_id", 2, i + 1), "accounts": grown(accounts, "account_id", 3, i + 1)})
        lake.report("silver", SUCCEEDED)
    return state


@query
def silver_incremental(spark, folder):
    """Accepted transactions after three deliveries, of which each run read its own."""
    state = _delivered(spark, folder)
    return portable(state.lake.read("state", "newest_transactions", state.lake.run_id))


@query
def rejects_incremental(spark, folder):
    """Rejected transactions after three deliveries: those whose customer or account came later are no longer among them."""
    return portable(_delivered(spark, folder).rejected())


@query
def late_arrivals(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_shipdate", "l_returnflag")
    late = quality.late_arrival("o_orderdate", "l_shipdate")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_returnflag", late.alias("is_late_arrival"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


# --- alerts ------------------------------------------------------------------


def plain_swipes(spark: SparkSession, folder: str) -> DataFrame:
    return feed(spark, folder, feeds.PLAIN_SWIPES)


def plain_customers(spark: SparkSession, folder: str) -> DataFrame:
    return feed(spark, folder, feeds.PLAIN_CUSTOMERS)


def _fraud(spark, folder):
    joined = alerts.join_risk(plain_swipes(spark, folder), plain_customers(spark, folder))
    return alerts.fraud_score(joined, clock())


def _velocity(spark, folder):
    return alerts.velocity(plain_swipes(spark, folder), clock())


@query
def fraud_alerts(spark, folder):
    return portable(_fraud(spark, folder))


@query
def velocity_alerts(spark, folder):
    return portable(_velocity(spark, folder))


@query
def all_alerts(spark, folder):
    return portable(alerts.all_alerts(_fraud(spark, folder), _velocity(spark, folder)))


def _clean(spark: SparkSession, folder: str, domain: Domain) -> DataFrame:
    return domain.latest(validated(spark, folder, domain))


def _hits(spark: SparkSession, folder: str) -> DataFrame:
    return watchlist.hits(_clean(spark, folder, CUSTOMERS), _clean(spark, folder, SANCTIONS))


@query
def sanction_hits(spark, folder):
    return _hits(spark, folder)


@query
def sanction_alerts_transactions(spark, folder):
    return watchlist.alerts_on_transactions(_hits(spark, folder), _clean(spark, folder, TRANSACTIONS))


@query
def sanction_alerts_swipes(spark, folder):
    return watchlist.alerts_on_swipes(_hits(spark, folder), _clean(spark, folder, SWIPES))


# --- gold --------------------------------------------------------------------


@query
def dim_date(spark, folder):
    """Every calendar day with the number of events on it."""
    per_day = (
        table(spark, folder, "events").groupBy(F.to_date("ts").alias("date")).agg(F.count(F.lit(1)).alias("events"))
    )
    days = calendar.dim_date(spark).join(per_day, "date", "left")
    return portable(days.withColumn("events", F.coalesce("events", F.lit(0))))


@query
def gold_fact_transactions(spark, folder):
    return portable(gold.fact_transactions(_clean(spark, folder, TRANSACTIONS), clock=clock()))


@query
def gold_dim_customers(spark, folder):
    return portable(gold.dim_customers(_clean(spark, folder, CUSTOMERS), clock()))


@query
def gold_dim_accounts(spark, folder):
    return portable(gold.dim_accounts(_clean(spark, folder, ACCOUNTS), clock=clock()))


# --- masking -----------------------------------------------------------------


@query
def mask_pii(spark, folder):
    raw = feed(spark, folder, feeds.CUSTOMERS)
    return raw.select(
        "email",
        "phone",
        masking.mask("emirates_id", "national_id").alias("masked_id"),
        masking.mask("email", "email").alias("masked_email"),
        masking.mask("phone", "phone").alias("masked_phone"),
        masking.mask("full_name", "name").alias("masked_other"),
        masking.mask("email", F.when(F.col("risk_tier") == "low", "email").otherwise("phone")).alias("masked_by_column"),
    )


def _masked(spark, folder, role):
    cleaned = CUSTOMERS.clean(feed(spark, folder, feeds.CUSTOMERS), clock())
    return portable(masking.masked_view(masking.tag(cleaned), role))


@query
def masked_view_analyst(spark, folder):
    return _masked(spark, folder, "analysts")


@query
def masked_view_compliance(spark, folder):
    return _masked(spark, folder, "compliance_officer")


# --- history -----------------------------------------------------------------


def _snapshots(spark: SparkSession, folder: str) -> DataFrame:
    rows = feed(spark, folder, feeds.SNAPSHOT_ROWS)
    return rows.groupBy("customer_id", "version").agg(F.max_by("status", "o_orderkey").alias("status"))


def _history(spark: SparkSession, folder: str) -> DataFrame:
    return history.scd2_from_snapshots(_snapshots(spark, folder), ["customer_id"], "version")


@query
def scd2_history(spark, folder):
    return _history(spark, folder)


def _next_history(spark: SparkSession, folder: str) -> DataFrame:
    next_snapshot = table(spark, folder, "customer").where("c_acctbal >= 0").select(
        F.col("c_custkey").alias("customer_id"), F.expr("CASE WHEN c_acctbal < 5000 THEN 'F' ELSE 'O' END").alias("status")
    )
    return history.scd2_apply(_history(spark, folder), next_snapshot, ["customer_id"], F.lit(99999))


@query
def scd2_next_snapshot(spark, folder):
    """The history of all orders, then one more snapshot: customers in credit by segment."""
    return _next_history(spark, folder)


@query
def scd2_current(spark, folder):
    """What is open after that: all customers in credit."""
    return history.current_rows(_next_history(spark, folder))


@query
def scd1_current(spark, folder):
    """Latest order per customer as stored state, replaced by a snapshot of all customers."""
    current = feed(spark, folder, feeds.SNAPSHOT_ROWS).groupBy("customer_id").agg(
        F.max_by("status", "o_orderkey").alias("status"), F.lit("old").alias("source_file")
    )
    snapshot = table(spark, folder, "customer").where("c_acctbal >= 0").select(
        F.col("c_custkey").alias("customer_id"),
        F.expr("CASE WHEN c_acctbal < 5000 THEN 'F' ELSE 'O' END").alias("status"),
        F.lit("new").alias("source_file"),
    )
    return history.scd1_apply(current, snapshot, ["customer_id"])


# --- monitoring --------------------------------------------------------------


def _runs(spark, folder):
    return feed(spark, folder, feeds.RUN_LOG)


@query
def recent_alert_count(spark, folder):
    """Fraud alerts of the last hour, where an alert is raised at the swipe's own time."""
    swipes = plain_swipes(spark, folder).withColumn("alert_timestamp", F.col("swipe_timestamp").cast("timestamp"))
    at = Clock(F.lit("2024-01-15 12:00:00").cast("timestamp"))
    return monitoring.recent_alert_count(swipes.where("alert_timestamp <= timestamp'2024-01-15 12:00:00'"), at, threshold=10)


def _reported(spark: SparkSession, folder: str) -> DataFrame:
    """The latest report of every run, stored and merged over two deliveries of the log, the second with older reports too."""
    runs, root, stored = _runs(spark, folder), work_folder(spark, "reports"), None
    for i in (0, 1):
        delivered = runs.where(F.pmod(F.xxhash64("RunId", "TimeGenerated", "Status"), F.lit(2)) == i)
        monitoring.latest_reports(delivered, stored).write.parquet(f"{root}/{i}")
        stored = readers.read_table(spark, f"{root}/{i}")
    return stored


@query
def late_runs(spark, folder):
    return portable(monitoring.late_runs(_reported(spark, folder), clock=clock()))


@query
def late_run_alerts(spark, folder):
    return portable(monitoring.late_run_alerts(monitoring.late_runs(_reported(spark, folder), clock=clock())))


@query
def sliding_breaches(spark, folder):
    return portable(monitoring.sliding_breaches(monitoring.failed_runs(_runs(spark, folder))))


@query
def overtime_breaches(spark, folder):
    return portable(monitoring.sliding_breaches(monitoring.overtime_runs(_runs(spark, folder))))


@query
def duration_breaches(spark, folder):
    runs = table(spark, folder, "lineitem").select(
        F.expr("CASE l_returnflag WHEN 'A' THEN 'bronze' WHEN 'N' THEN 'silver' ELSE 'gold' END").alias("job"),
        (F.col("l_quantity") * 30).cast("bigint").alias("run_seconds"),
    )
    return (
        monitoring.duration_breaches(runs)
        .groupBy("job", "limit_seconds")
        .agg(F.count(F.lit(1)).alias("runs"), F.max("run_seconds").alias("longest"))
    )


# --- writers -----------------------------------------------------------------


@query
def curve_table(spark, folder):
    """Line items rewritten along a curve through supplier and date, read back: whether the files are narrow in both keys."""
    path = work_folder(spark, "curve")
    keys = ["l_suppkey", "l_shipdate"]
    write_clustered(table(spark, folder, "lineitem"), path, keys, partitions=16, curve=True)
    days = F.datediff("l_shipdate", F.lit("1992-01-01").cast("date"))
    stored = readers.read_table(spark, path).withColumn("day", days).select("*", "_metadata.file_path")
    lines = [F.count(F.lit(1)).alias("lines"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")]
    edges = [f(c).alias(f"{f.__name__}_{c}") for c in ("l_suppkey", "day") for f in (F.min, F.max)]
    files = stored.groupBy("file_path").agg(*lines, *edges)
    narrow = lambda c: F.avg(F.col(f"max_{c}") - F.col(f"min_{c}")) < 0.6 * (F.max(f"max_{c}") - F.min(f"min_{c}"))
    return files.agg(
        F.sum("lines").alias("lines"), F.sum("quantity").alias("quantity"),
        narrow("l_suppkey").alias("narrow_supplier"), narrow("day").alias("narrow_date"),
    )


#: Compressed size below which a file counts as small.
SMALL_FILE = 8 * 1024 * 1024


#: Rows of a file that are looked at together.
BLOCK_ROWS = 65_536


def _unordered(stored: DataFrame) -> DataFrame:
    """Adds whether a row lies behind one of a higher key in its file. Files are looked at in blocks of rows, each with the last
    row before it, so that no task holds a file."""
    block = F.expr(f"row_index div {BLOCK_ROWS}")
    last = F.pmod(F.col("row_index"), F.lit(BLOCK_ROWS)) == BLOCK_ROWS - 1
    seen = stored.select("l_suppkey", "l_quantity", "at", "file_path", "row_index")
    seen = seen.withColumn("block", F.explode(F.when(last, F.array(block, block + 1)).otherwise(F.array(block))))
    tasks = max(stored.sparkSession.sparkContext.defaultParallelism, stored.count() // ROWS_PER_RANGE)
    before = F.lag("at").over(Window.partitionBy("file_path", "block").orderBy("row_index"))
    dealt = seen.repartition(tasks, "file_path", "block").withColumn("unordered", (before > F.col("at")).cast("bigint"))
    return dealt.where(F.col("block") == block)


@query
def clustered_table(spark, folder):
    """Line items rewritten in order of supplier and date, read back: rows out of order within their file, and files whose
    range of keys overlaps the one before."""
    path = work_folder(spark, "clustered")
    keys = ["l_suppkey", "l_shipdate"]
    write_clustered(table(spark, folder, "lineitem"), path, keys, partitions=8)
    stored = readers.read_table(spark, path).select("*", "_metadata.file_path", "_metadata.row_index", F.struct(*keys).alias("at"))
    suppliers = _unordered(stored).groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
        F.coalesce(F.sum("unordered"), F.lit(0)).alias("unordered"),
    )
    # The least of structs is found by sorting, so there is one struct per file and supplier only. NULL is the lowest date.
    dates = F.when(F.count("l_shipdate") == F.count(F.lit(1)), F.min("l_shipdate")).alias("low"), F.max("l_shipdate").alias("high")
    dated = stored.groupBy("file_path", "l_suppkey").agg(*dates)
    edge = lambda least, c: least(F.struct("l_suppkey", F.col(c).alias("l_shipdate"))).alias(c)
    files = dated.groupBy("file_path").agg(edge(F.min, "low"), edge(F.max, "high"))
    overlap = F.lag("high").over(Window.orderBy("low", "high")) > F.col("low")
    overlaps = files.withColumn("overlap", overlap).where("overlap").select(F.col("low.l_suppkey").alias("l_suppkey")).distinct()
    return suppliers.join(overlaps.withColumn("overlaps", F.lit(True)), "l_suppkey", "left").withColumn(
        "overlaps", F.coalesce("overlaps", F.lit(False))
    )


@query
def balanced_table(spark, folder):
    """Orders stored from eight tasks in balanced files per status, read back: whether a status has more than one small file."""
    path = work_folder(spark, "balanced")
    write_table(table(spark, folder, "orders").repartition(8), path, partition_by=["o_orderstatus"])
    stored = readers.read_table(spark, path).select("*", "_metadata.file_path", "_metadata.file_size")
    small = F.countDistinct(F.when(F.col("file_size") < SMALL_FILE, F.col("file_path")))
    return stored.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.max("o_orderkey").alias("last_order"), (small > 1).alias("crumbs")
    )


# --- streams -----------------------------------------------------------------


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events table as a stream of swipes; event time as an instant."""
    schema = table(spark, folder, "events").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    return rows.select(
        F.col("event_id").alias("swipe_id"),
        F.col("user_id").alias("customer_id"),
        (F.col("user_id") + 1000).alias("account_id"),
        F.col("event_type").alias("city"),
        F.col("ts").cast("timestamp").alias("swipe_timestamp"),
        (F.col("event_type") == "error").alias("_flag_hint"),
    )


def run_stream(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    root = work_folder(spark, name)
    append_available_now(df, f"{root}/out", f"{root}/checkpoint", timeout=STREAM_TIMEOUT)
    return readers.read_table(spark, f"{root}/out")


@query
def stream_dedup_swipes(spark, folder):
    """Every event twice in the stream, each kept once."""
    doubled = event_stream(spark, folder).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    return portable(run_stream(spark, stream_dedup(doubled), "dedup"))


@query
def stream_dedup_batches(spark, folder):
    """Events in three deliveries, the last one early events again and some it holds back: what each swipe came to."""
    root = work_folder(spark, "dedup-batches")
    events = table(spark, folder, "events").select(
        F.col("event_id").alias("swipe_id"), F.col("ts").cast("timestamp").alias("swipe_timestamp")
    )
    early = F.col("swipe_timestamp") < F.lit("2024-01-10").cast("timestamp")
    held = early & (F.pmod("swipe_id", F.lit(10)) == 0)
    for rows in (events.where(early & ~held), events.where(~early), events.where(early)):
        rows.write.mode("append").parquet(f"{root}/in")
        stream = lambda: readers.stream_table(spark, f"{root}/in", rows.schema)  # noqa: E731, B023
        single = with_event_day(stream_dedup(stream()))
        append_available_now(single, f"{root}/accepted", f"{root}/cp-accepted", [EVENT_DAY], STREAM_TIMEOUT)
        accepted = readers.read_table(spark, f"{root}/accepted", single.schema)
        append_late(stream(), accepted, f"{root}/late", f"{root}/cp-late", STREAM_TIMEOUT)
    late = readers.read_table(spark, f"{root}/late", rows.schema)
    outcome = lambda df, name: df.select("swipe_id", F.lit(name).alias("outcome"))
    return outcome(accepted, "accepted").unionByName(outcome(late, "late"))


@query
def stream_velocity(spark, folder):
    return portable(run_stream(spark, alerts.velocity(event_stream(spark, folder), clock()), "velocity"))


@query
def stream_fraud_alerts(spark, folder):
    joined = alerts.join_risk(event_stream(spark, folder), plain_customers(spark, folder))
    return portable(run_stream(spark, alerts.fraud_score(joined, clock()), "fraud"))


@query
def stream_fact_swipes(spark, folder):
    return portable(run_stream(spark, gold.fact_card_swipes(event_stream(spark, folder), clock=clock()), "facts"))


def _ingested(spark: SparkSession, root: str, columns: list[str], file_format: str) -> DataFrame:
    ingest.ingest_files(
        spark, f"{root}/landing", f"{root}/out", f"{root}/checkpoint", columns, "run-1", file_format=file_format, timeout=STREAM_TIMEOUT
    )
    return readers.read_table(spark, f"{root}/out")


@query
def ingest_csv_by_name(spark, folder):
    """Orders as CSV under three headers: as declared, reordered, and with one more column in the middle."""
    root = work_folder(spark, "csv-by-name")
    orders = table(spark, folder, "orders").select(*[F.col(c).cast("string") for c in ("o_orderkey", "o_custkey", "o_orderstatus")])
    part = F.pmod(F.col("o_orderkey").cast("bigint"), F.lit(3))
    layouts = [
        ["o_orderkey", "o_custkey", "o_orderstatus"],
        ["o_orderstatus", "o_orderkey", "o_custkey"],
        ["o_orderkey", "channel", "o_custkey", "o_orderstatus"],
    ]
    for i, layout in enumerate(layouts):
        rows = orders.where(part == i).withColumn("channel", F.concat(F.lit("c"), F.col("o_custkey")))
        rows.select(*layout).write.mode("append").option("header", True).csv(f"{root}/landing")
    out = _ingested(spark, root, layouts[0], "csv")
    return out.select("o_orderkey", "o_custkey", "o_orderstatus", "channel", "_rescued_data")


@query
def ingest_backfill(spark, folder):
    """Customers in two deliveries, the second with files dated a year before those of the first."""
    root = work_folder(spark, "backfill")
    customers = table(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias("customer_id"), "c_mktsegment")
    for i in (0, 1):
        rows = customers.where(F.pmod(F.col("customer_id").cast("bigint"), F.lit(2)) == i)
        rows.write.option("header", True).csv(f"{root}/landing/delivery={i}")
        if i:
            _date_back(spark, f"{root}/landing/delivery={i}", 365)
        out = _ingested(spark, root, ["customer_id", "c_mktsegment"], "csv")
    return out.select("customer_id", "c_mktsegment")


def _date_back(spark: SparkSession, folder: str, days: int) -> None:
    """Set the time stamps of all files of one delivery back, through the file system they are on."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(path):
        files.setTimes(status.getPath(), status.getModificationTime() - days * 86_400_000, -1)


@query
def ingest_json_array(spark, folder):
    """Customers as JSON arrays of up to a thousand, one to a file, with a nested field that was not declared."""
    root = work_folder(spark, "json-array")
    row = F.struct("c_custkey", "c_name", F.struct("c_nationkey", "c_mktsegment").alias("home"))
    groups = table(spark, folder, "customer").groupBy(F.expr("c_custkey div 1000").alias("part"))
    groups.agg(F.to_json(F.collect_list(row)).alias("value")).write.partitionBy("part").text(f"{root}/landing")
    out = _ingested(spark, root, ["c_custkey", "c_name"], "json")
    return out.select("c_custkey", "c_name", "home")


@query
def stream_ingest_rescued(spark, folder):
    """Events as JSON-lines files, ingested with one declared field missing from the declaration."""
    landing = work_folder(spark, "landing")
    table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("swipe_id"), F.col("event_type").alias("city"), F.col("user_id")
    ).write.json(landing)
    raw = readers.read_lines(spark, landing, ["swipe_id", "city"], "run-1", "*.json", stamps=readers.SWIPE_STAMPS)
    return run_stream(spark, raw.drop("ingested_at", "file_name"), "rescued")


def _swipe_flows(spark: SparkSession, folder: str) -> SwipeFlows:
    """The swipes feed through landing files, bronze and the validated table."""
    flows = SwipeFlows(spark, work_folder(spark, "swipes"), clock(), STREAM_TIMEOUT)
    columns = schemas.FEEDS["swipes"]
    feed(spark, folder, feeds.SWIPES).select(*columns).write.json(flows.path("landing"))
    raw = readers.read_lines(spark, flows.path("landing"), columns, "run-7", "*.json", stamps=readers.SWIPE_STAMPS)
    flows.ingest(raw.withColumn("ingested_at", F.lit(feeds.NOW).cast("timestamp")))
    flows.validate(
        {"customers": feed(spark, folder, feeds.KNOWN_CUSTOMERS), "accounts": feed(spark, folder, feeds.KNOWN_ACCOUNTS)}
    )
    return flows


@query
def stream_swipes_valid(spark, folder):
    flows = _swipe_flows(spark, folder)
    flows.accept()
    return portable(flows.read("silver_card_swipes").drop("source_file", EVENT_DAY))


@query
def stream_dq_swipes(spark, folder):
    """Expectation counts of the accepted swipes, from the table that holds them batch by batch."""
    flows = _swipe_flows(spark, folder)
    flows.accept()
    flows.measure()
    return flows.metrics()


@query
def stream_swipes_rejected(spark, folder):
    flows = _swipe_flows(spark, folder)
    flows.reject()
    return portable(flows.read("rejected_card_swipes").drop("source_file"))
