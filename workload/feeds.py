"""Raw banking feeds derived from the given tables.

Each feed is one SQL text in the dialect that Spark and DuckDB share, so both
engines start from the same dirty rows; what is compared is everything after.
Table names are written as {table}. Faults are planted by key arithmetic. Each
feed delivers its whole table twice, so every key has copies and versions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from riskflow.session import keep_compiled
from riskflow.sources.readers import read_table

# The instant all check queries take as now.
NOW = "2024-02-01 00:00:00"


def _digits(x: str, n: int) -> str:
    return f"lpad(cast({x} as string), {n}, '0')"


def _twice(columns: str, table: str) -> str:
    """Every row two times after one scan: deliveries 1 and 2, from two literal rows."""
    return f"(SELECT {columns}, delivery FROM {{{table}}}, (VALUES (1), (2)) AS d(delivery)) AS t"


def _mixed_date(year: str, month: str, day: str, kind: str) -> str:
    """A date as text in one of several layouts, chosen by an expression."""
    y, m, d = _digits(year, 4), _digits(month, 2), _digits(day, 2)
    return f"""CASE {kind} WHEN 0 THEN {y} || '-' || {m} || '-' || {d}
        WHEN 1 THEN ' ' || {d} || '/' || {m} || '/' || {y}
        WHEN 2 THEN {m} || '-' || {d} || '-' || {y} || ' '
        WHEN 3 THEN {y} || '/' || {m} || '/' || {d}
        WHEN 4 THEN {y} || '-02-30'
        WHEN 5 THEN 'junk'
        WHEN 6 THEN ''
        WHEN 7 THEN NULL
        ELSE {y} || '-' || {m} || '-' || {d} END"""


_LETTERS = "translate(" + _digits("k", 7) + ", '0123456789', 'abcdefghij')"

CUSTOMERS = f"""
SELECT
  CASE WHEN (k + delivery) % 61 = 0 THEN NULL WHEN (k + delivery) % 59 = 0 THEN 'CUST' || cast(k as string) || 'X'
    ELSE '  cu-st' || {_digits("k", 6)} || ' ' END AS customer_id,
  CASE WHEN (k + delivery) % 53 = 0 THEN ' 12 ' WHEN (k + delivery) % 101 = 0 THEN NULL
    ELSE ' ' || {_LETTERS} || ' al-' || lower(c_mktsegment) || ' 3rd' END AS full_name,
  CASE WHEN k % 47 = 0 THEN '' WHEN k % 43 = 0 THEN NULL WHEN (k + delivery) % 41 = 0 THEN '78419901'
    ELSE '784-1990 ' || {_digits("k", 7)} || '/1' END AS emirates_id,
  CASE WHEN k % 37 = 0 THEN NULL WHEN k % 31 = 0 THEN 'no at sign' WHEN k % 29 = 0 THEN 'a@b.co.ae'
    ELSE ' User.' || cast(k as string) || '@Bank' || cast(k % 7 as string) || '.COM ' END AS email,
  CASE WHEN k % 23 = 0 THEN NULL WHEN k % 53 = 0 THEN '' WHEN k % 59 = 0 THEN '00971' || {_digits("k", 9)}
    WHEN k % 2 = 0 THEN '+971 50 ' || {_digits("k", 7)} ELSE '05' || {_digits("k", 8)} END AS phone,
  CASE WHEN k % 103 = 0 THEN ' ' WHEN k % 107 = 0 THEN NULL ELSE CASE k % 9 WHEN 0 THEN ' ae ' WHEN 1 THEN 'united arab emirates' WHEN 2 THEN 'INDIA ' WHEN 3 THEN 'usa'
    WHEN 4 THEN 'egypt' ELSE 'nation ' || cast(c_nationkey as string) END END AS nationality,
  CASE WHEN (k + delivery) % 109 = 0 THEN '2099-05-06'
    ELSE {_mixed_date("1950 + k % 50", "1 + k % 12", "1 + k % 28", "k % 97")} END AS date_of_birth,
  CASE WHEN (k + delivery) % 71 = 0 THEN '2099-01-01' WHEN (k + delivery) % 73 = 0 THEN '1901-01-01'
    ELSE {_mixed_date("2005 + k % 15", "1 + k % 12", "1 + (k + delivery) % 28", "k % 89")} END AS account_opened_date,
  CASE WHEN k % 67 = 0 THEN 'NONE' WHEN c_mktsegment = 'HOUSEHOLD' THEN ' high' WHEN c_mktsegment = 'MACHINERY' THEN 'Medium '
    ELSE 'low' END AS risk_tier,
  CASE WHEN k % 79 = 0 THEN '  ' ELSE ' run-' || cast(delivery as string) END AS adf_run_id,
  CASE WHEN k % 83 = 0 THEN 'no time' ELSE '2024-01-0' || cast(delivery as string) || ' 06:00:00' END AS _ingested_at,
  CASE WHEN k % 113 = 0 THEN ' ' ELSE 'customers_' || cast(delivery as string) || '.csv' END AS source_file
FROM {_twice("c_custkey AS k, c_nationkey, c_mktsegment", "customer")}
"""

ACCOUNTS = f"""
SELECT
  CASE WHEN (k + delivery) % 61 = 0 THEN NULL WHEN (k + delivery) % 59 = 0 THEN 'ACC' || cast(k as string)
    ELSE ' acc-' || {_digits("k", 7)} END AS account_id,
  CASE WHEN k % 53 = 0 THEN NULL WHEN k % 47 = 0 THEN 'CUST99' ELSE 'cust' || {_digits("k", 6)} END AS customer_id,
  CASE WHEN (k + delivery) % 43 = 0 THEN 'loan' ELSE CASE k % 4 WHEN 0 THEN 'salary' WHEN 1 THEN 'Savings '
    WHEN 2 THEN 'credit_card' ELSE 'cur-rent' END END AS account_type,
  CASE WHEN k % 41 = 0 THEN 'frozen' WHEN delivery = 1 THEN 'active' WHEN k % 3 = 0 THEN ' Dormant' ELSE 'CLOSED.' END AS status,
  CASE WHEN k % 37 = 0 THEN 'gbp' WHEN k % 31 = 0 THEN NULL ELSE CASE k % 3 WHEN 0 THEN 'aed' WHEN 1 THEN 'e.u.r' ELSE ' USD' END END AS currency,
  CASE WHEN (k + delivery) % 29 = 0 THEN '2099/12/31'
    ELSE {_mixed_date("2001 + k % 20", "1 + k % 12", "1 + k % 28", "k % 89")} END AS opened_date,
  CASE WHEN k % 79 = 0 THEN '' ELSE 'run-' || cast(delivery as string) END AS adf_run_id,
  CASE WHEN k % 83 = 0 THEN NULL ELSE '2024-01-05 06:00:00' END AS _ingested_at,
  CASE WHEN k % 113 = 0 THEN ' ' ELSE 'accounts_' || cast(delivery as string) || '.csv' END AS source_file
FROM {_twice("c_custkey AS k", "customer")}
"""

TRANSACTIONS = f"""
SELECT
  CASE WHEN k % 997 = 0 THEN NULL WHEN (k + delivery) % 499 = 0 THEN 'TXN' || cast(k as string)
    ELSE ' txn ' || {_digits("k", 14)} END AS transaction_id,
  CASE WHEN k % 211 = 0 THEN 'CARD1' ELSE 'card-' || {_digits("o_custkey", 6)} END AS card_id,
  CASE WHEN k % 223 = 0 THEN NULL ELSE 'Cust ' || {_digits("o_custkey", 6)} END AS customer_id,
  CASE WHEN k % 227 = 0 THEN NULL WHEN k % 229 = 0 THEN 'ACC9999999' ELSE 'acc' || {_digits("o_custkey", 7)} END AS account_id,
  CASE WHEN k % 19 = 0 THEN '  ' WHEN k % 17 = 0 THEN NULL ELSE ' sHOP ' || lower(o_orderpriority) || ' ' END AS merchant,
  CASE WHEN k % 13 = 0 THEN 'n/a' WHEN k % 11 = 0 THEN '99' ELSE ' ' || cast(1000 + k % 9000 as string) || ' ' END AS mcc_code,
  CASE WHEN k % 131 = 0 THEN '0' WHEN k % 137 = 0 THEN '-5' WHEN k % 139 = 0 THEN '--' WHEN k % 149 = 0 THEN NULL
    ELSE 'AED ' || cast(cast(o_totalprice as decimal(18,2)) as string) END AS amount,
  CASE WHEN k % 41 = 0 THEN NULL ELSE CASE k % 3 WHEN 0 THEN 'aed' WHEN 1 THEN 'eur.' ELSE 'GBP' END END AS currency,
  CASE k % 6 WHEN 0 THEN 'abu dhabi' WHEN 1 THEN ' Dubai ' WHEN 2 THEN 'St. Louis' WHEN 3 THEN '123'
    WHEN 4 THEN NULL ELSE 'umm al-quwain' END AS city,
  CASE WHEN k % 151 = 0 THEN 'junk' WHEN k % 157 = 0 THEN '2099-01-01 00:00:00' ELSE ' ' || cast(o_orderdate as string) END AS timestamp,
  CASE WHEN k % 23 = 0 THEN NULL WHEN k % 29 = 0 THEN 'AUTH1' ELSE ' auth' || {_digits("k % 1000000", 6)} END AS auth_code,
  CASE o_orderstatus WHEN 'F' THEN 'approved' WHEN 'O' THEN ' Declined' ELSE 'pending' END AS status,
  CASE WHEN k % 163 = 0 THEN NULL WHEN delivery = 1 THEN substr(cast(o_orderdate as string), 1, 10) || ' 23:59:59' ELSE '2003-01-01 00:00:00' END AS _ingested_at,
  CASE WHEN k % 127 = 0 THEN ' ' ELSE 'run-' || cast(delivery as string) END AS adf_run_id,
  CASE WHEN k % 113 = 0 THEN ' ' ELSE 'transactions_' || cast(delivery as string) || '.json' END AS source_file
FROM {_twice("o_orderkey AS k, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority", "orders")}
"""

SWIPES = f"""
SELECT
  CASE WHEN k % 997 = 0 THEN NULL WHEN k % 499 = 0 THEN 'swipe-' || cast(k as string)
    ELSE ' 0000000a-00bc-4000-8000-' || {_digits("k", 12)} END AS swipe_id,
  CASE WHEN k % 211 = 0 THEN NULL ELSE 'acc' || {_digits("user_id", 7)} END AS account_id,
  CASE WHEN k % 223 = 0 THEN 'CUST1' ELSE 'cust' || {_digits("user_id", 6)} END AS customer_id,
  CASE WHEN k % 227 = 0 THEN 'none' ELSE 'card' || {_digits("user_id", 6)} END AS card_id,
  CASE WHEN k % 131 = 0 THEN '0.00' WHEN k % 137 = 0 THEN NULL ELSE cast(cast(value as decimal(18,2)) as string) || ' AED' END AS amount,
  CASE WHEN k % 29 = 0 THEN '99' WHEN k % 31 = 0 THEN NULL ELSE ' ' || event_type END AS city,
  CASE WHEN k % 139 = 0 THEN '  ' WHEN k % 149 = 0 THEN NULL ELSE ' AE' END AS country,
  CASE k % 4 WHEN 0 THEN 'aed' WHEN 1 THEN 'usd' WHEN 2 THEN 'Eur' ELSE 'inr' END AS currency,
  CASE WHEN k % 151 = 0 THEN '2099-01-01 00:00:00' WHEN k % 157 = 0 THEN '' ELSE cast(ts as string) END AS event_ts,
  CASE WHEN k % 167 = 0 THEN ' ' ELSE 'shop ' || event_type END AS merchant,
  CASE WHEN k % 13 = 0 THEN '' ELSE cast(5000 + k % 6000 as string) END AS mcc_code,
  CASE WHEN event_type = 'error' THEN 'true' WHEN k % 7 = 0 THEN NULL ELSE 'false' END AS _flag_hint,
  CASE WHEN k % 163 = 0 THEN 'no time' ELSE '2024-02-01 00:00:00' END AS ingested_at,
  CASE WHEN k % 173 = 0 THEN ' ' ELSE 'run-7' END AS adf_run_id,
  CASE WHEN k % 179 = 0 THEN NULL ELSE 'swipes.jsonl' END AS file_name
FROM {_twice("event_id AS k, ts, user_id, event_type, value", "events")}
"""

SANCTIONS = f"""
SELECT
  CASE WHEN (k + delivery) % 31 = 0 THEN NULL WHEN (k + delivery) % 29 = 0 THEN 'SANC12' ELSE ' SANC' || {_digits("k", 6)} END AS entry_id,
  CASE WHEN (k + delivery) % 23 = 0 THEN NULL ELSE ' ' || {_LETTERS} || ' al' || lower(c_mktsegment) || ' rd' END AS name,
  CASE WHEN k % 19 = 0 THEN 'not json' WHEN k % 17 = 0 THEN NULL
    ELSE '["' || {_LETTERS} || '", " ' || {_LETTERS} || ' ", "SECOND name"]' END AS aliases,
  CASE WHEN k % 13 = 0 THEN NULL
    ELSE {_mixed_date("1950 + k % 50", "1 + k % 12", "1 + k % 28", "k % 11")} END AS date_of_birth,
  CASE k % 9 WHEN 0 THEN 'AE' WHEN 1 THEN 'United Arab Emirates' WHEN 2 THEN 'India ' WHEN 3 THEN 'USA'
    WHEN 4 THEN 'Egypt' ELSE 'Nation ' || cast(c_nationkey as string) END AS nationality,
  CASE WHEN (k + delivery) % 37 = 0 THEN NULL WHEN k % 2 = 0 THEN 'individual ' ELSE 'Organization' END AS entity_type,
  CASE WHEN (k + delivery) % 41 = 0 THEN NULL WHEN k % 3 = 0 THEN 'UN Consolidated List ' ELSE 'Other list' END AS list_source,
  CASE WHEN k % 43 = 0 THEN NULL WHEN delivery = 2 THEN '2024-01-09 06:00:00' ELSE '2024-01-08 06:00:00' END AS _ingested_at,
  CASE WHEN k % 127 = 0 THEN ' ' ELSE 'run-' || cast(delivery as string) END AS adf_run_id,
  CASE WHEN k % 113 = 0 THEN ' ' ELSE 'list_' || cast(delivery as string) || '.json' END AS source_file
FROM {_twice("c_custkey AS k, c_nationkey, c_mktsegment", "customer")}
"""

# Keys known to the reference checks: customers in credit, with two versions each.
KNOWN_CUSTOMERS = f"""
SELECT 'CUST' || {_digits("k", 6)} AS customer_id,
  CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'HIGH' WHEN 'MACHINERY' THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier, delivery
FROM {_twice("c_custkey AS k, c_mktsegment, c_acctbal", "customer")} WHERE c_acctbal >= 0
"""
KNOWN_ACCOUNTS = f"""
SELECT 'ACC' || {_digits("k", 7)} AS account_id, delivery
FROM {_twice("c_custkey AS k, c_acctbal", "customer")} WHERE c_acctbal >= 1000
"""

# Events as ready swipes, customers with a tier, orders as transactions.
PLAIN_SWIPES = """
SELECT event_id AS swipe_id, user_id AS customer_id, user_id + 1000 AS account_id, event_type AS city,
  ts AS swipe_timestamp, event_type = 'error' AS _flag_hint
FROM {events}
"""
PLAIN_CUSTOMERS = """
SELECT c_custkey AS customer_id,
  CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'HIGH' WHEN 'MACHINERY' THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier
FROM {customer}
"""

# Events as reports of runs: one run per user and day.
RUN_LOG = """
SELECT cast(user_id as string) || ':' || substr(cast(ts as string), 1, 10) AS RunId,
  CASE user_id % 4 WHEN 0 THEN 'ingest' WHEN 1 THEN 'silver' WHEN 2 THEN 'gold' ELSE 'master' END AS PipelineName,
  CASE event_type WHEN 'error' THEN 'Failed' WHEN 'purchase' THEN 'Succeeded' ELSE 'InProgress' END AS Status,
  date_trunc('day', ts) AS Start, ts AS TimeGenerated
FROM {events}
"""

# Orders as monthly snapshots of each customer: the status of the last order of the month.
SNAPSHOT_ROWS = """
SELECT o_custkey AS customer_id, year(o_orderdate) * 12 + month(o_orderdate) AS version, o_orderstatus AS status, o_orderkey
FROM {orders}
"""


def tables_of(text: str) -> set[str]:
    return set(re.findall(r"\{(\w+)\}", text))


def as_spark(spark: SparkSession, folder: str, text: str, tasks: int | None = None) -> DataFrame:
    """The feed as a Spark frame over the tables in ``folder``. With ``tasks`` their rows are dealt to so many before the feed is
    made of them: a file of few row groups is read by few."""
    keep_compiled(spark)
    tables = {t: read_table(spark, f"{folder}/{t}.parquet") for t in tables_of(text)}
    return spark.sql(text, **{t: df.repartition(tasks, *df.columns) if tasks else df for t, df in tables.items()})


def as_sql(text: str) -> str:
    """The feed as SQL over views named like the tables."""
    return text.format(**{t: t for t in tables_of(text)})
