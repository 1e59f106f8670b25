"""Reference SQL for the check queries, in DuckDB's dialect.

Written apart from the Spark code: only the raw feeds are shared.
"""

from __future__ import annotations

from workload import feeds

NOW = f"TIMESTAMP '{feeds.NOW}'"
ORACLES: dict[str, str] = {}


def feed(text: str) -> str:
    return f"({feeds.as_sql(text)})"


# --- expressions -------------------------------------------------------------


def strip(x: str, keep: str) -> str:
    return f"regexp_replace({x}, '[^{keep}]', '', 'g')"


def initcap(x: str) -> str:
    return f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


def name(x: str) -> str:
    return f"trim({initcap(strip(x, 'a-zA-Z' + chr(92) + 's'))})"


def identifier(x: str) -> str:
    return f"upper({strip(x, 'a-zA-Z0-9')})"


def emirates_id(x: str) -> str:
    digits = strip(x, "0-9")
    return f"regexp_replace({digits}, '^(\\d{{3}})(\\d{{4}})(\\d{{7}})(\\d)$', '\\1-\\2-\\3-\\4')"


def phone(x: str) -> str:
    digits = f"regexp_replace({strip(x, '0-9')}, '^0', '971')"
    return f"regexp_replace({digits}, '^(\\d{{3}})(\\d{{2}})(\\d{{3}})(\\d{{4}})$', '+\\1-\\2-\\3-\\4')"


def email(x: str) -> str:
    return strip(f"lower(trim({x}))", "a-zA-Z0-9_@.%+-")


def nationality(x: str) -> str:
    return f"CASE WHEN length(trim({x})) <= 3 THEN upper(trim({x})) ELSE {initcap(f'trim({x})')} END"


def mixed_date(x: str) -> str:
    return (
        f"cast(coalesce(try_strptime(trim({x}), ['%Y-%m-%d', '%d/%m/%Y', '%m-%d-%Y', '%Y/%m/%d']),"
        f" try_cast(trim({x}) AS DATE)) AS DATE)"
    )


def amount(x: str) -> str:
    return f"try_cast({strip(x, '0-9.-')} AS DECIMAL(18,2))"


def moment(x: str) -> str:
    return f"try_cast(trim({x}) AS TIMESTAMP)"


def city(x: str) -> str:
    shown = f"upper(trim({x}))"
    return f"CASE WHEN regexp_matches({shown}, '^[\\p{{L}}]+([ .''-][\\p{{L}}]+)*$') THEN {shown} END"


def aliases(x: str) -> str:
    """The list as text; double quotes never occur inside a name here."""
    parsed = f"(CASE WHEN json_valid({x}) THEN from_json({x}, '[\"VARCHAR\"]') END)"
    capital = initcap("trim(a)").replace("lambda w", "lambda v").replace("upper(w[1]) || w[2:]", "upper(v[1]) || v[2:]")
    named = f"list_transform({parsed}, lambda a: {capital})"
    return f"list_filter({named}, lambda a, i: list_position({named}, a) = i)"


def date_text(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def time_text(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def list_text(x: str) -> str:
    return f"array_to_string({x}, '|')"


# --- sources -----------------------------------------------------------------

ORACLES["scan_lineage"] = "SELECT o_orderkey, 'orders.parquet' AS source_file, 'run-1' AS adf_run_id FROM orders"
ORACLES["control_active_sources"] = (
    "SELECT p_brand AS source_folder, cast(p_partkey AS VARCHAR) || '*.csv' AS source_file, true AS is_active"
    " FROM part WHERE p_size > 25"
)
ORACLES["rescued_fields"] = (
    "SELECT event_id, cast(NULL AS VARCHAR) AS colour,"
    " '{\"k\":\"' || json_extract_string(props, '$.k') || '\"}' AS _rescued_data FROM events"
)

# --- cleaning ----------------------------------------------------------------

ORACLES["clean_name"] = (
    f"SELECT full_name, {name('full_name')} AS clean_name, trim({initcap('full_name')}) AS clean_merchant,"
    f" upper(trim(full_name)) AS clean_text FROM {feed(feeds.CUSTOMERS)}"
)
ORACLES["clean_ids"] = (
    f"SELECT {identifier('transaction_id')} AS transaction_id, {identifier('card_id')} AS card_id,"
    f" {identifier('customer_id')} AS customer_id, {identifier('account_id')} AS account_id FROM {feed(feeds.TRANSACTIONS)}"
)


def _cleaned(query: str, expression: str, column: str, text: str) -> None:
    ORACLES[query] = f"SELECT {column}, {expression} AS cleaned FROM {feed(text)}"


_cleaned("clean_emirates_id", emirates_id("emirates_id"), "emirates_id", feeds.CUSTOMERS)
_cleaned("clean_phone", phone("phone"), "phone", feeds.CUSTOMERS)
_cleaned("clean_email", email("email"), "email", feeds.CUSTOMERS)
_cleaned("clean_nationality", nationality("nationality"), "nationality", feeds.CUSTOMERS)
_cleaned("clean_city", city("city"), "city", feeds.TRANSACTIONS)
_cleaned("parse_mcc_code", "try_cast(trim(mcc_code) AS INTEGER)", "mcc_code", feeds.TRANSACTIONS)
_cleaned("parse_amount", f"cast({amount('amount')} AS DOUBLE)", "amount", feeds.TRANSACTIONS)
_cleaned("parse_timestamps", time_text(moment('"timestamp"')), '"timestamp"', feeds.TRANSACTIONS)
_cleaned("parse_mixed_date", date_text(mixed_date("opened_date")), "opened_date", feeds.ACCOUNTS)
_cleaned("aliases_array", list_text(aliases("aliases")), "aliases", feeds.SANCTIONS)
ORACLES["clean_codes"] = (
    f"SELECT upper({strip('account_type', 'a-zA-Z_')}) AS account_type, upper({strip('status', 'a-zA-Z')}) AS account_status,"
    f" upper({strip('currency', 'a-zA-Z')}) AS account_currency FROM {feed(feeds.ACCOUNTS)}"
)

# --- silver domains ----------------------------------------------------------

_PROVENANCE = {"adf_run_id": "trim(adf_run_id)", "_ingested_at": moment("_ingested_at"), "source_file": "trim(source_file)"}
_PAYMENT = {
    "card_id": identifier("card_id"),
    "customer_id": identifier("customer_id"),
    "account_id": identifier("account_id"),
    "merchant": f"trim({initcap('merchant')})",
    "mcc_code": "try_cast(trim(mcc_code) AS INTEGER)",
    "city": city("city"),
}

# Cleaned columns by domain; raw columns that stay until the split come along.
CLEANED = {
    "customers": {
        "customer_id": identifier("customer_id"),
        "full_name": name("full_name"),
        "emirates_id": emirates_id("emirates_id"),
        "email": email("email"),
        "phone": phone("phone"),
        "nationality": nationality("nationality"),
        "date_of_birth": mixed_date("date_of_birth"),
        "account_opened_date": mixed_date("account_opened_date"),
        "risk_tier": "upper(trim(risk_tier))",
        **_PROVENANCE,
    },
    "accounts": {
        "account_id": identifier("account_id"),
        "customer_id": identifier("customer_id"),
        "account_type": f"upper({strip('account_type', 'a-zA-Z_')})",
        "account_status": f"upper({strip('status', 'a-zA-Z')})",
        "account_currency": f"upper({strip('currency', 'a-zA-Z')})",
        "opened_date": mixed_date("opened_date"),
        **_PROVENANCE,
    },
    "transactions": {
        "transaction_id": identifier("transaction_id"),
        **_PAYMENT,
        "amount": "amount",
        "transaction_amount": amount("amount"),
        "account_currency": f"upper({strip('currency', 'a-zA-Z')})",
        "transaction_timestamp": moment('"timestamp"'),
        "auth_code": "upper(trim(auth_code))",
        "transaction_status": "upper(trim(status))",
        **_PROVENANCE,
    },
    "swipes": {
        "swipe_id": "trim(swipe_id)",
        **_PAYMENT,
        "card_swipe_amount": amount("amount"),
        "country": "trim(country)",
        "swipe_card_currency": f"upper({strip('currency', 'a-zA-Z')})",
        "swipe_timestamp": moment("event_ts"),
        "_flag_hint": "_flag_hint",
        "_ingested_at": moment("ingested_at"),
        "adf_run_id": "trim(adf_run_id)",
        "source_file": "trim(file_name)",
    },
    "sanctions": {
        "entry_id": "trim(entry_id)",
        "name": initcap("trim(name)"),
        "aliases": aliases("aliases"),
        "date_of_birth": mixed_date("date_of_birth"),
        "nationality": "trim(nationality)",
        "entity_type": "upper(trim(entity_type))",
        "list_source": "trim(list_source)",
        **_PROVENANCE,
    },
}
FEED_OF = {
    "customers": feeds.CUSTOMERS,
    "accounts": feeds.ACCOUNTS,
    "transactions": feeds.TRANSACTIONS,
    "swipes": feeds.SWIPES,
    "sanctions": feeds.SANCTIONS,
}
KEY = {
    "customers": "customer_id",
    "accounts": "account_id",
    "transactions": "transaction_id",
    "swipes": "swipe_id",
    "sanctions": "entry_id",
}
# Raw columns that the cleaned frame still carries beside the cleaned ones.
RAW = {
    "accounts": ["status", "currency"],
    "transactions": ["currency", '"timestamp"', "status"],
    "swipes": ["amount", "currency", "event_ts", "ingested_at", "file_name"],
}

DATES = {"date_of_birth", "account_opened_date", "opened_date"}
TIMES = {"_ingested_at", "transaction_timestamp", "swipe_timestamp"}
MONEY = {"transaction_amount", "card_swipe_amount"}


def shown(column: str) -> str:
    if column in DATES:
        return f"{date_text(column)} AS {column}"
    if column in TIMES:
        return f"{time_text(column)} AS {column}"
    if column in MONEY:
        return f"cast({column} AS DOUBLE) AS {column}"
    if column in {"aliases", "rejected_reasons"}:
        return f"{list_text(column)} AS {column}"
    return column


def cleaned(domain: str) -> str:
    columns = ", ".join(f"{x} AS {c}" for c, x in CLEANED[domain].items())
    return f"(SELECT {columns} FROM {feed(FEED_OF[domain])})"


_CUSTOMER = "regexp_full_match(customer_id, 'CUST[0-9]{6}')"
_ACCOUNT = "regexp_full_match(account_id, 'ACC[0-9]{7}')"
_CARD = "regexp_full_match(card_id, 'CARD[0-9]{6}')"
_TRANSACTION = "regexp_full_match(transaction_id, 'TXN[0-9]{14}')"
_SWIPE = "regexp_full_match(swipe_id, '[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}')"
_EMIRATES = "regexp_full_match(emirates_id, '[0-9]{3}-[0-9]{4}-[0-9]{7}-[0-9]')"
_EMAIL = "regexp_full_match(email, '[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\\.[a-zA-Z]+')"
_PHONE = "regexp_full_match(phone, '[+]971-[0-9]{2}-[0-9]{3}-[0-9]{4}')"
_AUTH = "regexp_full_match(auth_code, 'AUTH[0-9]{6}')"
_SANCTION = "regexp_full_match(entry_id, 'SANC[0-9]{4,}')"
_CITY = "regexp_full_match(city, '\\p{L}+([ .''-]\\p{L}+)*')"
_TODAY = f"cast({NOW} AS DATE)"
_TIERS = "('LOW', 'MEDIUM', 'HIGH')"
_TYPES = "('SALARY', 'SAVINGS', 'CREDIT_CARD', 'CURRENT')"
_STATUSES = "('ACTIVE', 'DORMANT', 'CLOSED')"
_CURRENCIES = "('AED', 'EUR', 'USD')"


def _empty(c: str) -> str:
    return f"{c} IS NULL OR trim({c}) = ''"


def _full(c: str) -> str:
    return f"{c} IS NOT NULL AND trim({c}) <> ''"


# Condition under which each rejection code is given.
REJECTIONS = {
    "customers": {
        "INVALID_CUSTOMER_ID_FORMAT": f"customer_id IS NULL OR NOT {_CUSTOMER}",
        "FULL_NAME_IS_NOT_PROVIDED": _empty("full_name"),
        "EMIRATES_ID_NOT_PROVIDED": _empty("emirates_id"),
        "INVALID_EMIRATES_ID_FORMAT": f"NOT {_EMIRATES}",
        "NATIONALIITY_IS_NOT_PROVIDED": _empty("nationality"),
        "DATE_OF_BIRTH_NOT_PROVIDED": "date_of_birth IS NULL",
        "DATE_OF_BIRTH_IN_FUTURE": f"date_of_birth > {_TODAY}",
        "ACCOUNT_OPENED_DATE_NOT_PROVIDED": "account_opened_date IS NULL",
        "ACCOUNT_OPENED_DATE_IN_FUTURE": f"account_opened_date > {_TODAY}",
        "ACCOUNT_OPENED_DATE_BEFORE_DOB": "account_opened_date < date_of_birth",
        "INVALID_RISK_TIER": f"risk_tier IS NULL OR risk_tier NOT IN {_TIERS}",
        "INVALID_EMAIL_FORMAT": f"NOT {_EMAIL}",
        "INVALID_PHONE_FORMAT": f"NOT {_PHONE}",
        "ADF_RUN_ID_IS_NOT_PROVIDED": _empty("adf_run_id"),
        "INGESTION_DATE_IS_NOT_PROVIDED": "_ingested_at IS NULL",
    },
    "accounts": {
        "INVALID_CUSTOMER_ID_FORMAT": f"customer_id IS NULL OR NOT {_CUSTOMER}",
        "CUSTOMER_NOT_FOUND": "customer_id IS NOT NULL AND NOT customer_known",
        "INVALID_ACCOUNT_ID_FORMAT": f"account_id IS NULL OR NOT {_ACCOUNT}",
        "INVALID_ACCOUNT_TYPE": f"account_type IS NULL OR account_type NOT IN {_TYPES}",
        "INVALID_ACCOUNT_STATUS": f"account_status IS NULL OR account_status NOT IN {_STATUSES}",
        "INVALID_ACCOUNT_CURRENCY": f"account_currency IS NULL OR account_currency NOT IN {_CURRENCIES}",
        "OPENED_DATE_REQUIRED": "opened_date IS NULL",
        "OPENED_DATE_IN_FUTURE": f"opened_date > {_TODAY}",
        "INVALID_ADF_RUN_ID": _empty("adf_run_id"),
        "INVALID_INGESTED_AT": "_ingested_at IS NULL",
    },
    "transactions": {
        "INVALID_TRANSACTION_ID": f"transaction_id IS NULL OR NOT {_TRANSACTION}",
        "INVALID_CARD_ID": f"card_id IS NULL OR NOT {_CARD}",
        "INVALID_CUSTOMER_ID": f"customer_id IS NULL OR NOT {_CUSTOMER}",
        "CUSTOMER_ID_DOES_NOT_EXIST": "customer_id IS NOT NULL AND NOT customer_known",
        "INVALID_ACCOUNT_ID": f"account_id IS NULL OR NOT {_ACCOUNT}",
        "ACCOUNT_ID_DOES_NOT_EXIST": "account_id IS NOT NULL AND NOT account_known",
        "INVALID_TRANSACTION_AMOUNT": "transaction_amount IS NULL OR transaction_amount <= 0",
        "INVALID_TRANSACTION_TIMESTAMP": f"transaction_timestamp IS NULL OR transaction_timestamp > {NOW}",
        "INVALID_AUTH_CODE": f"transaction_status = 'APPROVED' AND (auth_code IS NULL OR NOT {_AUTH})",
        "INVALID_TRANSACTION_STATUS": "transaction_status IS NULL OR transaction_status NOT IN ('APPROVED', 'DECLINED')",
    },
    "swipes": {
        "INVALID_SWIPE_ID": f"swipe_id IS NULL OR NOT {_SWIPE}",
        "INVALID_CUSTOMER_ID": f"customer_id IS NULL OR NOT {_CUSTOMER}",
        "CUSTOMER_ID_DOES_NOT_EXIST": "customer_id IS NOT NULL AND NOT customer_known",
        "INVALID_ACCOUNT_ID": f"account_id IS NULL OR NOT {_ACCOUNT}",
        "ACCOUNT_ID_DOES_NOT_EXIST": "account_id IS NOT NULL AND NOT account_known",
        "INVALID_CARD_ID": f"card_id IS NULL OR NOT {_CARD}",
        "INVALID_COUNTRY": _empty("country"),
        "INVALID_CARD_SWIPE_AMOUNT": "card_swipe_amount IS NULL OR card_swipe_amount <= 0",
        "INVALID_TIMESTAMP": f"swipe_timestamp IS NULL OR swipe_timestamp > {NOW}",
    },
    "sanctions": {
        "INVALID_ENTITY_TYPE": "entity_type IS NULL",
        "INVALID_LIST_SOURCE": "list_source IS NULL",
        "INVALID_NAME": "name IS NULL",
        "INVALID_ENTRY_ID": f"entry_id IS NULL OR NOT {_SANCTION}",
    },
}

# Condition that should hold, by expectation name.
HOLDS = {
    "customers": {
        "valid_customer_id_format": _CUSTOMER,
        "valid_full_name": _full("full_name"),
        "emirates_id_present": _full("emirates_id"),
        "valid_emirates_id_format": _EMIRATES,
        "valid_nationality": _full("nationality"),
        "dob_not_in_future": f"date_of_birth <= {_TODAY}",
        "account_opened_date_not_in_future": f"account_opened_date <= {_TODAY}",
        "account_opened_after_dob": "account_opened_date >= date_of_birth",
        "valid_risk_tier": f"risk_tier IN {_TIERS}",
        "valid_email_format": f"email IS NULL OR {_EMAIL}",
        "valid_phone_format": f"phone IS NULL OR {_PHONE}",
    },
    "accounts": {
        "valid_account_id_format": _ACCOUNT,
        "valid_customer_id_format": _CUSTOMER,
        "valid_account_type": f"account_type IN {_TYPES}",
        "valid_account_status": f"account_status IN {_STATUSES}",
        "valid_account_currency": f"account_currency IN {_CURRENCIES}",
        "valid_opened_required": "opened_date IS NOT NULL",
        "valid_opened_date": f"opened_date <= {_TODAY}",
    },
    "transactions": {
        "valid_transaction_id": f"transaction_id IS NOT NULL AND {_TRANSACTION}",
        "valid_card_id": f"card_id IS NOT NULL AND {_CARD}",
        "valid_customer_id": f"customer_id IS NOT NULL AND {_CUSTOMER}",
        "valid_account_id": f"account_id IS NOT NULL AND {_ACCOUNT}",
        "valid_transaction_amount": "transaction_amount IS NOT NULL AND transaction_amount > 0",
        "valid_transaction_timestamp": f"transaction_timestamp IS NOT NULL AND transaction_timestamp <= {NOW}",
        "valid_account_currency": f"account_currency IS NOT NULL AND account_currency IN {_CURRENCIES}",
        "valid_city": f"city IS NULL OR {_CITY}",
        "valid_transaction_status": "transaction_status IN ('APPROVED', 'DECLINED')",
        "valid_mcc_code": "mcc_code IS NULL OR mcc_code BETWEEN 1000 AND 9999",
        "valid_merchant": "merchant IS NULL OR trim(merchant) <> ''",
        "valid_auth_code": f"transaction_status <> 'APPROVED' OR (auth_code IS NOT NULL AND {_AUTH})",
    },
    "swipes": {
        "valid_card_id": f"card_id IS NOT NULL AND {_CARD}",
        "valid_customer_id": f"customer_id IS NOT NULL AND {_CUSTOMER}",
        "valid_account_id": f"account_id IS NOT NULL AND {_ACCOUNT}",
        "valid_swipe_id": f"swipe_id IS NOT NULL AND {_SWIPE}",
        "valid_card_swipe_amount": "card_swipe_amount IS NOT NULL AND card_swipe_amount > 0",
        "valid_swipe_timestamp": f"swipe_timestamp IS NOT NULL AND swipe_timestamp <= {NOW}",
        "valid_country": _full("country"),
        "valid_city": f"city IS NULL OR {_CITY}",
        "valid_swipe_card_currency": f"swipe_card_currency IS NOT NULL AND swipe_card_currency IN {_CURRENCIES}",
        "valid_mcc_code": "mcc_code IS NULL OR mcc_code BETWEEN 1000 AND 9999",
        "valid_merchant": "merchant IS NULL OR trim(merchant) <> ''",
    },
    "sanctions": {
        "valid_entity_type": "entity_type IS NOT NULL AND entity_type IN ('INDIVIDUAL', 'ORGANIZATION')",
        "valid_list_source": "list_source IS NOT NULL AND list_source IN"
        " ('EU Sanctions (mock)', 'UN Consolidated List', 'OFAC SDN (mock)')",
        "valid_name": _full("name"),
        "valid_entry_id": f"entry_id IS NOT NULL AND {_SANCTION}",
    },
}
for _rules in HOLDS.values():
    _rules["valid_adf_run_id"] = _full("adf_run_id")
    _rules["valid_ingested_at"] = "_ingested_at IS NOT NULL"
    _rules["valid_source_file"] = _full("source_file")


def judged(domain: str) -> str:
    """Cleaned rows with their reasons."""
    known = []
    if domain in {"accounts", "transactions", "swipes"}:
        known.append(
            f"customer_id IN (SELECT customer_id FROM {feed(feeds.KNOWN_CUSTOMERS)}) AS customer_known"
        )
    if domain in {"transactions", "swipes"}:
        known.append(f"account_id IN (SELECT account_id FROM {feed(feeds.KNOWN_ACCOUNTS)}) AS account_known")
    flagged = f"(SELECT {', '.join(['*', *known])} FROM {cleaned(domain)})"
    cases = ", ".join(f"CASE WHEN {x} THEN '{code}' END" for code, x in REJECTIONS[domain].items())
    late = (
        ", _ingested_at > transaction_timestamp + INTERVAL 24 HOUR AS is_late_arrival" if domain == "transactions" else ""
    )
    return (
        f"(SELECT {', '.join(published(domain))}{late},"
        f" list_filter([{cases}], lambda r: r IS NOT NULL) AS rejected_reasons FROM {flagged})"
    )


def published(domain: str) -> list[str]:
    return list(CLEANED[domain])


def outputs(domain: str) -> list[str]:
    return published(domain) + (["is_late_arrival"] if domain == "transactions" else [])


def newest(rows: str, domain: str) -> str:
    order = ["_ingested_at", "source_file", *[c for c in outputs(domain) if c not in {KEY[domain], "_ingested_at", "source_file"}]]
    ordering = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    return f"(SELECT * FROM {rows} QUALIFY row_number() OVER (PARTITION BY {KEY[domain]} ORDER BY {ordering}) = 1)"


def accepted(domain: str) -> str:
    return newest(f"(SELECT * FROM {judged(domain)} WHERE len(rejected_reasons) = 0)", domain)


def metrics(rows: str, holds: dict[str, str]) -> str:
    return f"WITH c AS MATERIALIZED (SELECT * FROM {rows}) " + " UNION ALL ".join(
        f"SELECT '{n}' AS expectation, count(*) FILTER (WHERE {x}) AS passed, count(*) FILTER (WHERE NOT ({x})) AS failed,"
        f" count(*) FILTER (WHERE ({x}) IS NULL) AS unknown FROM c"
        for n, x in holds.items()
    )


def view(columns: list[str], rows: str) -> str:
    return f"SELECT {', '.join(shown(c) for c in columns)} FROM {rows}"


for _domain in CLEANED:
    _raw = RAW.get(_domain, [])
    _columns = ", ".join([f"{x} AS {c}" for c, x in CLEANED[_domain].items()] + [f"{r} AS {r}" for r in _raw])
    ORACLES[f"project_{_domain}"] = (
        f"SELECT {', '.join([shown(c) for c in published(_domain)] + _raw)}"
        f" FROM (SELECT {_columns} FROM {feed(FEED_OF[_domain])})"
    )
    _bad = f"(SELECT * FROM {judged(_domain)} WHERE len(rejected_reasons) > 0)"
    if _domain == "sanctions":
        _bad = newest(_bad, _domain)
    ORACLES[f"reject_{_domain}"] = view([*outputs(_domain), "rejected_reasons"], _bad)
    ORACLES[f"clean_{_domain}"] = view(outputs(_domain), accepted(_domain))
    ORACLES[f"dq_metrics_{_domain}"] = metrics(cleaned(_domain), HOLDS[_domain])

# Three deliveries come to the same rows as one.
ORACLES["silver_incremental"] = ORACLES["clean_transactions"]
ORACLES["rejects_incremental"] = ORACLES["reject_transactions"]

ORACLES["late_arrivals"] = """
SELECT l_returnflag, l_shipdate > o_orderdate + INTERVAL 24 HOUR AS is_late_arrival, count(*) AS n
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL"""

# --- alerts ------------------------------------------------------------------

_FRAUD = f"""
SELECT swipe_id, customer_id, risk_score, hint_score, risk_score + hint_score AS fraud_score FROM (
  SELECT s.swipe_id, s.customer_id,
    cast(CASE risk_tier WHEN 'HIGH' THEN 0.6 WHEN 'MEDIUM' THEN 0.3 ELSE 0.1 END AS DOUBLE) AS risk_score,
    cast(CASE WHEN _flag_hint THEN 0.4 ELSE 0 END AS DOUBLE) AS hint_score
  FROM {feed(feeds.PLAIN_SWIPES)} s JOIN {feed(feeds.PLAIN_CUSTOMERS)} c ON s.customer_id = c.customer_id)
WHERE risk_score + hint_score >= 0.5"""


def _velocity_sql(closed_only: bool = False) -> str:
    closed = ""
    if closed_only:
        closed = " AND b + INTERVAL 5 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"
    return f"""
SELECT customer_id, {time_text('b')} AS window_start, {time_text('b + INTERVAL 5 MINUTE')} AS window_end,
  count(*) AS swipe_count, cast(count(DISTINCT city) AS INTEGER) AS distinct_city_count
FROM (SELECT *, time_bucket(INTERVAL 5 MINUTE, swipe_timestamp) AS b FROM {feed(feeds.PLAIN_SWIPES)})
GROUP BY customer_id, b HAVING count(DISTINCT city) >= 2{closed}"""


ORACLES["fraud_alerts"] = _FRAUD
ORACLES["velocity_alerts"] = _velocity_sql()
ORACLES["all_alerts"] = (
    f"SELECT *, 'risk_hint' AS alert_type FROM ({_FRAUD}) UNION ALL BY NAME"
    f" SELECT *, 'velocity' AS alert_type FROM ({_velocity_sql()})"
)
_HITS = f"""
SELECT sha256(c.customer_id || '||' || s.entry_id) AS hit_id, c.customer_id, c.full_name, s.entry_id, s.list_source
FROM {accepted("customers")} c JOIN {accepted("sanctions")} s
  ON c.full_name = s.name AND c.date_of_birth = s.date_of_birth AND c.nationality = s.nationality"""
ORACLES["sanction_hits"] = _HITS
ORACLES["sanction_alerts_transactions"] = f"""
SELECT h.customer_id, h.full_name, h.entry_id, h.list_source, t.transaction_id, t.account_id
FROM ({_HITS}) h JOIN {accepted("transactions")} t ON h.customer_id = t.customer_id"""
ORACLES["sanction_alerts_swipes"] = f"""
SELECT h.customer_id, h.full_name, h.entry_id, h.list_source, t.swipe_id, t.account_id
FROM ({_HITS}) h JOIN {accepted("swipes")} t ON h.customer_id = t.customer_id"""

# --- gold --------------------------------------------------------------------

ORACLES["dim_date"] = f"""
SELECT cast(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, {date_text('d')} AS "date", cast(day(d) AS INTEGER) AS "day",
  cast(month(d) AS INTEGER) AS "month", monthname(d) AS month_name, cast(quarter(d) AS INTEGER) AS "quarter",
  cast(year(d) AS INTEGER) AS "year", dayofweek(d) IN (0, 6) AS is_weekend, coalesce(n, 0) AS events
FROM (SELECT cast(unnest(generate_series(DATE '2020-01-01', DATE '2031-12-31', INTERVAL 1 DAY)) AS DATE) AS d)
LEFT JOIN (SELECT cast(ts AS DATE) AS on_day, count(*) AS n FROM events GROUP BY 1) ON d = on_day"""
ORACLES["gold_fact_transactions"] = ORACLES["clean_transactions"]
ORACLES["gold_dim_customers"] = view(
    [c for c in outputs("customers") if c != "account_opened_date"], accepted("customers")
)
ORACLES["gold_dim_accounts"] = ORACLES["clean_accounts"]

# --- masking -----------------------------------------------------------------


def _mask(x: str, category: str) -> str:
    if category == "national_id":
        return f"'***-' || right({x}, 4)"
    if category == "email":
        return (
            f"CASE WHEN instr({x}, '@') = 0 THEN '***MASKED***'"
            f" ELSE substr({x}, 1, 3) || '***@***' || substr({x}, instr({x}, '@') + 1) END"
        )
    if category == "phone":
        return f"substr({x}, 1, 4) || '******' || right({x}, 2)"
    return "'***MASKED***'"


ORACLES["mask_pii"] = f"""
SELECT email, phone, {_mask('emirates_id', 'national_id')} AS masked_id, {_mask('email', 'email')} AS masked_email,
  {_mask('phone', 'phone')} AS masked_phone, '***MASKED***' AS masked_other,
  CASE WHEN risk_tier = 'low' THEN {_mask('email', 'email')} ELSE {_mask('email', 'phone')} END AS masked_by_column
FROM {feed(feeds.CUSTOMERS)}"""
_MASKED = {"emirates_id": "national_id", "email": "email", "phone": "phone"}
ORACLES["masked_view_analyst"] = (
    "SELECT "
    + ", ".join(f"{_mask(c, _MASKED[c])} AS {c}" if c in _MASKED else shown(c) for c in published("customers"))
    + f" FROM {cleaned('customers')}"
)
ORACLES["masked_view_compliance"] = view(published("customers"), cleaned("customers"))

# --- history -----------------------------------------------------------------

_SNAPSHOTS = (
    f"(SELECT customer_id, version, arg_max(status, o_orderkey) AS status FROM {feed(feeds.SNAPSHOT_ROWS)} GROUP BY ALL)"
)
_HISTORY = f"""
WITH snaps AS {_SNAPSHOTS},
versions AS (SELECT version, row_number() OVER (ORDER BY version) AS n, lead(version) OVER (ORDER BY version) AS after
  FROM (SELECT DISTINCT version FROM snaps)),
marked AS (SELECT s.*, v.n, v.after, CASE WHEN lag(v.n) OVER w = v.n - 1 AND lag(s.status) OVER w = s.status THEN 0 ELSE 1 END AS opens
  FROM snaps s JOIN versions v ON s.version = v.version WINDOW w AS (PARTITION BY customer_id ORDER BY v.n)),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY customer_id ORDER BY n) AS stretch FROM marked)
SELECT customer_id, any_value(status) AS status, min(version) AS __START_AT, arg_max(coalesce(after, -1), n) AS end_at
FROM numbered GROUP BY customer_id, stretch"""
_HISTORY_ROWS = (
    f"(SELECT customer_id, status, cast(__START_AT AS INTEGER) AS __START_AT,"
    f" cast(nullif(end_at, -1) AS INTEGER) AS __END_AT FROM ({_HISTORY}))"
)
ORACLES["scd2_history"] = f"SELECT * FROM {_HISTORY_ROWS}"
_NEXT = "(SELECT c_custkey AS customer_id, CASE WHEN c_acctbal < 5000 THEN 'F' ELSE 'O' END AS status FROM customer WHERE c_acctbal >= 0)"
ORACLES["scd2_next_snapshot"] = f"""
WITH h AS MATERIALIZED (SELECT * FROM {_HISTORY_ROWS}), open AS (SELECT * FROM h WHERE __END_AT IS NULL), s AS {_NEXT}
SELECT * FROM h WHERE __END_AT IS NOT NULL
UNION ALL SELECT o.* FROM open o WHERE EXISTS (SELECT 1 FROM s WHERE s.customer_id = o.customer_id AND s.status = o.status)
UNION ALL SELECT o.customer_id, o.status, o.__START_AT, 99999 FROM open o
  WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.customer_id = o.customer_id AND s.status = o.status)
UNION ALL SELECT s.customer_id, s.status, 99999, NULL FROM s
  WHERE NOT EXISTS (SELECT 1 FROM open o WHERE s.customer_id = o.customer_id AND s.status = o.status)"""
ORACLES["scd2_current"] = f"SELECT customer_id, status FROM ({ORACLES['scd2_next_snapshot']}) WHERE __END_AT IS NULL"
ORACLES["scd1_current"] = f"""
WITH o AS (SELECT customer_id, arg_max(status, o_orderkey) AS status FROM {feed(feeds.SNAPSHOT_ROWS)} GROUP BY ALL), s AS {_NEXT}
SELECT s.customer_id, s.status, CASE WHEN o.status = s.status THEN 'old' ELSE 'new' END AS source_file
FROM s LEFT JOIN o ON s.customer_id = o.customer_id"""

# --- monitoring --------------------------------------------------------------

_LIMITS = "(VALUES ('ingest', 15), ('silver', 10), ('gold', 10), ('master', 40)) AS limits(PipelineName, minutes)"
_LATE = f"""
SELECT RunId, PipelineName, Status, Start, TimeGenerated, date_diff('minute', Start, {NOW}) AS RunningMinutes
FROM (SELECT * FROM {feed(feeds.RUN_LOG)} QUALIFY row_number() OVER (PARTITION BY RunId
  ORDER BY TimeGenerated DESC, Status <> 'InProgress' DESC, Status DESC) = 1)
JOIN {_LIMITS} USING (PipelineName)
WHERE Status = 'InProgress' AND date_diff('minute', Start, {NOW}) > minutes"""


def _sliding(rows: str) -> str:
    """15-minute windows opening every 10 minutes, aligned to the epoch."""
    return f"""
SELECT PipelineName, {time_text('w')} AS window_start, {time_text('w + INTERVAL 15 MINUTE')} AS window_end, count(*) AS total
FROM (SELECT PipelineName, TimeGenerated, unnest([time_bucket(INTERVAL 10 MINUTE, TimeGenerated),
        time_bucket(INTERVAL 10 MINUTE, TimeGenerated) - INTERVAL 10 MINUTE]) AS w FROM ({rows}))
WHERE TimeGenerated < w + INTERVAL 15 MINUTE GROUP BY PipelineName, w"""


ORACLES["recent_alert_count"] = """
SELECT count(*) AS fraud_count, count(*) > 10 AS breached FROM events
WHERE ts > TIMESTAMP '2024-01-15 11:00:00' AND ts <= TIMESTAMP '2024-01-15 12:00:00'"""
ORACLES["late_runs"] = (
    f"SELECT RunId, PipelineName, Status, {time_text('Start')} AS Start, {time_text('TimeGenerated')} AS TimeGenerated,"
    f" RunningMinutes FROM ({_LATE})"
)
ORACLES["late_run_alerts"] = (
    f"SELECT PipelineName, {time_text('w')} AS window_start, late_runs FROM"
    f" (SELECT PipelineName, time_bucket(INTERVAL 5 MINUTE, TimeGenerated) AS w, count(*) AS late_runs FROM ({_LATE}) GROUP BY ALL)"
)
ORACLES["sliding_breaches"] = _sliding(f"SELECT * FROM {feed(feeds.RUN_LOG)} WHERE Status = 'Failed'")
ORACLES["overtime_breaches"] = _sliding(
    f"SELECT * FROM {feed(feeds.RUN_LOG)} JOIN {_LIMITS} USING (PipelineName)"
    " WHERE Status <> 'InProgress' AND floor(epoch(TimeGenerated)) - floor(epoch(Start)) > 60 * minutes"
)
ORACLES["duration_breaches"] = """
SELECT job, limit_seconds, count(*) AS runs, max(run_seconds) AS longest FROM (
  SELECT CASE l_returnflag WHEN 'A' THEN 'bronze' WHEN 'N' THEN 'silver' ELSE 'gold' END AS job,
    CASE l_returnflag WHEN 'A' THEN 900 ELSE 600 END AS limit_seconds, cast(l_quantity * 30 AS BIGINT) AS run_seconds FROM lineitem)
WHERE run_seconds > limit_seconds GROUP BY ALL"""

# --- writers -----------------------------------------------------------------

ORACLES["clustered_table"] = (
    "SELECT l_suppkey, count(*) AS lines, cast(sum(cast(l_quantity AS BIGINT)) AS BIGINT) AS quantity, cast(0 AS BIGINT) AS unordered,"
    " false AS overlaps FROM lineitem GROUP BY ALL"
)
ORACLES["curve_table"] = (
    "SELECT count(*) AS lines, cast(sum(cast(l_quantity AS BIGINT)) AS BIGINT) AS quantity, true AS narrow_supplier,"
    " true AS narrow_date FROM lineitem"
)
ORACLES["balanced_table"] = "SELECT o_orderstatus, count(*) AS orders, max(o_orderkey) AS last_order, false AS crumbs FROM orders GROUP BY ALL"

# --- streams -----------------------------------------------------------------

_EVENT_SWIPES = f"SELECT swipe_id, customer_id, account_id, city, {time_text('swipe_timestamp')} AS swipe_timestamp, _flag_hint FROM {feed(feeds.PLAIN_SWIPES)}"
ORACLES["stream_dedup_swipes"] = _EVENT_SWIPES
ORACLES["stream_fact_swipes"] = _EVENT_SWIPES
ORACLES["stream_velocity"] = _velocity_sql(closed_only=True)
ORACLES["stream_fraud_alerts"] = _FRAUD
ORACLES["stream_ingest_rescued"] = (
    "SELECT cast(event_id AS VARCHAR) AS swipe_id, event_type AS city,"
    " '{\"user_id\":\"' || cast(user_id AS VARCHAR) || '\"}' AS _rescued_data, 'run-1' AS adf_run_id FROM events"
)
_FLOW_STAMPS = {"source_file": "valid_source_file", "adf_run_id": "valid_adf_run_id", "_ingested_at": "valid_ingested_at"}
_SWIPE_COLUMNS = [c for c in outputs("swipes") if c != "source_file"]


def _stamped(rows: str) -> str:
    """Rows with the run and the time the flow took them in, in place of the feed's."""
    return f"(SELECT * REPLACE ('run-7' AS adf_run_id, {NOW} AS _ingested_at) FROM {rows})"


ORACLES["stream_swipes_valid"] = view(_SWIPE_COLUMNS, _stamped(accepted("swipes")))
ORACLES["stream_swipes_rejected"] = view(
    [*_SWIPE_COLUMNS, "rejected_reasons"], _stamped(f"(SELECT * FROM {judged('swipes')} WHERE len(rejected_reasons) > 0)")
)
# The flow stamps these columns itself, always with a value.
ORACLES["stream_dq_swipes"] = metrics(
    accepted("swipes"), {n: "true" if n in _FLOW_STAMPS.values() else x for n, x in HOLDS["swipes"].items()}
)

ORACLES["ingest_csv_by_name"] = """
SELECT cast(o_orderkey AS VARCHAR) AS o_orderkey, cast(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
  CASE WHEN o_orderkey % 3 = 2 THEN 'c' || o_custkey END AS channel, cast(NULL AS VARCHAR) AS _rescued_data FROM orders"""
ORACLES["ingest_backfill"] = "SELECT cast(c_custkey AS VARCHAR) AS customer_id, c_mktsegment FROM customer"
ORACLES["ingest_json_array"] = """
SELECT cast(c_custkey AS VARCHAR) AS c_custkey, c_name,
  '{"c_mktsegment":"' || c_mktsegment || '","c_nationkey":"' || c_nationkey || '"}' AS home FROM customer"""
ORACLES["stream_dedup_batches"] = """
SELECT event_id AS swipe_id, CASE WHEN ts < TIMESTAMP '2024-01-10' AND event_id % 10 = 0 THEN 'late' ELSE 'accepted' END AS outcome
FROM events"""
