import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskflow.functions import cleaning as c


def values(spark, expression, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, raw string").select("i", expression("raw").alias("v"))
    return [r.v for r in df.orderBy("i").collect()]


CASES = [
    (c.clean_name, ["  ali AL-sayed 3", "Ωmega x", "", None], ["Ali Alsayed", "Mega X", "", None]),
    (c.clean_text, [" ab ", None], ["AB", None]),
    (c.clean_formatted_customer_id, ["cust-000123", "  CUST000123 ", "cu st", None], ["CUST000123", "CUST000123", "CUST", None]),
    (c.clean_formatted_account_id, ["  ACC1234567  "], ["ACC1234567"]),
    (c.clean_formatted_transaction_id, ["txn 00000000000001"], ["TXN00000000000001"]),
    (c.clean_formatted_card_id, ["card/000001"], ["CARD000001"]),
    (c.clean_emirates_id, ["784199012345671", "784-1990-1234567-1", "78419901234567", "", None],
     ["784-1990-1234567-1", "784-1990-1234567-1", "78419901234567", "", None]),
    (c.clean_email, [" User@B.COM ", "a b@c.d!", None], ["user@b.com", "ab@c.d", None]),
    (c.clean_phone, ["0501234567", "+971 50 123 4567", "00971501234567", "", None],
     ["+971-50-123-4567", "+971-50-123-4567", "9710971501234567", "", None]),
    (c.clean_nationality, [" ae ", "united ARAB", "", None], ["AE", "United Arab", "", None]),
    (c.clean_account_currency, ["aed", "u.s d", None], ["AED", "USD", None]),
    (c.clean_account_type, ["credit_card ", "cur-rent"], ["CREDIT_CARD", "CURRENT"]),
    (c.clean_account_status, [" act1ive_"], ["ACTIVE"]),
    (c.parse_amount, ["AED 1,234.50", "0", "-5", "--", "1.005", "", None],
     [Decimal("1234.50"), Decimal("0.00"), Decimal("-5.00"), None, Decimal("1.01"), None, None]),
    (c.clean_city, ["abu dhabi", "umm al-quwain", "St. Louis", "123", "العين", None],
     ["ABU DHABI", "UMM AL-QUWAIN", None, None, "العين", None]),
    (c.clean_merchant, [" sHOP one "], ["Shop One"]),
    (c.parse_mcc_code, [" 5411 ", "n/a", "", None], [5411, None, None, None]),
    (c.parse_timestamp, [" 2024-01-01 10:00:00", "2024-01-01T10:00:00", "junk", "", None],
     [dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 10), None, None, None]),
    (c.alias_list, ['["a b", " A B ", "c"]', "[]", "not json", None], [["A B", "C"], [], None, None]),
]


@pytest.mark.parametrize("expression,texts,expected", CASES, ids=lambda v: getattr(v, "__name__", ""))
def test_cleaner(spark, expression, texts, expected):
    assert values(spark, expression, texts) == expected


DATES = {
    "1991-01-17": dt.date(1991, 1, 17),
    " 17/01/1991 ": dt.date(1991, 1, 17),
    "01-17-1991": dt.date(1991, 1, 17),
    "1991/01/17": dt.date(1991, 1, 17),
    "1991-1-7": dt.date(1991, 1, 7),
    "1991-01": dt.date(1991, 1, 1),
    "1991-01-17 10:11:12": dt.date(1991, 1, 17),
    "1991-02-30": None,
    "30/02/1991": None,
    "13-13-1991": None,
    "1/2/1991": None,
    "junk": None,
    "": None,
    None: None,
}


def test_mixed_dates(spark):
    assert values(spark, c.parse_mixed_date, list(DATES)) == list(DATES.values())


def test_mixed_dates_equal_trying_each_layout(spark):
    """The shape dispatch gives what trying the layouts one by one gives."""
    parts = [f"{a}{s}{b}{t}{d}" for a in ("1991", "12", "31", "02", "0000", "7") for b in ("01", "13", "28", "5")
             for d in ("17", "1991", "30", "0000") for s in "-/" for t in "-/"]
    df = spark.createDataFrame([(p,) for p in parts], "raw string")
    tried = F.coalesce(
        *[F.try_to_date("raw", f) for f in ("yyyy-MM-dd", "dd/MM/yyyy", "MM-dd-yyyy", "yyyy/MM/dd")],
        F.col("raw").try_cast("date"),
    )
    both = df.select("raw", c.parse_mixed_date("raw").cast("string").alias("a"), tried.cast("string").alias("b"))
    wrong = both.where("NOT a <=> b")
    assert wrong.collect() == []


def test_city_equals_its_repeated_group_form(spark):
    """All texts of up to five characters over letters, separators and others against the form with a repeated group."""
    letters = "aB -'.\n1é"
    texts = spark.range(0, sum(len(letters) ** n for n in range(6)), 1, 8)
    digit = lambda i: F.substring(F.lit(letters), (F.floor(F.col("id") / len(letters) ** i) % len(letters) + 1).cast("int"), 1)
    spelt = texts.select(F.concat(*[digit(i) for i in range(5)]).alias("t"), (F.col("id") % 6).cast("int").alias("n"))
    spelt = spelt.select(F.substring("t", F.lit(1), F.col("n")).alias("t")).distinct()
    differing = spelt.where(c.is_city("t") != F.col("t").rlike(r"^[\p{L}]+([ .'-][\p{L}]+)*$"))
    assert differing.take(5) == []
    assert spelt.where(c.is_city("t")).count() > 100


LONG = 1_000_000
LONG_TEXTS = ["ab " * (LONG // 3) + "ab", "a" * LONG, " " * LONG, "1" * LONG, "a@" * (LONG // 2), "a." * (LONG // 2), '["a",' * (LONG // 5)]


@pytest.mark.parametrize("domain", ["customers", "accounts", "transactions", "swipes", "sanctions"])
def test_a_million_characters_end_no_process(spark, domain):
    """Every cleaning expression, rule and expectation over long texts in every column; few passes over a text are allowed."""
    from riskflow.plans.silver import DOMAINS
    from riskflow.sources import schemas

    stamps = ["ingested_at", "file_name", "adf_run_id"] if domain == "swipes" else ["_ingested_at", "source_file", "adf_run_id"]
    columns = [*schemas.FEEDS[domain], *stamps]
    text = F.element_at(F.array(*[F.lit(t) for t in LONG_TEXTS]), F.col("id").cast("int") + 1)
    raw = spark.range(0, len(LONG_TEXTS), 1, 4).select(*[text.alias(x) for x in columns])
    known = {t: spark.createDataFrame([("x",)], f"{k} string") for t, k in DOMAINS[domain].references.items()}
    validated = DOMAINS[domain].validate(DOMAINS[domain].clean(raw), known)
    assert validated.agg(F.sum(F.size("rejected_reasons"))).first()[0] > 0
    from riskflow.operators import quality

    assert quality.expectation_metrics(DOMAINS[domain].clean(raw), domain).count() > 0


def test_a_long_city(spark):
    long = "ab " * 400_000 + "ab"
    assert values(spark, c.clean_city, [long, long + "-", long + "1"]) == [long.upper(), None, None]
