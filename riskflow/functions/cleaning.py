"""Normalisation of raw text columns.

Every function takes a column (or its name) and returns a column built from
JVM expressions only. Nothing here raises on dirty input: values that cannot
be parsed become NULL, also with ANSI mode on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Patterns and layouts that decide the cleaned text.
EMIRATES_ID_DIGITS = r"^([0-9]{3})([0-9]{4})([0-9]{7})([0-9])$"
PHONE_DIGITS = r"^([0-9]{3})([0-9]{2})([0-9]{3})([0-9]{4})$"
COUNTRY_CODE = "971"
# A city name is letters with single parting characters between them. Said without a repeated group: the regex engine recurses
# once per repetition of a group, so that a text of a million words would end the process.
CITY_CHARACTERS = r"^[\p{L} .'-]+$"
CITY_FAULT = r"^[ .'-]|[ .'-]$|[ .'-][ .'-]"
MONEY = "decimal(18,2)"
AMOUNT_CHARACTERS = 1000


def _column(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _keep(c: ColumnOrName, characters: str) -> Column:
    """Delete all but the given ASCII characters.

    Character sets are written with predefined classes (``\\p{Alnum}``, ``\\w``).
    Measured on one column, a class of several ranges (``a-zA-Z0-9``) took as
    long on eight threads as on one; predefined classes took a quarter.
    """
    return F.regexp_replace(_column(c), f"[^{characters}]", "")


def clean_name(c: ColumnOrName) -> Column:
    """Letters and white space only, capitalised words."""
    return F.trim(F.initcap(_keep(c, r"\p{Alpha}\s")))


def clean_text(c: ColumnOrName) -> Column:
    return F.upper(F.trim(_column(c)))


def clean_id(c: ColumnOrName) -> Column:
    """Upper-case letters and digits. Layout is checked by the rules, not here."""
    return F.upper(_keep(c, r"\p{Alnum}"))


# A well-formed identifier is already in its final layout once punctuation is
# gone, so the four identifier kinds share one expression (and one regex pass).
clean_formatted_customer_id = clean_id
clean_formatted_account_id = clean_id
clean_formatted_transaction_id = clean_id
clean_formatted_card_id = clean_id


def clean_emirates_id(c: ColumnOrName) -> Column:
    """Fifteen digits become ddd-dddd-ddddddd-d; anything else stays digits."""
    return F.regexp_replace(_keep(c, "0-9"), EMIRATES_ID_DIGITS, "$1-$2-$3-$4")


def clean_email(c: ColumnOrName) -> Column:
    return _keep(F.lower(F.trim(_column(c))), r"\w@.%+-")


def clean_phone(c: ColumnOrName) -> Column:
    """Digits with one leading 0 read as the country code; 12 digits get dashes."""
    international = F.regexp_replace(_keep(c, "0-9"), "^0", COUNTRY_CODE)
    return F.regexp_replace(international, PHONE_DIGITS, "+$1-$2-$3-$4")


def clean_nationality(c: ColumnOrName) -> Column:
    """Codes of up to three characters in upper case, names capitalised."""
    text = F.trim(_column(c))
    return F.when(F.length(text) <= 3, F.upper(text)).otherwise(F.initcap(text))


def clean_account_currency(c: ColumnOrName) -> Column:
    return F.upper(_keep(c, r"\p{Alpha}"))


def clean_account_type(c: ColumnOrName) -> Column:
    return F.upper(_keep(c, r"\p{Alpha}_"))


def clean_account_status(c: ColumnOrName) -> Column:
    return F.upper(_keep(c, r"\p{Alpha}"))


def parse_mixed_date(c: ColumnOrName) -> Column:
    """Date from yyyy-MM-dd, dd/MM/yyyy, MM-dd-yyyy, yyyy/MM/dd or any ISO form.

    The layouts are disjoint, so the text is rearranged to ISO by its shape and
    cast once. Trying one formatter after another would throw and catch an
    exception per row and miss, which dominates the scan on dirty data.
    """
    text = F.trim(_column(c))

    def iso(year: int, month: int, day: int) -> Column:
        return F.concat_ws("-", F.substring(text, year, 4), F.substring(text, month, 2), F.substring(text, day, 2))

    rearranged = (
        F.when(text.rlike(r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$"), iso(7, 4, 1))
        .when(text.rlike(r"^[0-9]{2}-[0-9]{2}-[0-9]{4}$"), iso(7, 1, 4))
        .when(text.rlike(r"^[0-9]{4}/[0-9]{2}/[0-9]{2}$"), iso(1, 6, 9))
        .otherwise(text)
    )
    return rearranged.try_cast("date")


def parse_timestamp(c: ColumnOrName) -> Column:
    return _column(c).try_cast("timestamp")


def parse_amount(c: ColumnOrName) -> Column:
    """Money text such as ``AED 1,234.50`` as decimal(18,2).

    Text of more than AMOUNT_CHARACTERS digits is no amount: reading a number takes time by the square of its digits.
    """
    digits = _keep(c, "0-9.-")
    return F.when(F.length(digits) <= AMOUNT_CHARACTERS, digits).try_cast(MONEY)


def parse_mcc_code(c: ColumnOrName) -> Column:
    return F.trim(_column(c)).try_cast("int")


def clean_merchant(c: ColumnOrName) -> Column:
    return F.trim(F.initcap(_column(c)))


def clean_city(c: ColumnOrName) -> Column:
    """Upper-case city name, or NULL where the text is no city name."""
    text = clean_text(c)
    return F.when(is_city(text), text)


def is_city(c: ColumnOrName) -> Column:
    """Whether a text is a city name; NULL for NULL."""
    text = _column(c)
    return text.rlike(CITY_CHARACTERS) & ~text.rlike(CITY_FAULT)


def alias_list(c: ColumnOrName) -> Column:
    """JSON list text as an array of capitalised, distinct names; bad JSON is NULL."""
    names = F.from_json(_column(c), "array<string>")
    return F.array_distinct(F.transform(names, lambda name: F.initcap(F.trim(name))))
