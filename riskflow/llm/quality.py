"""Line-first cleaning: every line is judged by itself, failing lines go, and a document that loses too much goes whole.

All of it is built-in expressions over one row at a time: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.frames import whole_text, without

#: The characters between words, in the order space, tab to carriage return.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

#: A line ends well with one of these, closing quotes and brackets aside.
ENDINGS = r"[.!?:;…。！？](?:[\"'”’»)\]]*)$"
#: Lines of menus and crumb trails: MENU_MARKS or more of these separators between short items, or a short line that begins
#: with a menu word.
SEPARATORS, MENU_MARKS = "|»›·•>", 2
#: Items of at most so many words on average are short.
ITEM_WORDS = 3
#: A run of separators parts two items once; those that begin a line (quoted replies, bullets) part nothing, pipes aside.
SEPARATOR_RUN, LEADING = r"[|»›·•>][|»›·•>\x20\x09-\x0D]*", "»›·•>"
#: The same characters as no separators: tags, quotations, the Catalan double l.
PAIRED = r"<[^<>]*>|«[^«»]*»|»[^«»]*«|‹[^‹›]*›|›[^‹›]*‹|(?i:l·l)"
MENU_WORDS = r"(?i)^(?:home|menu|next|previous|prev|back|skip to|sign in|log in|share|print)\b.{0,40}$"
#: Phrases of page furniture and legal notices, matched without regard to case.
BOILERPLATE = (
    "all rights reserved",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "privacy policy",
    "read more",
    "sign up for our newsletter",
    "subscribe to our",
    "terms of use",
    "this work is licensed under",
    "licensed under the",
    "click here",
)

MIN_WORDS = 50
#: Lost letters, in percent of all letters, beyond which the document goes.
MOST_LOST = 50
#: A line of at least so many words may lack an ending (wrapped prose).
WRAPPED_WORDS = 8


def words_of(text: Column) -> Column:
    """Runs of characters other than ASCII blanks."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN, -1))


def letters(text: Column) -> Column:
    """Characters that are not blanks."""
    return F.length(F.translate(text, BLANKS, "")).cast("long")


def parts_short_items(body: Column) -> Column:
    """Whether MENU_MARKS or more separators stand between items of ITEM_WORDS words on average. A line with fewer of the
    characters is not looked at further."""
    marks = F.length(body) - F.length(F.translate(body, SEPARATORS, ""))
    bare = F.ltrim(F.regexp_replace(body, PAIRED, "_"), F.lit(LEADING + BLANKS))
    items = F.size(F.split(bare, SEPARATOR_RUN, -1))
    words = F.size(words_of(F.translate(body, SEPARATORS, " " * len(SEPARATORS))))
    return (marks >= MENU_MARKS) & (items > MENU_MARKS) & (words <= ITEM_WORDS * items)


def line_fault(body: Column, low: Column) -> Column:
    """Why a line fails, null if it passes. Blank lines pass: they separate paragraphs. ``body``: without blanks at its ends;
    ``low``: in lower case."""
    words = F.size(F.split(body, BLANK_RUN, -1))
    boiler = F.lit(False)
    for phrase in BOILERPLATE:
        boiler = boiler | F.contains(low, F.lit(phrase))
    return (
        F.when(body == "", F.lit(None).cast("string"))
        .when(parts_short_items(body) | body.rlike(MENU_WORDS), F.lit("navigation"))
        .when(boiler & (words < 40), F.lit("boilerplate"))
        .when(~body.rlike(ENDINGS) & (words < WRAPPED_WORDS), F.lit("punctuation"))
    )


def window_hashes(words: Column) -> Column:
    """Hash of every three-word window, by place."""
    last = F.size(words) - 2
    return F.transform(
        F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(F.get(words, i - 1), F.get(words, i), F.get(words, i + 1)),
    )


def repeated_hashes(ordered: Column) -> Column:
    """Values that a sorted array holds twice or more."""
    return F.array_distinct(F.filter(ordered, lambda x, i: x == F.get(ordered, i - 1)))


#: Up to so many different repeated windows are looked for one by one.
FEW = 24


def with_repeated_places(df: DataFrame) -> DataFrame:
    """Adds _places, those of the windows found twice or more in the text, to ``df`` with _hashes and _repeated.

    With a few different repeated windows every window is compared with them; with more, windows are sorted with their places, and
    equal neighbours are repeated. Either way gives the same places, and neither grows with the square of a text. An array that
    a lambda looks into is a column of its own: an expression there would be computed anew for every element.
    """
    few = F.size("_repeated") <= FEW
    none = F.array().cast("array<struct<hash:bigint,place:int>>")
    placed = F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("hash"), (i + 1).alias("place"))))
    df = df.withColumn("_placed", F.when(few, none).otherwise(placed))
    looked_up = F.filter(
        F.sequence(F.lit(1), F.size("_hashes")), lambda i: F.array_contains("_repeated", F.get("_hashes", i - 1))
    )
    neighbours = F.transform(
        F.filter(
            "_placed",
            lambda w, i: (F.get("_placed", i - 1)["hash"] == w["hash"]) | (F.get("_placed", i + 1)["hash"] == w["hash"]),
        ),
        lambda w: w["place"],
    )
    places = F.when(F.size("_repeated") == 0, F.array().cast("array<int>")).when(few, looked_up).otherwise(neighbours)
    return df.withColumn("_places", places)


def covered_words(places: Column) -> Column:
    """How many words the three-word windows at ``places`` cover."""
    after = lambda n: F.transform(places, lambda p: p + n)
    return F.size(F.array_union(F.array_union(places, after(1)), after(2))).cast("long")


OWN = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_lines", "n_removed_lines",
       "faults", "lost_percent", "clean_text", "kept")


def clean_lines(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS, most_lost: int = MOST_LOST) -> DataFrame:
    """All columns of ``docs`` (those clashing with OWN are replaced) and the rule values:

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed; n_lines (lines with a word), n_removed_lines,
    faults (fault -> lines), lost_percent (letters on removed lines, of all letters), clean_text (the lines that pass), kept.

    kept is false if base_failed (too few words, or over half of them in repeated windows), or if more than ``most_lost``
    percent of the letters stand on removed lines. A null or empty text has no words and is not kept; its clean_text is
    empty. Repeated rows are judged alike, each by itself; an empty table gives an empty result.
    """
    body = whole_text(text)
    base = without(docs, OWN)
    df = base.withColumns({"_text": body, "_words": words_of(body), "_lines": F.split(body, "\n", -1)})
    df = df.withColumns(
        {
            "_hashes": window_hashes(F.col("_words")),
            # Each line is trimmed and lowered once; the rules read the results.
            "_bodies": F.transform(
                F.transform("_lines", lambda x: F.struct(x.alias("line"), F.btrim(x, F.lit(BLANKS)).alias("body"))),
                lambda x: F.struct(x["line"].alias("line"), x["body"].alias("body"), F.lower(x["body"]).alias("low")),
            ),
        }
    )
    df = df.withColumns(
        {
            "_full": F.transform(F.filter("_bodies", lambda x: x["body"] != ""), lambda x: x["line"]),
            "_judged": F.transform(
                "_bodies", lambda x: F.struct(x["line"].alias("line"), line_fault(x["body"], x["low"]).alias("fault"))
            ),
            "_ordered": F.sort_array("_hashes"),
        }
    )
    df = df.withColumn("_repeated", repeated_hashes(F.col("_ordered")))
    df = with_repeated_places(df)
    df = df.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": letters(F.col("_text")),
            "n_symbols": (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size("_full") - F.size(F.array_distinct("_full"))).cast("long"),
            "n_repeat_words": covered_words(F.col("_places")),
            "n_lines": F.size("_full").cast("long"),
            "_failed": F.filter("_judged", lambda x: x["fault"].isNotNull()),
            "clean_text": F.array_join(
                F.transform(F.filter("_judged", lambda x: x["fault"].isNull()), lambda x: x["line"]), "\n"
            ),
        }
    )
    df = df.withColumns(
        {
            "n_removed_lines": F.size("_failed").cast("long"),
            "faults": F.transform("_failed", lambda x: x["fault"]),
            "_kept_chars": letters(F.col("clean_text")),
            "base_failed": (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        }
    )
    lost = F.col("word_chars") - F.col("_kept_chars")
    df = df.withColumns(
        {
            "lost_percent": F.when(F.col("word_chars") == 0, F.lit(0.0)).otherwise(100.0 * lost / F.col("word_chars")),
            "kept": ~F.col("base_failed") & (100 * lost <= most_lost * F.col("word_chars")),
        }
    )
    return df.select(*base.columns, *OWN)
