import random

import duckdb
import pytest

from riskflow.llm import quality
from riskflow.llm.oracles import ORACLES
from riskflow.llm.queries import QUERIES
from tests.llm import brute

SCHEMA = "doc_id long, text string, n_words string, kept string"


def values(spark, texts):
    rows = [(i, t, "clash", "clash") for i, t in enumerate(texts)]
    return quality.clean_lines(spark.createDataFrame(rows, SCHEMA)).orderBy("doc_id").collect()


def measured(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words


def test_values_against_brute_force(spark):
    texts = [
        "",
        " \t\n\x0b\f\r ",
        "one",
        "a b",
        "a b c",
        "a b c a b c",
        "a b c x a b c",
        "a a a a a",
        "same line\nsame line\nother\n\n  \nsame line ",
        "# heading $5 & <b> 100% |x| *",
        "é ü 漢字 😀 😀 😀 x",
        "  no break space",
        "x " * 5_000,
        " ".join(str(i % 997) for i in range(20_000)),
        "tail\r\nline\r\nline\r\n",
    ]
    for text, r in zip(texts, values(spark, texts)):
        assert measured(r) == brute.quality(text), text[:40]


def test_null_text_and_repeated_rows(spark):
    df = spark.createDataFrame([(None, None, "", ""), (1, "a b c.", "", ""), (1, "a b c.", "", "")], SCHEMA)
    out = quality.clean_lines(df).collect()
    assert len(out) == 3
    null = [r for r in out if r.doc_id is None][0]
    assert measured(null) == (0, 0, 0, 0, 0) and null.base_failed and not null.kept and null.clean_text == ""
    assert quality.clean_lines(df.limit(0)).count() == 0


def test_lines_that_fail_go_and_others_stay(spark):
    good = "This is a plain sentence of ordinary prose that ends as it should. " * 6
    text = f"Home | News | About | Contact\n{good}\nAccept our cookie policy\nshort fragment\n\n{good}"
    r = values(spark, [text])[0]
    assert r.clean_text == f"{good}\n\n{good}"
    assert sorted(r.faults) == ["boilerplate", "navigation", "punctuation"]
    assert r.n_lines == 5 and r.n_removed_lines == 3


LONG = " ".join(f"w{i}" for i in range(400))


@pytest.mark.parametrize(
    "line",
    [
        f"{LONG} | {LONG} » {LONG}.",
        f"{LONG} <b>bold</b> {LONG}.",
        f"{LONG} a -> b, x > 3 {LONG}.",
        "« Oui », dit-il : « non »",
        "»Ja«, sagte er, »nein«.",
        "« Oui » et « non » et « oui ».",
        "La col·lecció intel·ligent.",
        "Some <b>bold</b> and <i>other</i> words.",
        ">> quoted reply of the letter before this one",
        ">>> quoted reply.",
        "The value x > 3 is kept, and y > 5 is dropped from the table.",
    ],
)
def test_separators_in_prose_are_no_menu(spark, line):
    r = values(spark, [line])[0]
    assert r.faults == [] and r.clean_text == line


def test_document_on_one_line_with_two_separators_stays(spark):
    text = f"{LONG} <b>bold</b> and x > 3."
    r = values(spark, [text])[0]
    assert r.kept and r.clean_text == text


@pytest.mark.parametrize(
    "line",
    [
        "Home | News | About us | Contact.",
        "| Home | News |",
        "Shop > Shoes > Winter boots for children.",
        "Start » Themen » Archiv",
        " | ".join(f"Item number {i}" for i in range(200)) + ".",
        "<a>Home</a> | <a>News</a> | <a>About</a>.",
    ],
)
def test_menus_and_crumb_trails_go(spark, line):
    assert values(spark, [line])[0].faults == ["navigation"]


@pytest.mark.parametrize("menu, kept", [(1, True), (80, False)])
def test_verdict_by_loss(spark, menu, kept):
    words = " ".join(f"w{i}" for i in range(80)) + "."
    text = words + "\n" + "\n".join(f"a{i} | b{i} | c{i} | d{i}" for i in range(menu))
    r = values(spark, [text])[0]
    assert not r.base_failed and r.kept is kept


def test_base_failures(spark):
    few, repeated, fine = "Only a few words.", "the same words again. " * 40, " ".join(f"w{i}" for i in range(60)) + "."
    assert [r.base_failed for r in values(spark, [few, repeated, fine])] == [True, True, False]


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    out = QUERIES["op6_line_quality"](spark, folder)
    rows = out.collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert measured(r) == brute.quality(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_a_million_characters_end_no_process(spark):
    n = 1_000_000
    parts = ["<", "< ", "<>", "«", "« »", "‹›", "l·l", "|", "> ", "a.", '.")', "home ", "a b c ", "\n", "a\n", "»‹"]
    rows = values(spark, [p * (n // len(p)) for p in parts])
    assert [r.n_words > 0 for r in rows] == [p.strip() != "" for p in parts]


def test_reference_sql_on_prose_with_separators(spark, tmp_path):
    """The SQL and the query over texts whose lines hold separators in every way; both verdicts occur among those that pass the
    base."""
    draw = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    marks = ["|", "»", "›", "·", "•", ">", "<b>", "</b>", "« ", " »", "l·l", "->", "‹", "<"]
    lines = ["Home | News | About | Contact", "« Oui », dit-il : « non »", ">> quoted reply of some length that goes on", "a › b › c", "| a | b |",
             "• one • two", "paral·lel col·lecció", "Next page", "Read more", "", "  ", "x", "Ends well.", "»Ja«, sagte er, »nein«."]
    texts = []
    for i in range(300):
        text = []
        for _ in range(draw.randrange(1, 12)):
            own = [draw.choice(words) for _ in range(draw.choice([2, 5, 9, 30, 120]))]
            for _ in range(draw.choice([0, 0, 1, 2, 2, 4])):
                own.insert(draw.randrange(len(own) + 1), draw.choice(marks))
            text.append(draw.choice(lines) if draw.random() < 0.3 else " ".join(own) + draw.choice([".", "", "!", '."']))
        if i % 5 == 0:  # mostly menus
            text += [" | ".join(draw.sample(words, 12)) for _ in range(4 * len(text))]
        texts.append("\n".join(text))
    texts += [None, "", "\n", f"{LONG} | {LONG} » {LONG}.", "\n".join(lines)]
    rows = [(i, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    ours = QUERIES["op6_line_quality"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    reference = con.execute(ORACLES["op6_line_quality"])
    names = [c[0] for c in reference.description]
    theirs = {r[names.index("doc_id")]: dict(zip(names, r)) for r in reference.fetchall()}
    got = {r.doc_id: {c: r[c] for c in names} for r in ours.collect()}
    assert got == theirs
    passed = [r for r in got.values() if not r["base_failed"]]
    assert 20 < sum(r["kept"] for r in passed) < len(passed) - 20
