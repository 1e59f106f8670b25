import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskflow.llm import bytelevel, chunks, decomposition
from riskflow.llm.queries import QUERIES, tokenizer

PATH = tokenizer("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(PATH)
    return lambda text: one.encode(text or "", add_special_tokens=False).ids + [2]


TEXTS = [
    None,
    "",
    " \t\n ",
    "Hello, World! it's  the <|endoftext|> end<|startoftext|>x",
    "é é ﬁ Å ΑΣ Σ ΣΑΣ. İ ß  x y z 　漢字 😀😀",
    "a " * 4095,
    "a " * 4096,
    "a " * 9000 + "end",
    "x" * 5000,
    "12345 67,8.9 a_b __ 's 't don't",
    "\x00 \x01a\x7f   b",
]


def rows(spark, texts, **options):
    df = spark.createDataFrame([(i, t, "clash", 1.5) for i, t in enumerate(texts)], "doc_id long, text string, length string, ids double")
    return decomposition.decompose(df, PATH, **options)


def check(pieces, texts, whole, longest=4096):
    """Every document exactly once, in order, in pieces whose lengths are powers of two; ids as of the whole text."""
    by_doc = {}
    for r in pieces:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert sorted(by_doc) == list(range(len(texts)))
    for i, text in enumerate(texts):
        want, own, at = whole(text), sorted(by_doc[i], key=lambda r: r.start), 0
        assert [r.length for r in own] == decomposition.lengths(len(want), longest)
        for r in own:
            assert r.start == at and r.doc_tokens == len(want)
            assert np.frombuffer(r.ids, "<u4").tolist() == want[at : at + r.length]
            at += r.length
        assert at == len(want)


def test_lengths():
    assert decomposition.lengths(4096 * 2 + 5) == [4096, 4096, 4, 1]
    assert decomposition.lengths(7, 4) == [4, 2, 1] and decomposition.lengths(1) == [1]
    for n in range(1, 3000, 7):
        own = decomposition.lengths(n, 1024)
        assert sum(own) == n and all(x & (x - 1) == 0 and x <= 1024 for x in own)


def test_pieces_against_whole_texts(spark, whole):
    check(rows(spark, TEXTS).collect(), TEXTS, whole)
    check(rows(spark, TEXTS, longest=64).collect(), TEXTS, whole, 64)


def test_given_texts(spark, whole):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()]
    check(rows(spark, texts).collect(), texts, whole)


def test_a_small_table_gives_the_same(spark, whole, monkeypatch):
    for name, value in (("SLOTS", 4), ("MOST_RESULTS", 3), ("LONG", 2)):
        monkeypatch.setattr(chunks, name, value)
    encoder, texts = decomposition.Encoder(PATH), [t or "" for t in TEXTS]
    for turn in range(6):
        texts = texts[1:] + texts[:1]  # another order, so that a result of an older table would show
        data = "".join(texts).encode()
        bounds = np.cumsum([0, *(len(t.encode()) for t in texts)])
        ids, at = encoder.encode(np.frombuffer(data, np.uint8), bounds, 2)
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [whole(t) for t in texts]


def test_plain_words_against_the_whole_tokenizer(whole):
    """Every plain character at every place of a word, and random words of plain and other characters."""
    encoder = bytelevel.ByteLevel(PATH, spaced=False)
    letters = [chr(c) for c in range(0x21, 0x250) if not chr(c).isspace()]
    words = [w for c in letters for w in (c, f"ab{c}", f"{c}ab", f"a{c}b", f"A1{c}'s", f"{c}{c}2{c}'LL")]
    draw = random.Random(5)
    words += ["".join(draw.choice(letters + list("'<|>stremvdl")) for _ in range(draw.randrange(1, 12))) for _ in range(20_000)]
    words += ["<|endoftext|>", "x<|startoftext|>y", "<|", "|>", "<|startoftext|", "don't", "'re're"]
    assert encoder.ids(words) == [whole(w)[:-1] for w in words]


def test_sequences_are_numbered_by_bucket(spark):
    pieces = rows(spark, TEXTS * 5).select("doc_id", "start", "length", "doc_tokens")
    for bucket_rows in (4, 4096):
        out = decomposition.with_sequences(pieces, bucket_rows=bucket_rows).orderBy("sequence_id").collect()
        assert [r.sequence_id for r in out] == list(range(pieces.count()))
        assert [r.length for r in out] == sorted(r.length for r in out)
        assert {r.offset for r in out} == {0}


def test_null_and_repeated_keys_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (3, None)], "doc_id long, text string")
    pieces = decomposition.decompose(df, PATH)
    assert pieces.agg(F.sum("length")).first()[0] == 4 + 4 + 1
    out = decomposition.with_sequences(pieces.drop("ids")).collect()
    assert sorted(r.sequence_id for r in out) == list(range(len(out)))
    empty = decomposition.with_sequences(decomposition.decompose(df.limit(0), PATH).drop("ids"))
    assert empty.count() == 0 and "sequence_id" in empty.columns


def test_buckets_on_disk(spark, tmp_path):
    decomposition.write_buckets(rows(spark, TEXTS), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.where(F.octet_length("ids") != 4 * F.col("length")).count() == 0
    assert back.agg(F.sum("length")).first()[0] == rows(spark, TEXTS).agg(F.sum("length")).first()[0]


def test_query(spark, whole):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    out = QUERIES["op12_power_of_two"](spark, folder).collect()
    assert sorted(r.sequence_id for r in out) == list(range(len(out)))
    for r in out:
        ids = whole(texts[r.doc_id])
        part = ids[r.start : r.start + r.length]
        assert len(part) == r.length and r.doc_tokens == len(ids) and r.offset == 0 and r.length in [1 << i for i in range(13)]
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    assert sum(r.length for r in out) == sum(len(whole(t)) for t in texts.values())
