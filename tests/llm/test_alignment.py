import random
from collections import Counter
from hashlib import sha256

import pyarrow as pa
import pytest

from riskflow.llm import alignment, bytelevel, chunks
from riskflow.llm.queries import QUERIES, tokenizer

FILES = alignment.Tokenizers(tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


@pytest.fixture(scope="module")
def brute():
    """Rows of texts from the definition: whole texts, byte by byte."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(FILES.a)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=FILES.b)
    visible = {}
    extra = 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255:
            visible[chr(byte)] = byte
        else:
            visible[chr(extra)] = byte
            extra += 1

    def groups(text):
        body = (" " + text).encode()
        ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        spelt = (
            [bytes(visible[c] for c in a.id_to_token(i)) for i in ids[0]],
            [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids[1] for p in [b.id_to_piece(i)]],
        )
        if not text or b"".join(spelt[0]) != body or b"".join(spelt[1]) != body:
            return []
        owner = [[k for k, s in enumerate(side) for _ in s] for side in spelt]
        out, start = [], 0
        for end in range(1, len(body) + 1):
            if all(end == len(body) or o[end] != o[end - 1] for o in owner):
                out.append(tuple([ids[s][k] for k in dict.fromkeys(owner[s][start:end])] for s in (0, 1)))
                start = end
        return out

    def rows(texts):
        all_groups = [groups(t or "") for t in texts]
        links = [Counter((x, y) for g in gs for x in g[0] for y in g[1]) for gs in all_groups]
        counts = Counter(p for one in links for p in one)
        best = {}
        for (x, _), n in counts.items():
            best[x] = max(best.get(x, 0), n)
        out = []
        for gs, one in zip(all_groups, links):
            text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in gs)
            out.append((
                sum(len(x) for x, _ in gs), sum(len(y) for _, y in gs), len(gs), sum(one.values()),
                sum(m for p, m in one.items() if counts[p] == best[p[0]]), sum(m * counts[p] for p, m in one.items()), text,
            ))
        return out

    return rows


TEXTS = [
    None,
    "",
    " ",
    "  ",
    "a",
    "Hello, World!  two  spaces   three\tTab\n\nlines \r\n end ",
    " leading and trailing ",
    "it's don't we'll they've I'm he'd 'tis '' ' s",
    "<|endoftext|> <s> </s> <unk> <0x41> [INST]",
    "é é ﬁ Å 漢字 漢 字 😀 😀😀 x y  z 　 a \u0085 b",
    "\x00 \x01 a\x7fb",
    "a ▁b",
    "under▁score",
    "1234567890 3.14159 1,000,000 v2.0.1 0x1F",
    "x" * 3000,
    " " * 300 + "x",
    "antidisestablishmentarianism Donaudampfschifffahrtsgesellschaft",
    "a b c d e f g " * 300,
    "a b c d e f g " * 300,
    " a  b  c  d ﻿e",
]


def found(spark, texts, **options):
    df = spark.createDataFrame([(i, t, "x", 1.5) for i, t in enumerate(texts)], "doc_id long, text string, n_a string, groups double")
    out = alignment.align_documents(df, FILES, **options).orderBy("doc_id").collect()
    return [tuple(r[c] for c in (*COLUMNS, "groups")) for r in out]


def test_against_brute_force(spark, brute):
    want = brute(TEXTS)
    assert found(spark, TEXTS) == want
    assert want[11][0] == 0 and want[12][0] == 0 and want[4][0] > 0


def test_joined_counts_give_the_same(spark, brute):
    assert found(spark, TEXTS, most_pairs=0) == brute(TEXTS)


def test_given_texts(spark, brute):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()]
    want = brute(texts)
    assert found(spark, texts) == want
    rows = QUERIES["op13_aligned_tokens"](spark, "/root/testdata/sf0.001").orderBy("doc_id").collect()
    assert [tuple(r[c] for c in COLUMNS) for r in rows] == [w[:6] for w in want]
    assert [r.groups_sha256 for r in rows] == [sha256(w[6].encode()).hexdigest() if w[6] else "" for w in want]


def test_a_small_table_gives_the_same(brute, monkeypatch):
    for name, value in (("SLOTS", 4), ("MOST_RESULTS", 3), ("LONG", 3)):
        monkeypatch.setattr(chunks, name, value)
    aligner, want = alignment.Aligner(FILES), [w[6] for w in brute(TEXTS)]
    for _ in range(2):
        out = []
        for first, after, which, bounds in aligner.slices(pa.array(TEXTS)):
            out += [";".join(aligner.groups[w] for w in which[a:b]) for a, b in zip(bounds, bounds[1:])]
        assert out == want


def test_plain_words_against_the_whole_tokenizer():
    encoder = bytelevel.ByteLevel(FILES.a, spaced=True, plain_specials=True)
    letters = [chr(c) for c in range(0x21, 0x250) if not chr(c).isspace()]
    words = [w for c in letters for w in (c, f" {c}", f" ab{c}", f" {c}ab", f" A1{c}'s", f" {c}{c}2{c}'LL")]
    draw = random.Random(6)
    words += [" " + "".join(draw.choice(letters + list("'<|>stremvdl ")) for _ in range(draw.randrange(1, 12))) for _ in range(20_000)]
    words += [" <|endoftext|>", "<|endoftext|>", " don't", "  ", " "]
    assert encoder.ids(words) == [encoder.whole(w) for w in words]


def test_alphabet_is_that_of_the_file():
    aligner = alignment.Aligner(FILES)
    assert sorted(bytelevel.byte_alphabet().values()) == list(range(256))
    assert {b for b in aligner.side_a.bytes if len(b) == 1} == {bytes([i]) for i in range(256)}


def test_nulls_repeats_and_empty_table(spark):
    df = spark.createDataFrame([(None, "one two"), (None, "one two"), (1, None)], "doc_id long, text string")
    for most in (alignment.MOST_PAIRS, 0):
        out = alignment.align_documents(df, FILES, most_pairs=most).collect()
        assert sorted(r.count_sum for r in out) == [0, 4, 4]  # two links in two documents each
        assert alignment.align_documents(df.limit(0), FILES, most_pairs=most).count() == 0
    only_empty = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    assert [r.n_links for r in alignment.align_documents(only_empty, FILES).collect()] == [0, 0]
