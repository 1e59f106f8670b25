import os
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskflow.llm import repeats
from riskflow.llm.deepsort import BlindTrie, deep_shallow
from riskflow.llm.queries import QUERIES
from tests.llm import brute

SCHEMA = "doc_id long, text string, row string, spans string"


def done(spark, texts, **how):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in texts.items()], SCHEMA)
    rows = repeats.remove_repeats(df, **how).collect()
    assert len(rows) == len(texts)
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.binary(min_size=24, max_size=24).map(lambda b: bytes(x % 3 for x in b))), max_size=40),
       st.integers(0, 3))
def test_deep_shallow_sorts(rows, shallow):
    groups = np.array([g for g, _ in rows], np.int64)
    keys = np.frombuffer(b"".join(k for _, k in rows), np.uint8).reshape(len(rows), 24)
    order, shared = deep_shallow(groups, keys, shallow)
    assert [rows[i] for i in order] == sorted(rows)
    for p in range(1, len(rows)):
        (g, a), (h, b) = rows[order[p - 1]], rows[order[p]]
        assert shared[p] == (-1 if g != h else len(os.path.commonprefix([a, b])))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(min_size=6, max_size=6).map(lambda b: bytes(x % 2 for x in b)), min_size=1, max_size=40))
def test_blind_trie_orders_every_string_once(strings):
    order = BlindTrie(strings).ordered()
    assert sorted(order) == list(range(len(strings))) and [strings[i] for i in order] == sorted(strings)


def mixture(seed):
    """Texts that share passages, whole texts, overlapping and periodic parts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randint(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(30), text(8), "ab" * 90, "x" * 150, text(60)]
    texts = {}
    for i in range(60):
        parts = [text(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(shared)
            cut = rng.randint(0, len(p) // 2)
            parts += [p[cut:] if rng.random() < 0.5 else p, text(rng.randint(0, 10))]
        texts[rng.randrange(10**6)] = "".join(parts)
    texts |= {10**7: None, 10**7 + 1: "", 10**7 + 2: texts[min(texts)], 5: shared[4] + shared[4]}
    return texts


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    texts = mixture(seed)
    assert done(spark, texts) == brute.repeats(texts, 100)
    assert done(spark, texts, length=40, anchor=12) == brute.repeats(texts, 40)


def test_large_groups_are_counted_string_by_string(spark):
    texts = mixture(9)
    assert done(spark, texts, most=1) == brute.repeats(texts, 100)


def test_small_slices_and_chunks(spark, monkeypatch):
    texts = mixture(4)
    monkeypatch.setattr(repeats, "CHUNK", 7)
    sorter = repeats._sorter(100, 32)
    assert sorter is not None and done(spark, texts) == brute.repeats(texts, 100)


def test_texts_cut_into_pieces_lose_no_string(monkeypatch):
    """Stretches of a text found piece by piece cover the same strings at the same places."""
    import pyarrow as pa

    rng = random.Random(1)
    text = "".join(rng.choice("abcd") for _ in range(5000))
    monkeypatch.setattr(repeats, "PLACE_BITS", 11)
    monkeypatch.setattr(repeats, "SLICE", 100)
    starts = []
    for _, data, bounds, shift in repeats._pieces(pa.array([text]), 100):
        _, first, count, _, _, _ = repeats.stretches(data, bounds, 100, 32)
        starts += [s for f, c in zip(first + shift, count) for s in range(f, f + c)]
    assert sorted(starts) == list(range(4901))


def test_long_text(spark):
    rng = random.Random(3)
    long = "".join(rng.choice("abcdefghij ") for _ in range(3_000_000))
    got = done(spark, {1: long, 2: long[1_000_000:1_000_500], 3: "y" * 99})
    assert got[1][1] == 0 and got[2][:3] == (500, 500, 1) and got[3][1] == 0


def test_kept_bytes(spark):
    df = spark.createDataFrame([(1, "q" * 100), (2, "z" + "q" * 100 + "z")], "doc_id long, text string")
    rows = {r.doc_id: r for r in repeats.remove_repeats(df, keep_bytes=True).collect()}
    assert bytes(rows[2].kept_bytes) == b"zz" and [(s.start, s.end) for s in rows[2].spans] == [(1, 101)]


def test_null_keys_repeated_rows_and_empty_table(spark):
    a, b = "a1 " * 50, "".join(chr(97 + i * 7 % 26) for i in range(60)) + "b2 " * 40
    df = spark.createDataFrame([(None, a), (1, a), (1, a), (2, a + b), (3, None), (None, None)], "doc_id long, text string")
    rows = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in repeats.remove_repeats(df).collect())
    one = brute.repeats({1: a, 2: a + b, 3: None, 9: a}, 100)
    assert rows == sorted([(0, *one[9][:2]), (1, *one[1][:2]), (1, *one[1][:2]), (2, *one[2][:2]), (3, 0, 0), (0, 0, 0)])
    assert repeats.remove_repeats(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        repeats.remove_repeats(df, length=400, anchor=32)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op3_deep_shallow"](spark, folder).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == brute.repeats(texts, 100)
