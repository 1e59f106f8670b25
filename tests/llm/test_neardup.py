import math
import random

import pytest

from riskflow.llm import neardup
from riskflow.llm.components import components
from riskflow.llm.queries import QUERIES
from tests.llm import brute

SCHEMA = "doc_id long, text string, component_id string, cid string"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in texts.items()], SCHEMA)


def placed(spark, texts, **how):
    rows = neardup.near_duplicates(frame(spark, texts), **how).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return {r.doc_id: r.component_id for r in rows}


def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return out


@pytest.mark.parametrize("k, percent, edits", [(3, 85, 4), (5, 80, 3), (3, 50, 12)])
def test_groups_against_all_pairs(spark, k, percent, edits):
    rng = random.Random(k)
    texts, key = {}, 0
    for _ in range(12):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([20, 60, 200]))]
        for _ in range(rng.choice([1, 3, 12])):
            texts[key] = " ".join(edited(rng, words, rng.randrange(edits + 1)))
            key += 1
    texts |= {key: None, key + 1: "", key + 2: " \n ", key + 3: "one", key + 4: "ONE", key + 5: "one two", key + 6: "one  two"}
    assert placed(spark, texts, shingle=k, percent=percent) == brute.groups(texts, k, percent)


def test_many_variants_around_the_threshold(spark, monkeypatch):
    """Most pairs of the group lie near the threshold: stars alone would not join it."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(120)]
    texts = {i: " ".join(edited(rng, words, rng.choice([1, 2, 3, 4]))) for i in range(150)}
    want = brute.groups(texts, 3, 85)
    assert len(brute.by_group(want)) > 1
    assert placed(spark, texts, shingle=3, percent=85) == want
    monkeypatch.setattr(neardup, "STAR_ROUNDS", 1)
    assert placed(spark, texts, shingle=3, percent=85) == want


def test_chain_of_links(spark):
    words = [f"w{i}" for i in range(100)]
    texts = {100 - i: " ".join(words[i * 4 : i * 4 + 60]) for i in range(10)}
    assert placed(spark, texts, shingle=3, percent=85) == brute.groups(texts, 3, 85)
    assert set(placed(spark, texts, shingle=3, percent=85).values()) == {91}


def test_copies_are_one_class(spark):
    texts = {i: "the very same text in all of these rows here" for i in range(400)} | {1000: "something else entirely in this row"}
    assert set(placed(spark, texts).values()) == {0, 1000}


def test_long_text(spark):
    words = [f"w{i}" for i in range(60_000)]
    texts = {1: " ".join(words), 2: " ".join(["x", *words]), 3: " ".join(words[:30_000])}
    assert placed(spark, texts) == {1: 1, 2: 1, 3: 3}


def test_null_keys_repeated_rows_and_empty_table(spark):
    same = "these rows all have the same text of some words"
    df = spark.createDataFrame([(None, same), (None, None), (5, same), (5, same), (4, same), (6, None), (6, same)], "doc_id long, text string")
    rows = sorted((r.doc_id or 0, r.component_id or 0, r.kept, r.n_shingles) for r in neardup.near_duplicates(df, shingle=3).collect())
    assert rows == [(0, 0, True, 0), (0, 0, True, 8), (4, 4, True, 8), (5, 4, False, 8), (5, 4, False, 8), (6, 4, False, 8), (6, 6, True, 0)]
    assert neardup.near_duplicates(df.limit(0)).count() == 0
    assert neardup.near_duplicates(df.filter("doc_id is null")).count() == 2


def test_match_threshold_misses_hardly_any():
    m, p = neardup.match_threshold(0.85), 0.85**neardup.ROWS
    n = neardup.COORDINATES
    miss = [sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k)) for k in (m, m + 1)]
    assert miss[0] <= neardup.MISS < miss[1]
    assert 1 <= neardup.match_threshold(0.5) <= neardup.match_threshold(0.8) <= neardup.match_threshold(0.99) < neardup.COORDINATES


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(300, i) for i in range(301, 360)] + [(400, 400)]
    links += [(i, i + 1) for i in range(500, 560)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op7_near_duplicates"](spark, folder).collect()
    assert {r.doc_id: r.component_id for r in rows} == brute.groups(texts, 3, 85)
    assert all(r.n_shingles == len(brute.shingles(texts[r.doc_id], 3)) for r in rows)


def test_groups_told_by_stars_take_no_rounds(spark, monkeypatch):
    from riskflow.llm import components as module

    kept = []
    stored = module.stored
    monkeypatch.setattr(module, "stored", lambda df, purpose: kept.append(purpose) or stored(df, purpose))
    links = [(5, 1), (6, 1), (1, 9), (7, 2), (3, 3), (5, 1)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 5: 1, 6: 1, 9: 1, 2: 2, 7: 2, 3: 3} and kept == ["links"]
    # A triangle is no star: 6 has two smaller neighbours.
    assert {r.component for r in components(spark.createDataFrame([(5, 1), (6, 1), (6, 5)], "a long, b long")).collect()} == {1}
    assert len(kept) > 2
