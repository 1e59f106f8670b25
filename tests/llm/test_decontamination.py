import itertools
import random

import numpy as np

from riskflow.llm import decontamination as d
from riskflow.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, contaminated string, overlaps string"
RNG = random.Random(5)
WORDS = [f"{a}{b}{c}" for a in "bcdf" for b in "aeiou" for c in "lmnrst"]


def prose(n):
    return [RNG.choice(WORDS) for _ in range(n)]


ITEM = prose(30)


def judge(spark, texts, items=None):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], SCHEMA)
    bench = spark.createDataFrame(items or [(7, " ".join(ITEM))], "item_id long, text string")
    return d.decontaminate(df, bench).orderBy("doc_id").collect()


def test_masks_survive_any_two_replaced_words_of_thirteen():
    for gone in itertools.combinations(range(13), 2):
        assert any(all(s + p not in gone for p in m) for m in d.MASKS for s in range(13 - m[-1]))


def test_masks_of_an_item_survive_every_permitted_replacement():
    for n in range(d.LEAST_WORDS, d.WINDOW + 1):
        for k in range(n + 1):
            if 100 * (n - k) < d.EQUAL * n:
                break
            for gone in itertools.combinations(range(n), k):
                assert any(all(s + p not in gone for p in m) for m in d._masks_for(n) for s in range(n - m[-1])), (n, gone)


def test_short_items_with_replaced_words_are_found(spark):
    texts, items = [], [(n, " ".join(ITEM[:n])) for n in (11, 12)]
    for n, gone in [(11, (5,)), *[(11, g) for g in itertools.combinations(range(11), 2)], *[(12, g) for g in itertools.combinations(range(12), 2)]]:
        part = [w if i not in gone else "zzz" for i, w in enumerate(ITEM[:n])]
        texts.append((n, " ".join([*prose(20), *part, *prose(20)])))
    rows = judge(spark, [t for _, t in texts], items)
    assert all(n in r.item_ids for (n, _), r in zip(texts, rows))


def test_every_pair_of_replaced_words_is_tolerated(spark):
    texts = []
    for gone in itertools.combinations(range(13), 2):
        part = [w if i not in gone else "zzz" for i, w in enumerate(ITEM[5:18])]
        texts.append(" ".join([*prose(40), *part, *prose(40)]))
    rows = judge(spark, texts)
    assert all(r.contaminated and r.item_ids == [7] for r in rows)


def test_whole_passages_case_and_punctuation(spark):
    loud = ", ".join(w.upper() for w in ITEM)
    text = f"é😀 {' '.join(prose(50))}\n{loud}! {' '.join(prose(50))}"
    r = judge(spark, [text])[0]
    assert r.contaminated and r.best_percent == 100.0
    assert text[r.overlaps[0].start : r.overlaps[0].end] == loud


def test_clean_texts_are_left_alone(spark):
    shuffled = ITEM[:]
    RNG.shuffle(shuffled)
    texts = [" ".join(prose(3000)), " ".join(shuffled), " ".join(ITEM[:12]), "", None, "x", " ".join(ITEM[::2])]
    assert [r.contaminated for r in judge(spark, texts)] == [False] * len(texts)


def test_items_in_blocks_give_the_same(spark, monkeypatch):
    items = [(i, " ".join(prose(20))) for i in range(12)]
    texts = [" ".join([*prose(20), *t.split(), *prose(5)]) for _, t in items] + [" ".join(prose(300))]
    whole = judge(spark, texts, items)
    monkeypatch.setattr(d, "BLOCK_WORDS", 50)
    assert judge(spark, texts, items) == whole
    assert [r.item_ids for r in whole] == [[i] for i in range(12)] + [[]]


def test_short_null_and_empty_items(spark):
    items = [(1, " ".join(ITEM[:9])), (2, "a b"), (3, None), (4, ""), (5, " ".join(ITEM[20:26])), (None, " ".join(prose(20)))]
    texts = [" ".join([*prose(20), *ITEM[:9], *prose(20)]), "A, b!", "x a b", f"x {items[4][1]} y", f"{items[5][1]} z", "a b"]
    texts.append(" ".join([*ITEM[20:23], "zzz", *ITEM[24:26]]))  # one of six words replaced: too little
    rows = judge(spark, texts, items)
    assert [r.item_ids for r in rows] == [[1], [2], [], [5], [None], [2], []]
    assert not judge(spark, ["a b"], [(1, None)])[0].contaminated


def brute(text, items):
    """Items with some window of WINDOW words (the whole item, if shorter) at EQUAL percent on some diagonal."""
    found, words = [], text.split()
    for i, item in items:
        own = item.split()
        width = min(d.WINDOW, len(own))
        hit = any(
            100 * sum(0 <= s + k < len(words) and words[s + k] == own[p + k] for k in range(width)) >= d.EQUAL * width
            for p in range(len(own) - width + 1)
            for s in range(len(words) - width + 1)
        )
        found += [i] if hit else []
    return found


def test_substituted_overlaps_against_brute_force(spark):
    """Passages of every length with any share of words replaced, over few words so that chance hits occur too."""
    draw = random.Random(9)
    few = WORDS[:12]
    items = [(i, " ".join(draw.choice(few) for _ in range(draw.choice([8, 9, 11, 12, 13, 20, 30])))) for i in range(6)]
    texts = []
    for _ in range(150):
        own = draw.choice(items)[1].split()
        low = draw.randrange(len(own))
        part = own[low : low + draw.randrange(8, 31)]
        rate = draw.choice([0, 0.1, 0.2, 0.3])
        part = [w if draw.random() > rate else draw.choice(few) for w in part]
        texts.append(" ".join([*(draw.choice(few) for _ in range(draw.randrange(20))), *part, *(draw.choice(few) for _ in range(draw.randrange(20)))]))
    want = [brute(t, items) for t in texts]
    assert 20 < sum(map(bool, want)) < 140
    assert [r.item_ids for r in judge(spark, texts, items)] == want


def test_a_repeated_word_gives_one_hit_per_diagonal():
    a, b = np.uint64(11), np.uint64(12)
    for item, text in (([a] * 400, [a] * 10_000), ([a, b] * 200, [a, b] * 5_000)):
        table = d.SeedTable([(1, np.array(item, np.uint64))])
        hits = table.hits(np.array(text, np.uint64), np.array([0, len(text)]))
        assert len(hits) <= len(item) + len(text)
        assert table.overlap(0, np.array(text, np.uint64), 7 if item[1] == a else 8, 0, len(text))[3] == 100.0


def test_a_large_benchmark_takes_one_python_stage_per_job(spark, monkeypatch):
    """Every job has one Python stage over the documents, whatever the number of blocks."""
    items = [(i, " ".join(prose(40))) for i in range(60)]
    monkeypatch.setattr(d, "BLOCK_WORDS", 400)
    df = spark.createDataFrame([(i, t) for i, t in items], "doc_id long, text string")
    out = d.decontaminate(df, spark.createDataFrame(items, "item_id long, text string"))
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 0
    assert all(r.item_ids == [r.doc_id] for r in out.collect())


def test_nulls_repeats_clashes_and_empty_table(spark):
    leak = " ".join(ITEM)
    df = spark.createDataFrame([(None, leak, "x", "y"), (None, "clean", "x", "y"), (1, leak, "x", "y"), (1, leak, "x", "y")], SCHEMA)
    bench = spark.createDataFrame([(7, leak)], "item_id long, text string")
    rows = d.decontaminate(df, bench).collect()
    assert sorted(r.contaminated for r in rows) == [False, True, True, True]
    assert d.decontaminate(df.limit(0), bench).count() == 0
    assert not any(r.contaminated for r in d.decontaminate(df, bench.limit(0)).collect())


def test_long_text(spark):
    text = " ".join([*prose(60_000), *ITEM, *prose(60_000)])
    assert judge(spark, [text])[0].item_ids == [7]


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op5_spaced_seeds"](spark, folder).collect()
    assert len(rows) == len(texts)
    verbatim = {i for i, t in texts.items() if any(x in t for x in items)}
    assert {r.doc_id for r in rows if r.contaminated} == verbatim
