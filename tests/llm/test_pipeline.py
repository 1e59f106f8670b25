import random

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from riskflow.llm.frames import stored
from tests.llm import brute
from tests.llm.test_toxicity import insult, prose

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(folder):
    """Documents with what every stage must act on, and what it must leave alone."""
    rng = random.Random(11)
    item = prose(rng, 40)
    texts = {i: prose(rng, rng.randint(60, 120)) for i in range(300)}
    for i in range(0, 300, 6):
        texts[i] = insult(rng, texts[i])
    copies, base = {}, prose(rng, 200).split()
    for i in range(1000, 1030):
        words = list(base)
        words[rng.randrange(200)] = "changed"
        copies[i] = " ".join(words)
    leaks = {i: f"{prose(rng, 30)} {item} {prose(rng, 30)}" for i in range(2000, 2010)}
    masked = {i: f"{prose(rng, 30)} mail me.{i}@host.org now {prose(rng, 30)}" for i in range(3000, 3010)}
    return texts, copies, leaks, masked, item


def test_stages_one_after_the_other(spark, tmp_path):
    texts, copies, leaks, masked, item = corpus(tmp_path)
    rows = [(i, t, "en", "s", len(t)) for part in (texts, copies, leaks, masked) for i, t in part.items()]
    docs = spark.createDataFrame(rows + [(None, None, None, None, None), (5000, "", "en", "s", 0)], SCHEMA)
    folder = str(tmp_path)
    spark.createDataFrame([(i, int(i % 6 == 0)) for i in texts], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs.write.parquet(f"{folder}/documents.parquet")

    results = {}
    for name, stage in pipeline.STAGES:
        docs = stored(stage(spark, docs, folder), name)
        results[name] = docs
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]

    ids = {n: {r.doc_id for r in df.select("doc_id").collect()} for n, df in results.items() if n != "packing"}
    toxic = {i for i in texts if i % 6 == 0}
    kept = ids["toxicity"]
    assert len(kept & toxic) <= 5 and len((set(texts) - toxic) & kept) >= 240 and set(masked) <= kept
    before = {r.doc_id: r.text for r in results["toxicity"].collect() if r.doc_id is not None}
    groups = brute.groups(before, 5, 80)
    assert ids["near_duplicates"] - {None} == set(groups.values())
    assert None in ids["near_duplicates"]
    assert ids["decontamination"] == ids["near_duplicates"] - set(leaks)
    after = {r.doc_id: r for r in results["personal_data"].collect()}
    assert set(after) == ids["decontamination"]
    for i, r in after.items():
        if i in masked:
            assert "[EMAIL]" in r.text and "@" not in r.text and r.n_chars == len(r.text)
        elif i is not None:
            assert r.text == before[i]
    packed = results["packing"].collect()
    assert {i for r in packed for i in r.doc_ids} == set(after)
    content = b"".join(bytes(r.content) for r in packed)
    assert all(r.text.encode() in content for r in after.values() if r.text)
    assert all(len(r.content) == r.used <= r.capacity for r in packed)


def test_stages_take_empty_tables_and_repeated_rows(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    empty = spark.createDataFrame([], SCHEMA)
    twice = spark.createDataFrame([(1, "some text", "en", "s", 9)] * 2, SCHEMA)
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0
        assert stage(spark, twice, folder).count() <= 2
    assert pipeline.keep_one_of_each(spark, twice, folder).count() == 1


def test_repeated_keys_with_different_texts(spark, tmp_path):
    rng = random.Random(3)
    one, two, other = (prose(rng, 80) for _ in range(3))
    near = f"{two} end"
    rows = [(1, one), (1, two), (1, one), (2, near), (3, other), (3, other), (3, None), (4, one), (None, one)]
    docs = spark.createDataFrame([(i, t, "en", f"s{n}", 0) for n, (i, t) in enumerate(rows)], SCHEMA)
    results = [
        sorted(((r.doc_id, r.text, r.source) for r in pipeline.keep_one_of_each(spark, d, str(tmp_path)).collect()), key=str)
        for d in (docs, docs.repartition(5, "source"), docs.orderBy(F.desc("source")))
    ]
    kept = [(1, one, "s0"), (1, two, "s1"), (3, None, "s6"), (3, other, "s4"), (None, one, "s8")]
    assert results == [sorted(kept, key=str)] * 3


def test_columns_named_like_those_of_a_stage_pass_through(spark, tmp_path):
    folder, rng = str(tmp_path), random.Random(4)
    names = ["score", "predicted", "contaminated", "item_ids", "n_items", "best_percent", "overlaps", "personal", "_found", "_uid", "_row",
             "_doc", "_other", "_none", "_clean", "_key", "_text", "kept", "component_id", "_hash", "label", "toxic"]
    spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, prose(rng, 30))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    schema = SCHEMA + "".join(f", `{n}` string" for n in names)
    texts = [insult(rng, prose(rng, 80)) if i % 2 else prose(rng, 80) for i in range(40)]
    rows = [(i, t, "en", "s", len(t), *(f"mine {n}" for n in names)) for i, t in enumerate(texts)]
    rows += [(7, prose(rng, 80), "en", "s", 1, *(f"mine {n}" for n in names))]  # a repeated key
    docs = spark.createDataFrame(rows, schema)
    for name, stage in pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, folder), name)
        got = docs.collect()
        assert docs.columns == [f.name for f in spark.createDataFrame([], schema).schema] and got
        assert all(r[n] == f"mine {n}" for r in got for n in names)
    packed = pipeline.STAGES[-1][1](spark, docs, folder)
    assert packed.columns == ["bin_id", "capacity", "used", "doc_ids", "content"]
    assert {i for r in packed.collect() for i in r.doc_ids} == {r.doc_id for r in got}


def test_run(spark):
    out = pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["bin_id", "capacity", "used", "doc_ids", "content"] and out.count() > 0
