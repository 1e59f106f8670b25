import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskflow.llm import sharding
from riskflow.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, source string, shard string, size string"


def check(rows, shards):
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) <= set(range(shards))
    counts = [sizes[i] for i in range(shards)]
    assert max(counts) - min(counts) <= 1
    for i in sizes:
        assert sorted(r.slot for r in rows if r.shard == i) == list(range(sizes[i]))


@pytest.mark.parametrize("bucket_rows", [3, 4096])
def test_mixture_of_every_shard(spark, bucket_rows):
    rows = [(i, f"text {i}", "hot" if i % 3 else f"s{i % 4}", "x", "y") for i in range(600)]
    out = sharding.assign_shards(spark.createDataFrame(rows, SCHEMA), 5, bucket_rows=bucket_rows).collect()
    assert len(out) == 600
    check(out, 5)
    mix = Counter((r.shard, r.source) for r in out)
    total = Counter(r.source for r in out)
    for s, n in total.items():
        assert all(abs(mix[(i, s)] - n / 5) <= 1.5 for i in range(5))


def test_bucket_size_does_not_matter(spark):
    rows = [(i, "t", f"s{i % 3}", None, None) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {tuple(r) for r in sharding.assign_shards(df, 4, bucket_rows=2).collect()} == {
        tuple(r) for r in sharding.assign_shards(df, 4, bucket_rows=1000).collect()
    }


def test_nulls_repeats_and_long_texts(spark):
    rows = [(None, None, None, "a", "b"), (1, "", None, "a", "b"), (1, "", None, "a", "b"), (2, "é" * 100_000, "", "a", "b")]
    out = sharding.assign_shards(spark.createDataFrame(rows, SCHEMA), 3).collect()
    check(out, 3)
    assert sorted(r["size"] for r in out) == [1, 1, 1, 200_001]
    assert {r.source for r in out} == {None, ""}
    assert [r.text_crc32 for r in out if r["size"] == 200_001] == [zlib.crc32(("é" * 100_000).encode())]


def test_empty_and_fewer_rows_than_shards(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert sharding.assign_shards(df).count() == 0
    one = sharding.assign_shards(spark.createDataFrame([(1, "a", "s", "", "")], SCHEMA), 8).collect()
    assert len(one) == 1 and one[0].slot == 0
    with pytest.raises(ValueError):
        sharding.assign_shards(df, 0)


def test_written_shards(spark, tmp_path):
    df = spark.createDataFrame([(i, f"t{i}", "s", "x", "y") for i in range(50)], SCHEMA)
    sharding.write_shards(df, sharding.assign_shards(df, 4), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 50 and back.select("text").distinct().count() == 50


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    out = QUERIES["op9_interleaved_shards"](spark, folder)
    rows = out.collect()
    check(rows, 8)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    assert all(r["size"] == len(texts[r.doc_id].encode()) + 1 for r in rows)
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in rows)
    assert out.filter("law != 'rows' or grown_shard is not null").isEmpty()
    assert out.select(F.countDistinct("doc_id")).first()[0] == len(texts)


def brute(rows, shards, seed="shards-1"):
    """(key, source, size, crc, shard, slot) from the definition: sort all rows by fractional rank, cut into equal runs."""
    by_source = {}
    for key, text, source in rows:
        body = (text or "").encode()
        mark = hashlib.md5(f"{seed}:{'' if key is None else key}:{zlib.crc32(body)}".encode()).hexdigest()
        stratum = "n" if source is None else "v" + source
        by_source.setdefault(stratum, []).append((mark, (key is not None, key or 0), len(body) + 1, zlib.crc32(body), key, source))
    placed = []
    for stratum, own in by_source.items():
        for rank, row in enumerate(sorted(own, key=lambda r: r[:4])):
            placed.append(((2 * rank + 1) / (2 * len(own)), stratum, *row))
    placed.sort(key=lambda r: r[:6])
    out, n = [], len(placed)
    for place, (_, _, _, _, size, crc, key, source) in enumerate(placed):
        shard = next(s for s in reversed(range(shards)) if s * n // shards <= place)
        out.append((key, source, size, crc, shard, place - shard * n // shards))
    return sorted(out, key=repr)


def test_order_against_brute_force(spark):
    rows = [(None if i % 11 == 0 else i // 2, None if i % 7 == 0 else f"é{i // 3}", [None, "", "hot", "hot", "s1"][i % 5]) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for shards in (1, 3, 8):
        out = sharding.assign_shards(df, shards, bucket_rows=13).collect()
        assert sorted(((r.doc_id, r.source, r["size"], r.text_crc32, r.shard, r.slot) for r in out), key=repr) == brute(rows, shards)


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    out = QUERIES["op9_interleaved_shards"](spark, folder).collect()
    assert sorted(((r.doc_id, r.source, r["size"], r.text_crc32, r.shard, r.slot) for r in out), key=repr) == brute(rows, 8)
