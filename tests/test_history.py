import random

import pytest
from pyspark.sql import functions as F

from riskflow.operators import history
from riskflow.operators.history import END, START

SNAPSHOT = "k string, v string, _ingested_at string, version int"


def as_set(df):
    return {(r.k, r.v, r[START], r[END]) for r in df.collect()}


def full(spark, rows, **kw):
    df = spark.createDataFrame(rows, SNAPSHOT)
    return as_set(history.scd2_from_snapshots(df, ["k"], "version", **kw))


def test_insert_change_delete_return(spark):
    rows = [
        ("same", "x", "i1", 1), ("same", "x", "i2", 3), ("same", "x", "i3", 7),
        ("changed", "x", "i", 1), ("changed", "y", "i", 3), ("changed", None, "i", 7),
        ("gone", "x", "i", 1), ("gone", "x", "i", 3),
        ("back", "x", "i", 1), ("back", "x", "i", 7),
        ("new", "x", "i", 7),
    ]
    assert full(spark, rows) == {
        ("same", "x", 1, None),
        ("changed", "x", 1, 3), ("changed", "y", 3, 7), ("changed", None, 7, None),
        ("gone", "x", 1, 7),
        ("back", "x", 1, 3), ("back", "x", 7, None),
        ("new", "x", 7, None),
    }


@pytest.mark.parametrize("kind", ["int", "bigint", "date", "timestamp", "timestamp_ntz"])
def test_versions_are_followed_in_order(spark, kind):
    rng = random.Random(kind)
    numbers = sorted({rng.choice([1, 3, 10**4, 10**5, 3 * 10**6]) * rng.randrange(1, 200) for _ in range(60)})
    make = {
        "date": "date_from_unix_date(cast(n % 3000000 as int))",
        "timestamp": "timestamp_micros(n * 1000003)",
        "timestamp_ntz": "cast(timestamp_micros(n * 1000003) as timestamp_ntz)",
    }.get(kind, f"cast(n - 50000 as {kind})")
    df = spark.createDataFrame([(n,) for n in numbers], "n bigint").selectExpr(f"{make} AS v")
    ordered = sorted(r.v for r in df.distinct().collect())
    got = {r.v: r["_next"] for r in history._followers(df, "v", None).collect()}
    assert got == dict(zip(ordered, [*ordered[1:], None]))


def test_version_order_takes_no_single_partition_and_no_job(spark):
    df = spark.createDataFrame([("a", "x", "i", 1)], SNAPSHOT)
    plan = history.scd2_from_snapshots(df, ["k"], "version")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_versions_that_have_no_number_must_be_named(spark):
    df = spark.createDataFrame([("a", "x", "i", "v1"), ("a", "y", "i", "v2")], "k string, v string, _ingested_at string, version string")
    with pytest.raises(TypeError):
        history.scd2_from_snapshots(df, ["k"], "version")
    assert as_set(history.scd2_from_snapshots(df, ["k"], "version", versions=["v1", "v2"])) == {("a", "x", "v1", "v2"), ("a", "y", "v2", None)}


@pytest.mark.parametrize("seed", range(4))
def test_full_history_equals_applying_snapshots_one_by_one(spark, seed):
    rng = random.Random(seed)
    versions = sorted(rng.sample(range(1, 30), 5))
    snapshots = {n: [(k, rng.choice(["x", "y", None]), f"i{n}", n) for k in "abcdef" if rng.random() < 0.7] for n in versions}
    snapshots = {n: rows for n, rows in snapshots.items() if rows}
    expected = full(spark, [r for rows in snapshots.values() for r in rows])

    state = spark.createDataFrame([], f"k string, v string, _ingested_at string, {START} int, {END} int")
    for n, rows in snapshots.items():
        snapshot = spark.createDataFrame(rows, SNAPSHOT).drop("version")
        state = history.scd2_apply(state, snapshot, ["k"], F.lit(n))
        state = spark.createDataFrame(state.collect(), state.schema)
    assert as_set(state) == expected


def test_unchanged_row_keeps_its_stamps(spark):
    current = spark.createDataFrame([("a", "x", "old"), ("b", "x", "old"), ("gone", "x", "old")], "k string, v string, _ingested_at string")
    snapshot = spark.createDataFrame([("a", "x", "new"), ("b", "y", "new"), ("c", None, "new")], "k string, v string, _ingested_at string")
    out = history.scd1_apply(current, snapshot, ["k"])
    assert out.columns == ["k", "v", "_ingested_at"]
    assert {tuple(r) for r in out.collect()} == {("a", "x", "old"), ("b", "y", "new"), ("c", None, "new")}


def test_current_rows(spark):
    df = spark.createDataFrame([("a", 1, 2), ("a", 2, None)], f"k string, {START} int, {END} int")
    assert [tuple(r) for r in history.current_rows(df).collect()] == [("a",)]


def test_full_history_shuffles_once_by_key(spark):
    df = spark.createDataFrame([("a", "x", "i", 1)], SNAPSHOT)
    plan = history.scd2_from_snapshots(df, ["k"], "version")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(k#") == 1 and plan.count("+- Sort [k#") == 1
