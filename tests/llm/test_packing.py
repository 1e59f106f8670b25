import random
from collections import Counter, defaultdict

import pytest

from riskflow.llm import packing
from riskflow.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, n string, bin_id string, used string"


def one_by_one(lengths, capacities, smallest):
    """Best fit, longest first, bin by bin."""
    plan = packing.Plan.__new__(packing.Plan)
    plan.capacities, plan.smallest = sorted(capacities), smallest
    bins = []
    for n in sorted(lengths, reverse=True):
        fitting = [b for b in bins if b[0] - b[1] >= n]
        if fitting:
            min(fitting, key=lambda b: b[0] - b[1])[1] += n
        else:
            bins.append([plan._opened(n), n])
    return sum(packing.cost(min((c for c in capacities if c >= used), key=packing.cost)) for _, used in bins), len(bins)


@pytest.mark.parametrize("seed", range(12))
def test_plan_equals_best_fit_bin_by_bin(seed):
    rng = random.Random(seed)
    capacities = rng.choice([(10,), (8, 16), (5, 12, 30), (16, 32, 64)])
    lengths = [rng.randint(1, capacities[-1]) for _ in range(rng.randint(1, 300))]
    for smallest in (None, *capacities):
        plan = packing.Plan(dict(Counter(lengths)), capacities, smallest)
        cost, bins = one_by_one(lengths, capacities, smallest)
        assert plan.bins == bins and abs(plan.total() - cost) < 1e-6
    best = packing.best_plan(dict(Counter(lengths)), capacities)
    assert all(best.total() <= packing.Plan(dict(Counter(lengths)), capacities, s).total() for s in (None, *capacities))


@pytest.mark.parametrize("seed", range(6))
def test_runs_place_every_rank_once(seed):
    rng = random.Random(seed)
    histogram = {n: rng.randint(1, 60) for n in rng.sample(range(1, 65), 20)}
    plan = packing.best_plan(histogram, (16, 32, 64))
    bins, ranks = defaultdict(list), defaultdict(list)
    for n, low, high, first, per, offset, capacity, used in plan.rows():
        for rank in range(low, high):
            ranks[n].append(rank)
            place = rank - low
            bins[first + place // per].append((offset + place % per * n, n, capacity, used))
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in histogram.items()}
    for parts in bins.values():
        at = 0
        for offset, n, capacity, used in sorted(parts):
            assert offset == at and used <= capacity
            at += n
        assert {(capacity, used) for _, _, capacity, used in parts} == {(parts[0][2], at)}


def whole(rows, sizes):
    bins, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        bins[r.bin_id].append(r)
        docs[r.doc_id].append(r)
    for parts in bins.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.n_tokens
        assert at == parts[0].used <= parts[0].capacity and len({(r.capacity, r.used) for r in parts}) == 1
    for key, size in sizes.items():
        at = 0
        for r in sorted(docs[key], key=lambda r: r.start):
            assert r.start == at
            at += r.n_tokens
        assert at == size


def test_long_texts_are_cut_and_put_together_again(spark):
    rng = random.Random(1)
    texts = {i: "".join(rng.choice("abcé ") for _ in range(rng.choice([0, 5, 40, 63, 300]))) for i in range(80)}
    df = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in texts.items()], SCHEMA)
    placed = packing.pack(df, capacities=(16, 64))
    rows = placed.collect()
    whole(rows, {i: len(t.encode()) + 1 for i, t in texts.items()})
    bins = {r.bin_id: r for r in packing.assemble(placed, df).collect()}
    back = defaultdict(dict)
    for r in rows:
        content = bytes(bins[r.bin_id].content)
        assert len(content) == r.used
        back[r.doc_id][r.start] = content[r.offset : r.offset + r.n_tokens]
    assert all(b"".join(v for _, v in sorted(back[i].items())) == t.encode() + b"\0" for i, t in texts.items())


def test_one_length_holds_most_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 10)
    rows = packing.pack(spark.createDataFrame([(i, "abc") for i in range(500)], "doc_id long, text string"), capacities=(10,)).collect()
    assert Counter(Counter(r.bin_id for r in rows).values()) == {2: 250}


def test_nulls_repeats_and_empty_table(spark):
    df = spark.createDataFrame([(None, None), (None, "ab"), (3, "ab"), (3, "ab"), (4, "")], "doc_id long, text string")
    rows = packing.pack(df, capacities=(8,)).collect()
    assert sorted(r.n_tokens for r in rows) == [1, 1, 3, 3, 3]
    whole(rows, {})
    assert packing.pack(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(df, capacities=())


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = QUERIES["op2_best_fit"](spark, folder).collect()
    texts = spark.read.parquet(f"{folder}/documents.parquet").collect()
    whole(rows, {r.doc_id: len(r.text.encode()) + 1 for r in texts})
    used = {r.bin_id: (r.used, r.capacity) for r in rows}.values()
    assert sum(u for u, _ in used) > 0.98 * sum(c for _, c in used)
