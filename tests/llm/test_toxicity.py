import random
import zlib

import numpy as np
import pytest

from riskflow.llm import toxicity as t
from riskflow.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, score string, predicted string"
INSULTS = ["idiot", "moron", "scum", "worthless", "pathetic"]
SYLLABLES = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "ti", "ing", "tion"]


def word(rng):
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))


def prose(rng, n):
    return " ".join(word(rng) + ("." if rng.random() < 0.1 else "") for _ in range(n))


def insult(rng, text, how=lambda w: w):
    words = text.split()
    for _ in range(rng.randint(1, 3)):
        words.insert(rng.randrange(len(words) + 1), how(rng.choice(INSULTS)))
    return " ".join(words)


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    texts, labels = [], []
    for i in range(900):
        text = prose(rng, rng.randint(5, 150))
        toxic = i % 6 == 0
        texts.append((insult(rng, text) if toxic else text).encode())
        labels.append(int(toxic))
    return t.fit_texts(texts, np.array(labels), (750, 150))


def scores(model, texts):
    raw = [x.encode() for x in texts]
    bounds = np.append(0, np.cumsum([len(x) for x in raw]))
    return model.probability(model.features(np.frombuffer(b"".join(raw), np.uint8), bounds))


def test_unseen_texts(model):
    rng = random.Random(2)
    clean = [prose(rng, rng.randint(5, 150)) for _ in range(300)]
    toxic = [insult(rng, prose(rng, rng.randint(5, 150))) for _ in range(300)]
    assert (scores(model, clean) < 0.5).mean() > 0.97
    assert (scores(model, toxic) >= 0.5).mean() > 0.97


@pytest.mark.parametrize(
    "how", [lambda w: w.upper(), lambda w: w + "!!", lambda w: w[:2] + "-" + w[2:], lambda w: w[:3] + "x" + w[3:], lambda w: w[0] + w[0] + w[1:]]
)
def test_gaps_and_inserted_characters(model, how):
    rng = random.Random(3)
    toxic = [insult(rng, prose(rng, 40), how) for _ in range(200)]
    clean = [prose(rng, 40) for _ in range(200)]
    assert (scores(model, toxic) >= 0.5).mean() > 0.8
    assert np.median(scores(model, toxic)) > np.quantile(scores(model, clean), 0.99)


def test_a_score_depends_on_the_text_alone(model):
    rng = random.Random(4)
    texts = [prose(rng, 20), "", "idiot", " ", "é", prose(rng, 3), "...", "moron x"]
    one_by_one = np.array([scores(model, [x])[0] for x in texts])
    assert np.array_equal(scores(model, texts), one_by_one)
    assert np.array_equal(scores(model, texts[::-1]), one_by_one[::-1])


def test_kernel_table_equals_the_kernel(model):
    """The folded table gives what the features of a string give."""
    rng = random.Random(5)
    landmarks = [t.word_codes(word(rng)) for _ in range(20)]
    kernel = t._Kernel(landmarks)
    w = np.random.RandomState(0).normal(size=kernel.root.shape[1])
    table = kernel.table(w)
    for _ in range(20):
        code = t.word_codes(word(rng) + word(rng))
        f, weight = t.subsequences(code)
        assert np.isclose((table[f] * weight).sum(), (kernel.features([code]) @ w)[0], rtol=1e-3, atol=1e-3)


def test_layout_of_texts():
    raw = [b"Ab  c", b"", b" x ", b"..", "é".encode()]
    bounds = np.append(0, np.cumsum([len(x) for x in raw]))
    codes, begin = t.encode(np.frombuffer(b"".join(raw), np.uint8), bounds)
    texts = [codes[a:b] for a, b in zip(begin, [*begin[1:], len(codes)])]
    assert [[int(c) for c in x if c != t.PAD] for x in texts] == [[0, 1, 2, 0, 3, 0], [0], [0, 24, 0], [0], [0, 27, 0]]


@pytest.mark.parametrize("labels", [[], [0, 0], [1, 1]])
def test_without_both_classes_the_score_is_constant(labels):
    model = t.fit_texts([b"some text"] * len(labels), np.array(labels, int), (labels.count(0), labels.count(1)))
    p = scores(model, ["a", "idiot idiot", ""])
    assert len(set(p)) == 1 and 0 <= p[0] <= 1


def test_fit_and_score_over_tables(spark):
    rng = random.Random(6)
    rows = [(i, insult(rng, prose(rng, 30)) if i % 4 == 0 else prose(rng, 30), "a", "b") for i in range(300)]
    df = spark.createDataFrame(rows + [(None, None, None, None), (900, "", "", ""), (900, "", "", "")], SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)] + [(None, 1), (900, None), (5, 7)], "doc_id long, toxic int")
    model = t.fit(df.filter(~t.held_out()), labels)
    out = t.score(df, model).collect()
    assert len(out) == 303 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    held = [r for r in out if r.doc_id is not None and r.doc_id < 300 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum(r.predicted == int(r.doc_id % 4 == 0) for r in held) >= 0.9 * len(held)
    assert len({r.score for r in out if not r.text}) == 1
    assert t.score(df.limit(0), model).count() == 0
    assert t.fit(df.limit(0), labels).probability(np.zeros((1, 3)))[0] <= 1


def test_long_text(model):
    rng = random.Random(8)
    p = scores(model, ["a b " + prose(rng, 100_000)])
    assert 0 <= p[0] <= 1


def test_query_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    rows = QUERIES["op1_subsequence_svm"](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p == y for p, y in held) >= 0.95 * len(held)


def test_the_sample_is_bounded_however_often_rows_repeat(spark, monkeypatch):
    """Rows of one labelled key, equal and different ones, and others; what is collected stays within the bound per class."""
    rng = random.Random(6)
    rows = [(1, "the same text")] * 2000 + [(1, prose(rng, 20)) for _ in range(300)] + [(i, prose(rng, 20)) for i in range(2, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (1, 0)] + [(i, i % 2) for i in range(2, 60)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(t, "fit_texts", lambda texts, marks, sizes: seen.append((texts, marks, sizes)))
    t.fit(docs, labels, most=100)
    texts, marks, sizes = seen[0]
    assert len(texts) <= 200 and sum(marks) <= 100 and len(texts) == len(marks)
    assert sizes == (301 + 29, 301 + 29)
