"""Toxicity by a subsequence string kernel with Nystroem landmarks and a support vector machine.

The kernel counts common subsequences of ORDER characters, gaps allowed up to SPAN characters in all, each gap character damping a
match by DECAY. An insult with characters put between its letters still shares most of its subsequences with the insult.

Sentences are read as windows of WINDOW characters from the start of each word. Their similarity to a set of landmark words gives
the Nystroem features of a window, and a linear SVM on these separates abuse from the rest. The labels belong to whole documents,
so every sentence carries its document's label and most sentences of a toxic document are harmless: as usual for such bags, the
fit alternates between choosing each toxic document's most suspicious windows and training on them against the most suspicious
windows of clean documents; the latter also become landmarks.

A trained score is linear in the subsequences of a window. It is folded into one table with a weight per subsequence (SYMBOLS **
ORDER numbers, 4 MB whatever the corpus), so scoring is a sum of table look-ups over whole texts.

The fit uses a bounded sample: up to MOST_FIT labelled documents of each class of at most FIT_CHARS characters, by a hash of the
key. Scoring reads every text whole.
"""

from __future__ import annotations

import itertools
import pickle
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.frames import extended, without
from riskflow.llm.wordhash import slices

ORDER, SPAN, DECAY, WINDOW = 4, 7, 0.8, 8
MOST_FIT, FIT_CHARS = 1500, 10_000
LANDMARKS, ROUNDS, PENALTY = 256, 5, 1.0
SLICE = 1 << 19
BLOCK = 1 << 19
#: Symbols of a word that tell it from others when words are counted.
PACKED = 12
#: Texts of the sample that are laid out at once.
FIT_PART = 64

SYMBOLS, PAD = 32, 31
_GAPS = [g for g in itertools.combinations(range(1, SPAN), ORDER - 1)]
_DAMP = [DECAY ** (g[-1] + 1 - ORDER) for g in _GAPS]


def _alphabet() -> np.ndarray:
    """Symbol of each UTF-8 byte: 0 is everything between words, letters in either case are 1 to 26, accented letters by their
    second byte in four classes; first bytes of longer sequences are dropped (255)."""
    out = np.zeros(256, np.uint8)
    for b in range(256):
        if b >= 0xC0:
            out[b] = 255
        elif b >= 0x80:
            low = b | 0x20
            out[b] = 27 if low == 0xA9 else 28 if low in (0xA8, 0xAA, 0xAB) else 29 if low in (0xB3, 0xB4, 0xB6) else 30
        elif chr(b).isalpha():
            out[b] = ord(chr(b).lower()) - 96
    return out


ALPHABET = _alphabet()


def encode(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of texts laid out with SPAN places of padding between them, one separator at either end of each text, and where
    each text begins (its first separator)."""
    codes = ALPHABET[data]
    keep = codes != 255
    kept = np.append(0, np.cumsum(keep))[bounds]
    codes = codes[keep]
    before = np.append(np.uint8(0), codes[:-1]) if len(codes) else codes
    before[kept[:-1][kept[:-1] < len(codes)]] = 0
    keep = (codes != 0) | (before != 0)
    bounds = np.append(0, np.cumsum(keep))[kept]
    codes = codes[keep]
    texts, gap = len(bounds) - 1, SPAN + 2
    out = np.full(len(codes) + gap * (texts + 1), PAD, np.uint8)
    text = np.repeat(np.arange(texts), np.diff(bounds))
    out[np.arange(len(codes)) + gap * (text + 1)] = codes
    begin = bounds[:-1] + gap * (np.arange(texts) + 1) - 1
    end = bounds[1:] + gap * (np.arange(texts) + 1)
    out[begin] = 0
    open_ = out[end - 1] != 0
    out[end[open_]] = 0
    return out, begin


def subsequences(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of one string: numbers of its subsequences, with their weights, starting at its first WINDOW places."""
    features, weights = [], []
    for at in range(min(WINDOW, len(codes))):
        for gaps, damp in zip(_GAPS, _DAMP):
            if at + gaps[-1] >= len(codes):
                continue
            number = int(codes[at])
            if PAD in (codes[at], *(codes[at + g] for g in gaps)):
                continue
            for g in gaps:
                number = number * SYMBOLS + int(codes[at + g])
            features.append(number)
            weights.append(damp)
    return np.array(features, np.int64), np.array(weights)


def word_codes(word: str) -> np.ndarray:
    raw = np.frombuffer(word.encode(), np.uint8)
    codes = ALPHABET[raw]
    return np.concatenate([[0], codes[codes != 255], [0]]).astype(np.uint8)


@dataclass
class Model:
    """table: weight per subsequence; bias of the SVM; calibration of (largest margin, log of hits, log of words)."""

    table: np.ndarray
    bias: float
    calibration: np.ndarray

    def windows(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Margins of the windows that begin at word starts, and where those are."""
        n = len(codes) - SPAN
        starts = np.flatnonzero((codes[:n] == 0) & (codes[1 : n + 1] != 0) & (codes[1 : n + 1] != PAD)) if n > 0 else np.zeros(0, int)
        margins = np.empty(len(starts), np.float32)
        reach = WINDOW + SPAN
        for first in range(0, n, BLOCK):
            lo, hi = np.searchsorted(starts, [first, first + BLOCK])
            if lo == hi:
                continue
            part = codes[first : min(len(codes), first + BLOCK + reach)]
            m = len(part) - SPAN
            wide = part.astype(np.int32)
            parts = [wide * SYMBOLS ** (ORDER - 1 - i) for i in range(ORDER)]
            sums = np.zeros(m, np.float32)
            for gaps, damp in zip(_GAPS, _DAMP):
                number = parts[0][:m].copy()
                for i, g in enumerate(gaps):
                    number += parts[i + 1][g : g + m]
                sums += np.float32(damp) * self.table[number]
            own = starts[lo:hi] - first
            # Each window is summed by itself: its margin does not depend on what stands before it.
            total = np.zeros(len(own), np.float32)
            for i in range(WINDOW):
                inside = own + i < m
                total[inside] += sums[own[inside] + i]
            margins[lo:hi] = total
        return margins + np.float32(self.bias), starts

    def features(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """(largest margin, log of hits, log of words) of each text; a text without words has margin -1 and no hits."""
        codes, begin = encode(data, bounds)
        margins, starts = self.windows(codes)
        texts = len(begin)
        at = np.searchsorted(starts, np.append(begin, len(codes)))
        count = np.diff(at)
        out = np.zeros((texts, 3))
        out[:, 0] = -1.0
        full = np.flatnonzero(count)
        if len(full):
            out[full, 0] = np.maximum.reduceat(margins, at[full])
            out[full, 1] = np.log1p(np.add.reduceat((margins > 0).astype(float), at[full]))
        out[:, 2] = np.log1p(count)
        return out

    def probability(self, features: np.ndarray) -> np.ndarray:
        z = np.clip(features @ self.calibration[:-1] + self.calibration[-1], -30, 30)
        return 1 / (1 + np.exp(-z))


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared hinge with a ridge, by Newton steps."""
    design = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(design.shape[1])
    ridge = np.full(design.shape[1], 1.0)
    ridge[-1] = 1e-6
    for _ in range(30):
        slack = 1 - y * (design @ w)
        on = slack > 0
        a, scale = design[on], 2 * PENALTY * weight[on]
        gradient = ridge * w - a.T @ (scale * y[on] * slack[on])
        step = np.linalg.solve(a.T @ (a * scale[:, None]) + np.diag(ridge), gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    design = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (weight * (p - y)) + 1e-3 * w
        hessian = design.T @ (design * (weight * p * (1 - p))[:, None]) + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-7:
            break
    return w


class _Kernel:
    """Similarities to a set of landmarks, and what they fold into."""

    def __init__(self, landmarks: list[np.ndarray]):
        found = [subsequences(c) for c in landmarks]
        self.known = np.unique(np.concatenate([f for f, _ in found]))
        self.weights = np.zeros((len(self.known), len(landmarks)), np.float32)
        for j, (f, w) in enumerate(found):
            np.add.at(self.weights[:, j], np.searchsorted(self.known, f), w)
        gram = self.weights.T.astype(float) @ self.weights
        values, vectors = np.linalg.eigh(gram)
        keep = values > values.max() * 1e-6
        self.root = vectors[:, keep] / np.sqrt(values[keep])

    def features(self, strings: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(strings), self.weights.shape[1]))
        for i, c in enumerate(strings):
            f, w = subsequences(c)
            at = np.searchsorted(self.known, f)
            at[at == len(self.known)] = 0
            hit = self.known[at] == f if len(f) else np.zeros(0, bool)
            out[i] = w[hit] @ self.weights[at[hit]] if hit.any() else 0
        return out @ self.root

    def table(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros(SYMBOLS**ORDER, np.float32)
        out[self.known] = self.weights @ (self.root @ w)
        return out


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64)


def fit_texts(texts: list[bytes], labels: np.ndarray, class_sizes: tuple[int, int], landmarks: int = LANDMARKS) -> Model:
    """Fit on a sample of documents. ``class_sizes``: documents of class 0 and 1 the sample stands for."""
    sizes = np.array(class_sizes, float)
    prior = sizes[1] / max(1.0, sizes.sum())
    if len(texts) == 0 or labels.min() == labels.max():
        p = min(max(prior, 1e-3), 1 - 1e-3)
        constant = np.array([0.0, 0.0, 0.0, np.log(p / (1 - p))])
        return Model(np.zeros(SYMBOLS**ORDER, np.float32), -1.0, constant)
    # In parts: laying out a text takes many times its size.
    parts, begins, size = [], [], 0
    for at in range(0, len(texts), FIT_PART):
        part, first = encode(*_joined(texts[at : at + FIT_PART]))
        parts.append(part)
        begins.append(first + size)
        size += len(part)
    codes, begin = np.concatenate(parts), np.concatenate(begins)
    del parts
    starts = np.flatnonzero((codes[:-1] == 0) & (codes[1:] != 0) & (codes[1:] != PAD))
    of = np.searchsorted(begin, starts, "right") - 1

    # Words by how much likelier a toxic document has them. A word is its first symbols, packed into one number.
    ends = np.append(np.flatnonzero((codes == 0) | (codes == PAD)), len(codes))
    stops = ends[np.searchsorted(ends, starts + 1)]
    packed = np.zeros(len(starts), np.int64)
    for j in range(1, PACKED + 1):
        at = np.minimum(starts + j, len(codes) - 1)
        packed = packed * SYMBOLS + np.where(starts + j < stops, codes[at], 0)
    order = np.lexsort((packed, of))
    once = order[np.append(True, (packed[order][1:] != packed[order][:-1]) | (of[order][1:] != of[order][:-1]))] if len(order) else order
    words, index = np.unique(packed[once], return_inverse=True)
    number = [max(1, int((labels == c).sum())) for c in (0, 1)]
    seen = [np.bincount(index[labels[of[once]] == c], minlength=len(words)) for c in (0, 1)]
    odds = np.log((seen[1] + 0.5) / number[1]) - np.log((seen[0] + 0.5) / number[0])
    long = words % SYMBOLS ** (PACKED - 2) != 0
    strong = np.flatnonzero(long & (seen[1] >= 3))
    suspects = strong[np.lexsort((words[strong], -odds[strong] * np.sqrt(seen[1][strong])))][: landmarks // 2]
    common = np.flatnonzero(long & (seen[0] > 0))
    harmless = common[np.lexsort((words[common], -seen[0][common]))][: landmarks // 4]

    def bare(word: int) -> np.ndarray:
        symbols = [(int(word) // SYMBOLS**i) % SYMBOLS for i in range(PACKED - 1, -1, -1)]
        return np.array([0, *[c for c in symbols if c], 0], np.uint8)

    chosen = [bare(words[i]) for i in [*suspects, *harmless]]
    if not chosen:
        chosen = [np.array([0, 1, 2, 0], np.uint8)]
    spare = landmarks - len(chosen)

    rng = np.random.RandomState(7)
    kernel = _Kernel(chosen)
    strength = np.full(len(chosen), -1.0)
    strength[: len(suspects)] = np.clip(odds[suspects], 0, None)
    model = Model(np.zeros(SYMBOLS**ORDER, np.float32), 0.0, np.zeros(4))
    model.table[kernel.known] = kernel.weights @ (strength / np.maximum(1e-9, (kernel.weights**2).sum(0)))
    weight_of = sizes / np.maximum(1, np.array(number))
    window = lambda s: codes[s : s + WINDOW + SPAN - 1]
    texts_at = np.searchsorted(starts, np.append(begin, len(codes)))
    for turn in range(ROUNDS):
        margins, _ = model.windows(np.append(codes, np.full(SPAN, PAD, np.uint8)))
        margins = margins[: len(starts)]
        positive, negative = [], []
        for d in range(len(texts)):
            lo, hi = texts_at[d], texts_at[d + 1]
            if lo == hi:
                continue
            best = lo + int(np.argmax(margins[lo:hi]))
            if labels[d]:
                positive.append(starts[best])
            else:
                negative += [starts[best], starts[rng.randint(lo, hi)]]
        if turn == 1 and spare:
            # What clean documents have that looks most like abuse.
            worst = sorted(negative[::2], key=lambda s: -margins[np.searchsorted(starts, s)])[:spare]
            kernel = _Kernel(chosen + [bare(packed[np.searchsorted(starts, s)]) for s in worst])
        x = kernel.features([window(s) for s in positive + negative])
        y = np.append(np.ones(len(positive)), -np.ones(len(negative)))
        balance = np.where(y > 0, len(y) / 2 / max(1, len(positive)), len(y) / 2 / max(1, len(negative)))
        w, bias = _svm(x, y, balance)
        model = Model(kernel.table(w), bias, np.zeros(4))
    features = np.concatenate([model.features(*_joined(texts[i : i + FIT_PART])) for i in range(0, len(texts), FIT_PART)])
    model.calibration = _logistic(features, labels.astype(float), weight_of[labels] / weight_of[labels].mean())
    return model


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", most: int = MOST_FIT) -> Model:
    """Fit on a bounded sample of the labelled documents, at most ``most`` different (key, text) per class. Null keys, texts and
    labels other than 0 and 1 are left out; repeated rows count once."""
    known = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label")).filter("_label in (0, 1)")
    short = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).filter(F.length("_text") <= FIT_CHARS)
    short = short.withColumn("_body", F.xxhash64("_text"))
    # Keys and hashes first: only the sample's texts are fetched. Rows that agree in key and text count once.
    joined = short.select("_key", "_body").distinct().join(known.distinct(), "_key").withColumn("_hash", F.xxhash64("_key"))
    sizes = {r["_label"]: r["count"] for r in joined.groupBy("_label").count().collect()}
    chosen = None
    for c in (0, 1):
        part = joined.filter(F.col("_label") == c).orderBy("_hash", "_key", "_body").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    sample = short.join(F.broadcast(chosen.select("_key", "_body", "_label", "_hash")), ["_key", "_body"])
    once = sample.groupBy("_key", "_body", "_label", "_hash").agg(F.min("_text").alias("_text"))
    rows = once.select("_text", "_label", "_hash").collect()
    rows = sorted(((r[2], r[0].encode(), r[1]) for r in rows))
    return fit_texts([r[1] for r in rows], np.array([r[2] for r in rows], int), (sizes.get(0, 0), sizes.get(1, 0)))


def _scorer(sent, text: str):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = pickle.loads(sent.value)
        for batch in batches:
            for first, after, data, bounds in slices(batch.column(batch.schema.names.index(text)), SLICE):
                p = model.probability(model.features(data, bounds))
                part = batch.slice(first, after - first)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p)], names=[*part.schema.names, "score"])

    return score


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of ``docs`` (clashing ones are replaced), score (0 to 1) and predicted (1 from 0.5).

    Only the text is read. Null and empty texts and texts without letters get the score of a text without words; equal texts get
    equal scores, whatever surrounds them. An empty table gives an empty result.
    """
    base = without(docs, ["score", "predicted"])
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    scored = base.mapInArrow(_scorer(sent, text), extended(base, "score double"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def held_out(key: str = "doc_id"):
    """A fifth of the keys, by checksum, is never learnt from."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0
