"""Near-duplicate groups by an inverted join on signature coordinates.

A document is its set of word shingles. A signature has COORDINATES coordinates, each folding ROWS independent minima, so two
sets of similarity s agree in a coordinate with probability s ** ROWS and unrelated sets hardly ever do. Documents are posted
under their (coordinate, value) pairs; posted copies of one set count once. A pair whose signatures agree in at least
``matches`` coordinates is a candidate. By the prefix principle such a pair meets in one of the first
COORDINATES - matches + 1 coordinates, so only those are posted; the others (the skipped suffix) are looked up for pairs that
need them to reach the threshold. Candidates are confirmed on the full shingle sets of the whole texts.

Groups are wanted, not all their pairs. In a star round every document is compared with one pivot only: of the documents that
lead a list it is posted in, the one it collides with most. A list is led by its most central document, that with the fewest
shingles of its own (found in no other posted document). After the star rounds the pairs between different groups are counted
and confirmed, all that can be linked. Two exact bounds rule out the others while lists are joined: shingles of its own are common
with nobody; and sets whose odd sketches (the parity of the shingles in each of ODD_BITS buckets) differ in n bits differ in
at least n shingles. No link between groups is lost; the pairs within a group are never made.

``matches`` is the largest threshold that a pair at exactly the wanted similarity misses with a chance below MISS.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.components import components
from riskflow.llm.frames import stored
from riskflow.llm.wordhash import mix, shingle_sets, slices, words

COORDINATES = 24
ROWS = 3
MISS = 1e-5
STAR_ROUNDS = 2
ODD_BITS = 1024

_random = np.random.RandomState(20240501)
_XOR = np.array([int.from_bytes(_random.bytes(8), "little") for _ in range(COORDINATES * ROWS)], np.uint64)
_MUL = np.array([int.from_bytes(_random.bytes(8), "little") | 1 for _ in range(COORDINATES * ROWS)], np.uint64)

SIGNED = "_id long, n_shingles long, _set1 long, _set2 long, _signature array<long>, _odd array<long>"


def match_threshold(similarity: float) -> int:
    p, tail, m = similarity**ROWS, 0.0, 0
    while m < COORDINATES:
        tail += math.comb(COORDINATES, m) * p**m * (1 - p) ** (COORDINATES - m)
        if tail > MISS:
            break
        m += 1
    return max(1, m)


def _signatures(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of COORDINATES values per set; sets must not be empty."""
    out = np.empty((COORDINATES, len(bounds) - 1), np.uint64)
    for c in range(COORDINATES):
        folded = np.full(len(bounds) - 1, c + 1, np.uint64)
        for r in range(c * ROWS, c * ROWS + ROWS):
            least = np.minimum.reduceat((sets ^ _XOR[r]) * _MUL[r], bounds[:-1])
            folded = mix(folded * _MUL[0] + least)
        out[c] = folded
    return out.T.copy()


def _odd_sketches(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row of ODD_BITS bits, as 64-bit numbers, per set."""
    n = len(at) - 1
    out = np.empty((n, ODD_BITS // 64), np.int64)
    bucket = (sets >> np.uint64(20)).astype(np.int64) % ODD_BITS
    for first in range(0, n, 1024):
        after = min(n, first + 1024)
        row = np.repeat(np.arange(after - first), np.diff(at[first : after + 1]))
        counts = np.bincount(row * ODD_BITS + bucket[at[first] : at[after]], minlength=(after - first) * ODD_BITS)
        out[first:after] = np.packbits((counts & 1).astype(np.uint8)).view(np.int64).reshape(after - first, -1)
    return out


def _lists(rows: np.ndarray, full: np.ndarray) -> pa.ListArray:
    """Rows as lists; empty where not ``full``."""
    counts = np.where(full, rows.shape[1], 0)
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(rows[full].reshape(-1)))


def _signer(k: int, fold: bool):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, after, data, bounds in slices(batch.column(1)):
                sets, at = shingle_sets(words(data, bounds, fold), k)
                sizes = np.diff(at)
                full = sizes > 0
                sums = np.zeros((2, len(sizes)), np.uint64)
                lists = np.zeros((len(sizes), COORDINATES), np.uint64)
                if full.any():
                    starts = np.append(at[:-1][full], at[-1])
                    sums[0, full] = np.add.reduceat(mix(sets), starts[:-1])
                    sums[1, full] = np.add.reduceat(mix(sets ^ _XOR[1]), starts[:-1])
                    lists[full] = _signatures(sets, starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, after - first),
                        pa.array(sizes),
                        *map(pa.array, sums.view(np.int64)),
                        _lists(lists.view(np.int64), full),
                        _lists(_odd_sketches(sets, at), full),
                    ],
                    names=["_id", "n_shingles", "_set1", "_set2", "_signature", "_odd"],
                )

    return sign


def _confirmer(k: int, fold: bool, percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, after, data, bounds in slices(batch.column(2)):
                sets, at = shingle_sets(words(data, bounds, fold), k)
                other: dict[str, np.ndarray] = {}
                linked = np.zeros(after - first, bool)
                seconds = batch.column(3).slice(first, after - first)
                for n, (f, a, data2, bounds2) in enumerate(slices(seconds)):
                    sets2, at2 = shingle_sets(words(data2, bounds2, fold), k)
                    for i in range(f, a):
                        one, two = sets[at[i] : at[i + 1]], sets2[at2[i - f] : at2[i - f + 1]]
                        if 100 * min(len(one), len(two)) < percent * max(len(one), len(two)):
                            continue
                        both = len(np.intersect1d(one, two, assume_unique=True))
                        linked[i] = 100 * both >= percent * (len(one) + len(two) - both)
                keep = np.flatnonzero(linked) + first
                if len(keep):
                    yield batch.take(pa.array(keep)).select([0, 1])

    return confirm


def _spreader(k: int, fold: bool):
    """Every shingle of every text, with its row."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, after, data, bounds in slices(batch.column(1)):
                sets, at = shingle_sets(words(data, bounds, fold), k)
                rows = np.repeat(batch.column(0).to_numpy(zero_copy_only=False)[first:after], np.diff(at))
                yield pa.RecordBatch.from_arrays([pa.array(sets.view(np.int64)), pa.array(rows)], names=["shingle", "cid"])

    return spread


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80, fold: bool = True
) -> DataFrame:
    """One row per input row: key, n_shingles, component_id, kept.

    Two documents are linked if 100 * common shingles >= ``percent`` * all shingles of both. component_id is the smallest key
    reachable over links; kept marks the rows whose key that is. ``fold`` reads A-Z as a-z. A text of fewer than ``shingle``
    words is one shingle; a null text or one without words has none and is linked with nothing, its component is its own key.
    Equal sets are one class, however many rows have them. A row without a key takes part in nothing: its component is null and
    it is kept. Rows that repeat a key are one document with all their texts. An empty table gives an empty
    result. Other columns are not read.
    """
    keyed = docs.select(F.col(key).cast("long").alias("_id"), F.col(text).cast("string").alias("_text"))
    signed = stored(keyed.mapInArrow(_signer(shingle, fold), SIGNED), "signatures")
    linkable = signed.filter("_id is not null and n_shingles > 0")
    classes = linkable.groupBy("_set1", "_set2").agg(
        F.min("_id").alias("cid"),
        F.max("n_shingles").alias("n_shingles"),
        F.any_value("_signature").alias("signature"),
        F.any_value("_odd").alias("odd"),
    )
    classes = stored(classes, "classes")
    groups = _groups(keyed, classes, shingle, percent, fold)
    known = classes.join(groups.withColumnRenamed("id", "cid"), "cid", "left").select(
        "_set1", "_set2", F.coalesce("component", "cid").alias("_component")
    )
    placed = signed.join(known, ["_set1", "_set2"], "left")
    own = F.when(F.col("n_shingles") > 0, F.col("_component")).otherwise(F.col("_id"))
    return placed.select(
        F.col("_id").alias(key),
        "n_shingles",
        F.when(F.col("_id").isNotNull(), own).alias("component_id"),
        F.coalesce(F.col("_id") == own, F.lit(True)).alias("kept"),
    )


def _groups(keyed: DataFrame, classes: DataFrame, k: int, percent: int, fold: bool) -> DataFrame:
    """(id, component) of every document with a confirmed link."""
    matches = match_threshold(percent / 100)
    prefix = COORDINATES - matches + 1
    every = classes.select("cid", F.explode(F.slice("signature", 1, prefix)).alias("value"))
    # A list is its (coordinate, value): the value was folded with its coordinate already.
    lists = every.groupBy("value").agg(F.min("cid").alias("low"), F.max("cid").alias("high")).filter("low < high")
    every = stored(every.join(lists.select("value"), "value").select("value", "cid"), "postings")
    ids = every.select(F.col("cid").alias("_id")).distinct()
    members = stored(keyed.join(ids, "_id", "left_semi").dropDuplicates(["_id", "_text"]), "members")

    # Shingles of a document that no other posted one has. Counts are combined before the shuffle; a single owner is its minimum.
    each = members.select("_id", "_text").mapInArrow(_spreader(k, fold), "shingle long, cid long")
    owners = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("cid").alias("cid")).filter("n = 1")
    own = owners.groupBy("cid").agg(F.count(F.lit(1)).alias("own"))
    # A key that repeats with several texts is not bounded: it may reach anything.
    sizes = classes.groupBy("cid").agg(F.max("n_shingles").alias("size"), F.count(F.lit(1)).alias("sets"))
    several = F.col("sets") > 1
    able = sizes.join(own, "cid", "left").select(
        "cid",
        F.when(several, 0).otherwise(F.col("size")).alias("size"),
        F.coalesce("own", F.lit(0)).alias("own"),
        F.when(several, F.lit(2**40)).otherwise(F.col("size") - F.coalesce("own", F.lit(0))).alias("shared"),
    )
    # A link has at least this part of either set in common.
    able = able.filter(100 * F.col("shared") >= percent * F.col("size"))
    posted = stored(every.join(able, "cid"), "able-postings")
    signatures = classes.select("cid", "signature")

    def reachable(x: str, y: str) -> Column:
        """Whether two sets can have enough in common: common * (100 + percent) >= percent * (both sizes)."""
        common = F.least(F.col(f"{x}shared"), F.col(f"{y}shared"))
        return common * (100 + percent) >= percent * (F.col(f"{x}size") + F.col(f"{y}size"))

    def candidates(met: DataFrame) -> DataFrame:
        """Pairs (a, b, n) with enough matches, of pairs with ``n`` collisions in the prefix."""
        enough = met.filter(f"n >= {matches}")
        if matches == 1:
            return enough
        short = met.filter(f"n < {matches}")
        suffix = F.slice("signature", prefix + 1, matches - 1)
        ends = [signatures.select(F.col("cid").alias(c), suffix.alias(f"of_{c}")) for c in "ab"]
        probed = short.join(ends[0], "a").join(ends[1], "b")
        same = F.size(F.filter(F.zip_with("of_a", "of_b", lambda x, y: x == y), lambda x: x))
        return enough.unionByName(probed.withColumn("n", F.col("n") + same).filter(f"n >= {matches}").select("a", "b", "n"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        first = members.select(F.col("_id").alias("a"), F.col("_text").alias("ta"))
        second = members.select(F.col("_id").alias("b"), F.col("_text").alias("tb"))
        both = pairs.select("a", "b").join(first, "a").join(second, "b").select("a", "b", "ta", "tb")
        return stored(both.mapInArrow(_confirmer(k, fold, percent), "a long, b long"), "confirmed")

    def joined(links: DataFrame, groups: DataFrame | None) -> DataFrame:
        """(id, component) of the groups found so far and the links found since. A group is told by its stars, which take no
        rounds to find again."""
        if groups is not None:
            links = links.unionByName(groups.select(F.col("id").alias("a"), F.col("component").alias("b")))
        return stored(components(links), "groups")

    def grouped(groups: DataFrame) -> DataFrame:
        """Postings with their group, of lists that hold several groups."""
        groups = groups.withColumnRenamed("id", "cid")
        labelled = posted.join(groups, "cid", "left").withColumn("group", F.coalesce("component", "cid")).drop("component")
        mixed = labelled.groupBy("value").agg(F.min("group").alias("low"), F.max("group").alias("high")).filter("low < high")
        return stored(labelled.join(mixed.select("value"), "value"), "open-lists")

    groups, tested, open_lists = None, None, posted.withColumn("group", F.col("cid"))
    for turn in range(STAR_ROUNDS):
        # The most central document leads; among equals another one in each round.
        order = F.struct("own", F.xxhash64("cid", F.lit(turn)), "cid", "group", "size", "shared")
        lead = open_lists.groupBy("value").agg(F.min(order).alias("lead")).select("value", "lead.*")
        lead = lead.select("value", *[F.col(c).alias(f"l_{c}") for c in ("cid", "group", "size", "shared")])
        met = (
            open_lists.join(lead, "value")
            .filter((F.col("l_group") != F.col("group")) & reachable("", "l_"))
            .groupBy(F.col("cid").alias("a"), F.col("l_cid").alias("b"))
            .agg(F.count(F.lit(1)).alias("n"))
        )
        able_pairs = candidates(met)
        if tested is not None:
            able_pairs = able_pairs.join(tested, ["a", "b"], "left_anti")
        best = able_pairs.groupBy("a").agg(F.max_by("b", F.struct("n", -F.col("b"))).alias("b"))
        pairs = stored(best, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        groups = joined(confirmed(pairs), groups)
        open_lists = grouped(groups)

    odd = [f"odd{i}" for i in range(ODD_BITS // 64)]
    single = classes.groupBy("cid").agg(F.any_value("odd").alias("odd"), F.count(F.lit(1)).alias("sets")).filter("sets = 1")
    sketches = single.select("cid", *[F.get("odd", F.lit(i)).alias(c) for i, c in enumerate(odd)])
    sketched = stored(open_lists.join(sketches, "cid", "left"), "sketched-lists")
    x, y = sketched.alias("x"), sketched.alias("y")
    differ = F.lit(0)
    for c in odd:
        differ = differ + F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}")))
    near = differ * (100 + percent) <= (100 - percent) * (F.col("x.size") + F.col("y.size"))
    apart = (F.col("x.group") != F.col("y.group")) & (F.col("x.cid") > F.col("y.cid")) & reachable("x.", "y.")
    apart = apart & F.coalesce(near, F.lit(True))
    met = (
        x.join(y, (F.col("x.value") == F.col("y.value")) & apart)
        .groupBy(F.col("x.cid").alias("a"), F.col("y.cid").alias("b"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = tested.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    last = stored(candidates(met).join(known, ["a", "b"], "left_anti"), "pairs")
    return joined(confirmed(last), groups)
