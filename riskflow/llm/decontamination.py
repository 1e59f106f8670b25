"""Benchmark decontamination by spaced seeds.

A seed is a window of words of which a fixed mask ignores some places; its hash is the chain of the words kept. The seeds of the
benchmark items are joined with those of every document, and around each hit the item is laid over the document on the hit's
diagonal. An overlap counts if some WINDOW consecutive words (the whole item, if it is shorter) agree in at least EQUAL percent
of their places, so replaced words are tolerated: any 2 replaced words in 13 still leave a seed of the two masks intact. Shorter
items have a contiguous seed of a third of their words besides; of it, too, one is intact however the permitted words are replaced.

The benchmark is the query set. It is taken in blocks of about BLOCK_WORDS words; the seeds of one block are a lookup table in
every task. A larger benchmark means more blocks, each a job of its own over the documents whose finds are stored, never a larger
table nor more Python workers to a task.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.frames import stored, without
from riskflow.session import work_folder
from riskflow.llm.wordhash import NOT_ALNUM, chain, slices, string_bytes, words

#: Places of the words that count; every choice of 2 places out of 13 misses one of the masks at some shift.
MASKS = ((0, 3, 4, 5, 6, 8), (0, 1, 3, 5, 9, 10))
WINDOW = 13
EQUAL = 80
#: Items of fewer words must be there word for word; those of fewer than BRIEF must be the whole text, as such phrases are everywhere.
LEAST_WORDS, BRIEF = 8, 4
BLOCK_WORDS = 500_000

OVERLAPS = "array<struct<item_id:bigint,start:bigint,end:bigint,n_equal:bigint,percent:double>>"


def _seeds(hashes: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    n = len(hashes) - mask[-1]
    return chain([hashes[m : m + n] for m in mask], mask[-1]) if n > 0 else np.zeros(0, np.uint64)


def _masks_for(n: int) -> list[tuple[int, ...]]:
    """Items shorter than WINDOW also get a contiguous mask of a third of their length: the masks that fit do not cover them. Items
    shorter than LEAST_WORDS get one of all their words."""
    if n < LEAST_WORDS:
        return [tuple(range(n))]
    fitting = [m for m in MASKS if m[-1] < n]
    return fitting if n >= WINDOW else [*fitting, tuple(range(max(1, n // 3)))]


class SeedTable:
    """Seeds of a block of items: by mask the sorted hashes, with the item and the place each came from.

    Two seeds that follow each other on a diagonal tell the same as the first of them. Seeds are sorted by their own hash and then
    by that of the seed before them in the item, so that those which continue a diagonal are a range that is left out: a word
    that is repeated many times in the item and in the text gives one hit per diagonal, not one per pair.
    """

    def __init__(self, items: list[tuple[int | None, np.ndarray]]):
        self.items = [(i, h) for i, h in items if len(h)]
        by_mask: dict[tuple[int, ...], list[tuple[np.ndarray, int]]] = {}
        for at, (_, h) in enumerate(self.items):
            for mask in _masks_for(len(h)):
                by_mask.setdefault(mask, []).append((_seeds(h, mask), at))
        self.tables = {}
        for mask, parts in by_mask.items():
            keys = np.concatenate([s for s, _ in parts])
            own, number = np.unique(keys, return_inverse=True)
            item = np.concatenate([np.full(len(s), at, np.int32) for s, at in parts])
            place = np.concatenate([np.arange(len(s), dtype=np.int32) for s, _ in parts])
            before = np.append(-1, number[:-1])
            before[place == 0] = -1
            pair = number * (len(own) + 1) + before + 1
            order = np.argsort(pair, kind="stable")
            self.tables[mask] = (own, pair[order], item[order], place[order])
        self.vocabulary = np.unique(np.concatenate([h for _, h in self.items])) if self.items else np.zeros(0, np.uint64)

    def hits(self, hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Distinct (text, item, first word of the item in the slice) of all seeds found; bounds: of the texts' words."""
        found = []
        if not self.items:
            return np.zeros((0, 3), np.int64)
        known = np.searchsorted(self.vocabulary, hashes)
        known[known == len(self.vocabulary)] = 0
        known = self.vocabulary[known] == hashes
        for mask, (own, pair, item, place) in self.tables.items():
            n = len(hashes) - mask[-1]
            if n <= 0:
                continue
            maybe = known[:n].copy()
            for m in mask[1:]:
                maybe &= known[m : m + n]
            at = np.flatnonzero(maybe)
            if not len(at):
                continue
            text = np.searchsorted(bounds, at, "right") - 1
            inside = at + mask[-1] < bounds[text + 1]
            at, text = at[inside], text[inside]
            seeds = chain([hashes[at + m] for m in mask], mask[-1])
            number = np.minimum(np.searchsorted(own, seeds), len(own) - 1)
            there = own[number] == seeds
            at, text, number = at[there], text[there], number[there].astype(np.int64)
            if not len(at):
                continue
            follows = np.zeros(len(at), bool)
            follows[1:] = (at[1:] == at[:-1] + 1) & (text[1:] == text[:-1])
            before = np.where(follows, np.append(-1, number[:-1]), -1)
            base = number * (len(own) + 1)
            low, high = np.searchsorted(pair, base, "left"), np.searchsorted(pair, base + len(own), "right")
            # What continues the diagonal of the seed before is a range in the middle.
            skip = np.where(follows, np.searchsorted(pair, base + before + 1, "left"), high)
            resume = np.where(follows, np.searchsorted(pair, base + before + 1, "right"), high)
            for first, after in ((low, skip), (resume, high)):
                times = after - first
                which = np.repeat(np.arange(len(at)), times)
                entry = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first, times)
                found.append(np.stack([text[which], item[entry].astype(np.int64), at[which] - place[entry]], axis=1))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)

    def overlap(self, item: int, hashes: np.ndarray, first: int, low: int, high: int):
        """(first word, last word + 1, equal words, percent of the item) that the item covers in the text low..high."""
        own = self.items[item][1]
        lo, hi = max(low, first), min(high, first + len(own))
        equal = hashes[lo:hi] == own[lo - first : hi - first]
        width = min(WINDOW, len(own))
        if len(equal) < width or (len(own) < BRIEF and high - low != len(own)):
            return None
        percent = EQUAL if len(own) >= LEAST_WORDS else 100
        sums = np.append(0, np.cumsum(equal))
        good = np.flatnonzero(100 * (sums[width:] - sums[:-width]) >= percent * width)
        if not len(good):
            return None
        covered = np.zeros(len(equal) + 1, int)
        np.add.at(covered, good, 1)
        np.add.at(covered, good + width, -1)
        counted = equal & (np.cumsum(covered)[:-1] > 0)
        places = np.flatnonzero(counted)
        return lo + int(places[0]), lo + int(places[-1]) + 1, len(places), 100.0 * len(places) / len(own)


def _finder(table, text: str):
    """Appends each row's overlaps with the table's items to its column of overlaps; whole rows pass through."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds: SeedTable = pickle.loads(table.value)
        for batch in batches:
            for first, after, data, bounds in slices(batch.column(batch.schema.names.index(text))):
                part = batch.slice(first, after - first)
                found = words(data, bounds, blank=NOT_ALNUM)
                more: dict[int, list[dict]] = {}
                for row, item, at in seeds.hits(found.hashes, found.bounds):
                    low, high = int(found.bounds[row]), int(found.bounds[row + 1])
                    over = seeds.overlap(item, found.hashes, int(at), low, high)
                    if over is None:
                        continue
                    begin, end, equal, percent = over
                    points = np.append(0, np.cumsum((data[bounds[row] : bounds[row + 1]] & 0xC0) != 0x80))
                    start = int(points[found.starts[begin] - bounds[row]])
                    stop = int(points[found.ends[end - 1] - bounds[row]])
                    more.setdefault(int(row), []).append(
                        {"item_id": seeds.items[item][0], "start": start, "end": stop, "n_equal": equal, "percent": percent}
                    )
                if more:
                    before = part.column(part.num_columns - 1)
                    lists = [b + more.get(i, []) for i, b in enumerate(before.to_pylist())]
                    columns = [*part.columns[:-1], pa.array(lists, before.type)]
                    part = pa.RecordBatch.from_arrays(columns, schema=part.schema)
                yield part

    return find


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, bounds = string_bytes(batch.column(1))
        found = words(data, bounds, blank=NOT_ALNUM)
        hashes = pa.ListArray.from_arrays(pa.array(found.bounds, pa.int32()), pa.array(found.hashes.view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column(0), hashes, pa.array(np.diff(found.bounds))], names=["item_id", "hashes", "n"])


def _blocks(benchmark: DataFrame, item: str, text: str) -> tuple[int, Iterator[list[tuple[int | None, np.ndarray]]]]:
    """The number of blocks, and the items block by block, each of bounded size, read from the stored word hashes."""
    slim = benchmark.select(F.col(item).cast("long"), F.col(text).cast("string"))
    hashed = stored(slim.mapInArrow(_item_words, "item_id long, hashes array<long>, n long"), "benchmark")
    total = hashed.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    count = max(1, -(-total // BLOCK_WORDS))

    def blocks() -> Iterator[list[tuple[int | None, np.ndarray]]]:
        for block in range(count):
            part = hashed if count == 1 else hashed.filter(F.pmod(F.xxhash64("item_id", "hashes"), F.lit(count)) == block)
            rows = part.select("item_id", "hashes").collect()
            yield [(r[0], np.array(r[1], np.int64).view(np.uint64)) for r in rows]

    return count, blocks()


OWN = ("contaminated", "item_ids", "n_items", "best_percent", "overlaps")


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """All columns of ``docs`` (clashing ones are replaced) and: contaminated, item_ids (sorted), n_items, best_percent (the
    largest part of an item that is in the text), overlaps (array of item_id, start, end in code points, n_equal, percent).

    A text is contaminated if it has a verified overlap with an item. Case and ASCII punctuation do not matter. Null and empty
    texts and those shorter than an overlap are clean; so are all if the benchmark is empty. Items without a word are not
    searched; items without an id are, under a null id, and of items that share an id each is. Repeated rows are judged alike, each by
    itself. An empty table gives an empty result. Documents are not shuffled.
    """
    spark = docs.sparkSession
    base = without(docs, (*OWN, "_row"))
    empty = F.array().cast(OVERLAPS)
    count, blocks = _blocks(benchmark, item, item_text)

    def searched(rows: DataFrame, items: list[tuple[int | None, np.ndarray]]) -> DataFrame:
        sent = spark.sparkContext.broadcast(pickle.dumps(SeedTable(items)))
        return rows.mapInArrow(_finder(sent, text), rows.schema)

    if count == 1:
        df = searched(base.withColumn("overlaps", empty), next(blocks))
    else:
        # One job per block, each over numbered rows: what it finds is stored, and joined with the rows at the end.
        rows = stored(base.withColumn("_row", F.monotonically_increasing_id()), "numbered")
        found = work_folder(spark, "overlaps")
        for items in blocks:
            part = searched(rows.select("_row", text).withColumn("overlaps", empty), items)
            part.where(F.size("overlaps") > 0).select("_row", "overlaps").write.mode("append").parquet(found)
        every = spark.read.schema(f"_row long, overlaps {OVERLAPS}").parquet(found)
        every = every.groupBy("_row").agg(F.flatten(F.collect_list("overlaps")).alias("overlaps"))
        df = rows.join(every, "_row", "left").withColumn("overlaps", F.coalesce("overlaps", empty))
    ids = F.array_sort(F.array_distinct(F.transform("overlaps", lambda x: x["item_id"])))
    best = F.coalesce(F.array_max(F.transform("overlaps", lambda x: x["percent"])), F.lit(0.0))
    return df.select(
        *base.columns,
        (F.size("overlaps") > 0).alias("contaminated"),
        ids.alias("item_ids"),
        F.size(ids).cast("long").alias("n_items"),
        best.alias("best_percent"),
        F.array_sort(F.array_distinct("overlaps")).alias("overlaps"),
    )
