"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

The byte places where tokens end are kept in a dictionary from place to index, one per tokenizer. Places that are keys of both
dictionaries, in order, cut both lists of ids into groups; every token of a group is linked with every token of the other side.
A link's count is how many documents of the corpus hold the pair linked.

Both tokenizers treat a single space between two plain characters as the beginning of a word, so a token of either ends there
whatever surrounds it. So do both between a letter and a punctuation mark that no piece of B holds side by side: A parts them, and
B only ever joins what a piece holds. Texts are cut at these places and a worker aligns each different chunk once; what a text has is the sum
over its chunks. The test holds this against encoding whole texts.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate, count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.llm import chunks, wordhash
from riskflow.llm.bytelevel import ByteLevel, byte_alphabet
from riskflow.llm.frames import stored, without

#: The counts of at most so many linked pairs are sent to all tasks (16 bytes each); more are joined.
MOST_PAIRS = 4_000_000

OWN = {"n_a": T.LongType(), "n_b": T.LongType(), "n_groups": T.LongType(), "n_links": T.LongType(), "groups": T.StringType()}
SUMS = ("n_best", "count_sum")
#: Bytes that may follow a space that begins a chunk, and come before it: printable ASCII but the space, and first bytes of
#: UTF-8 characters that are never white space. Before it any byte but ASCII white space does.
_NEXT = np.zeros(256, bool)
_NEXT[0x21:0x7F] = True
_NEXT[0xC3:0xE1] = True
_NEXT[0xE4:0xF5] = True
_BEFORE = np.ones(256, bool)
_BEFORE[[0x20, *range(0x09, 0x0E)]] = False


@dataclass(frozen=True)
class Tokenizers:
    """Files of the byte-level tokenizer (A) and of the piece tokenizer (B)."""

    a: str
    b: str


class Aligned(NamedTuple):
    """One chunk, or one text. ``groups``: a1,a2|b1;a3|b2 and so on; ``links``: pairs as a << 32 | b with their number of links."""

    n_a: int
    n_b: int
    n_groups: int
    groups: str
    links: dict[int, int]


class Side:
    """A tokenizer's ids: their bytes, how many those are, and the id as it is written."""

    def __init__(self, pieces: list[bytes]):
        self.bytes, self.size, self.shown = pieces, [len(p) for p in pieces], [str(i) for i in range(len(pieces))]

    def ends(self, ids: list[int]) -> dict[int, int]:
        """Byte place behind each token: how many tokens end up to it."""
        return dict(zip(accumulate(map(self.size.__getitem__, ids)), count(1)))

    def spelt(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes[i] for i in ids])


def align(body: bytes, ids_a: list[int], ids_b: list[int], side_a: Side, side_b: Side) -> Aligned | None:
    """None if the tokens of either side are not the bytes of ``body``."""
    if side_a.spelt(ids_a) != body or side_b.spelt(ids_b) != body:
        return None
    ends_a, ends_b = side_a.ends(ids_a), side_b.ends(ids_b)
    shown_a, shown_b, groups, links = side_a.shown, side_b.shown, [], {}
    from_a = from_b = 0
    for end in sorted(ends_a.keys() & ends_b.keys()):
        to_a, to_b = ends_a[end], ends_b[end]
        if to_a == from_a + 1 and to_b == from_b + 1:
            x, y = ids_a[from_a], ids_b[from_b]
            groups.append(shown_a[x] + "|" + shown_b[y])
            pair = x << 32 | y
            links[pair] = links.get(pair, 0) + 1
        else:
            a, b = ids_a[from_a:to_a], ids_b[from_b:to_b]
            groups.append(",".join([shown_a[x] for x in a]) + "|" + ",".join([shown_b[y] for y in b]))
            for x in a:
                x <<= 32
                for y in b:
                    links[x | y] = links.get(x | y, 0) + 1
        from_a, from_b = to_a, to_b
    return Aligned(len(ids_a), len(ids_b), len(groups), ";".join(groups), links)


class Aligner:
    """Both tokenizers, and the chunks they have met. A worker keeps it from task to task."""

    def __init__(self, files: Tokenizers):
        import sentencepiece

        self.a = ByteLevel(files.a, spaced=True, plain_specials=True)
        tokenizer, alphabet = self.a.tokenizer, byte_alphabet()
        special = tokenizer.get_added_tokens_decoder()
        entries = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
        self.side_a = Side([b"" if i in special else bytes(alphabet[c] for c in e) for i, e in enumerate(entries)])
        self.b = sentencepiece.SentencePieceProcessor(model_file=files.b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.side_b = Side(
            [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        )
        # A piece that holds a word's beginning further on could cross two chunks.
        self.whole = any(re.search("[^▁]▁", p) for p in pieces)
        self.parted = self._parted(pieces)
        self.before = "a"  # stands before a chunk that begins with a mark, as a token of its own
        self.first = self.b.encode(self.before)
        self.table = chunks.Table(self._aligned, self._add, self._clear)

    @staticmethod
    def _parted(pieces: list[str]) -> np.ndarray:
        """By ASCII letter and punctuation mark (the apostrophe aside, which A keeps with some letters): whether no piece holds one
        behind the other."""
        held = {one[i : i + 2] for one in pieces for i in range(len(one) - 1)}
        table = np.zeros((256, 256), bool)
        for letter in string.ascii_letters:
            for mark in string.punctuation.replace("'", ""):
                table[ord(letter), ord(mark)] = letter + mark not in held
        return table

    def _clear(self) -> None:
        self.groups: list[str] = []
        self.numbers, self.pairs, self.times = chunks.Lists(), chunks.Lists(), chunks.Lists()

    def _aligned(self, texts: list[str]) -> list[Aligned | None]:
        """``texts`` begin with the space that both tokenizers see before a word, or with a mark behind a letter."""
        found = self.b.encode([t[1:] if t[0] == " " else self.before + t for t in texts], num_threads=1)
        ids_b = [b if t[0] == " " else b[len(self.first) :] for t, b in zip(texts, found)]
        return [align(t.encode(), a, b, self.side_a, self.side_b) for t, a, b in zip(texts, self.a.ids(texts), ids_b)]

    def _add(self, found: list[Aligned | None]) -> None:
        none = Aligned(0, 0, 0, "", {})
        some = [f or none for f in found]
        self.groups += [f.groups for f in some]
        self.numbers.extend([(f.n_a, f.n_b, f.n_groups, sum(f.links.values())) for f in some])
        self.pairs.extend([f.links for f in some])
        self.times.extend([f.links.values() for f in some])

    def cuts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where chunks begin: every text that is not empty, and within a text single spaces between plain characters and marks
        behind letters."""
        begins = np.zeros(len(data) + 1, bool)
        begins[bounds[:-1]] = True
        if not self.whole and len(data) > 2:
            begins[1:-2] |= (data[1:-1] == 0x20) & _NEXT[data[2:]] & _BEFORE[data[:-2]]
            begins[1:-1] |= self.parted[data[:-1], data[1:]]
        return np.flatnonzero(begins[:-1])

    def slices(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, row after the last, chunks' numbers, bounds of the texts in them). A text with a chunk that cannot be
        aligned has no chunks."""
        for first, after, data, bounds in wordhash.slices(column):
            data, bounds = spaced(data, bounds)
            starts = self.cuts(data, bounds)
            which = self.table.numbers(data, starts, np.append(starts[1:], len(data)) if len(starts) else starts)
            per_text = np.searchsorted(starts, bounds)
            failing = np.flatnonzero(self.numbers.take(which)[0].reshape(-1, 4)[:, 2] == 0)
            if len(failing):
                failed = np.zeros(len(bounds) - 1, bool)
                failed[np.searchsorted(per_text, failing, "right") - 1] = True
                sizes = np.diff(per_text)
                which = which[~np.repeat(failed, sizes)]
                per_text = np.concatenate([[0], np.cumsum(np.where(failed, 0, sizes))])
            yield first, after, which, per_text

    def per_text(self, which: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, times): every different pair of every text with its number of links."""
        each, at = self.pairs.take(which)
        many, _ = self.times.take(which)
        text = np.repeat(np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)), np.diff(at))
        order = np.lexsort((each, text))
        text, each, many = text[order], each[order], many[order]
        new = np.ones(len(each), bool)
        new[1:] = (text[1:] != text[:-1]) | (each[1:] != each[:-1])
        heads = np.flatnonzero(new)
        return text[heads], each[heads], np.add.reduceat(many, heads) if len(heads) else many


@lru_cache(1)
def aligner_of(files: Tokenizers) -> Aligner:
    return Aligner(files)


def spaced(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with a space before each; empty ones stay empty."""
    filled = np.diff(bounds) > 0
    places = bounds[:-1][filled]
    added = np.concatenate([[0], np.cumsum(filled)])
    return np.insert(data, places, 0x20), bounds + added


def _counter(text: str, files: Tokenizers):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(files)
        for batch in batches:
            for _, _, which, bounds in aligner.slices(batch.column(batch.schema.names.index(text))):
                pair, n = np.unique(aligner.per_text(which, bounds)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "n"])

    return counted


def _lister(row: str, text: str, files: Tokenizers):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(files)
        for batch in batches:
            numbers = batch.column(batch.schema.names.index(row)).to_numpy()
            for first, _, which, bounds in aligner.slices(batch.column(batch.schema.names.index(text))):
                texts, pairs, times = aligner.per_text(which, bounds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers[first + texts]), pa.array(pairs), pa.array(times)], names=[row, "pair", "times"]
                )

    return each


def _totals(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of runs of ``values``."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[bounds])


def _writer(text: str, files: Tokenizers, counts):
    """Own columns per row; with ``counts`` (pairs, numbers, whether highest of their A id, as broadcast) the sums as well."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, sums = aligner_of(files), counts.value if counts is not None else None
        for batch in batches:
            rest = batch.drop_columns([text])
            for first, after, which, bounds in aligner.slices(batch.column(batch.schema.names.index(text))):
                numbers = aligner.numbers.take(which)[0].reshape(-1, 4)
                shown = [aligner.groups[w] for w in which]
                groups = [";".join(shown[a:b]) for a, b in zip(bounds, bounds[1:])]
                columns = [*(pa.array(_totals(numbers[:, i], bounds)) for i in range(4)), pa.array(groups, pa.string())]
                if sums is not None:
                    different, back = np.unique(which, return_inverse=True)
                    pairs, at = aligner.pairs.take(different)
                    times, _ = aligner.times.take(different)
                    found = np.searchsorted(sums[0], pairs)
                    for values in (sums[2], sums[1]):
                        columns.append(pa.array(_totals(_totals(values[found] * times, at)[back], bounds)))
                part = rest.slice(first, after - first)
                names = [*part.schema.names, *OWN, *(SUMS if sums is not None else ())]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=names)

    return write


def link_counts(docs: DataFrame, files: Tokenizers, text: str = "text") -> DataFrame:
    """(pair, n, is_best): pairs of ids as a << 32 | b, in how many documents they are linked, and whether no pair of the same A id
    is in more. Pairs are made distinct and counted within slices before they are shuffled."""
    counted = docs.select(text).mapInArrow(_counter(text, files), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = stored(counted, "link-counts")
    best = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n").alias("most"))
    rated = counts.withColumn("a", F.shiftright("pair", 32)).join(best, "a")
    return stored(rated.select("pair", "n", (F.col("n") == F.col("most")).alias("is_best")), "links")


def align_documents(docs: DataFrame, files: Tokenizers, text: str = "text", most_pairs: int = MOST_PAIRS) -> DataFrame:
    """The columns of ``docs`` but ``text`` (clashing ones are replaced), n_a, n_b, n_groups, n_links, groups, n_best, count_sum.

    A null or empty text, and one whose tokens of either side are not its bytes, has zeros and empty groups. A repeated row is a
    document of its own, in the counts too; keys are not read. An empty table gives an empty result. Counts of up to
    ``most_pairs`` pairs are sent to the tasks, which then sum them chunk by chunk; beyond that a row's pairs are joined with
    the counts and summed.
    """
    spark = docs.sparkSession
    base = without(docs, [*OWN, *SUMS, "_row", "_sums"])
    counts = link_counts(base, files, text)
    if counts.count() <= most_pairs:
        table = counts.orderBy("pair").toPandas()
        sums = (table["pair"].to_numpy(np.int64), table["n"].to_numpy(np.int64), table["is_best"].to_numpy(np.int64))
        if not len(sums[0]):
            sums = tuple(np.zeros(1, np.int64) for _ in sums)
        sent = spark.sparkContext.broadcast(sums)
        schema = T.StructType(base.drop(text).schema.fields + [T.StructField(c, t) for c, t in OWN.items()])
        for c in SUMS:
            schema = schema.add(c, T.LongType())
        return base.mapInArrow(_writer(text, files, sent), schema)
    rows = stored(base.withColumn("_row", F.monotonically_increasing_id()), "aligned-rows")
    each = rows.select("_row", text).mapInArrow(_lister("_row", text, files), "_row long, pair long, times long")
    summed = each.join(counts, "pair").groupBy("_row").agg(
        F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")
    )
    schema = T.StructType(rows.drop(text).schema.fields + [T.StructField(c, t) for c, t in OWN.items()])
    own = rows.mapInArrow(_writer(text, files, None), schema)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    joined = own.join(summed, "_row", "left")
    return joined.select(*[c for c in own.columns if c != "_row"], *[zero(c) for c in SUMS])
