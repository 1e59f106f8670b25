"""Packing by powers of two: every document is split into pieces whose lengths are its length's binary digits.

A document of n tokens becomes n div 4096 pieces of 4096 and one piece per binary digit of the rest, long ones first. A piece is a
sequence by itself, so no sequence crosses documents and none is padded; sequences of equal length form a bucket, from which
batches of one shape are drawn. Sequences are numbered bucket by bucket, in an order that a hash of their content decides.

White space parts the words of the tokenizer and is dropped, so a text is encoded word by word, every different word of a slice
once per worker; the test holds this against encoding whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm import chunks, wordhash
from riskflow.llm.bytelevel import ByteLevel
from riskflow.llm.frames import extended, stored, without
from riskflow.llm.sharding import BUCKET_ROWS, MOST_BUCKETS, numbered

LONGEST = 4096
END = 2
OWN = ("start", "length", "ids", "doc_tokens")


def lengths(n: int, longest: int = LONGEST) -> list[int]:
    """Pieces of a document of ``n`` tokens: as many of the longest as fit, then the binary digits of the rest."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << i for i in reversed(range(longest.bit_length())) if rest >> i & 1]


class Encoder:
    """A tokenizer and the words it has met. A worker keeps it from task to task."""

    def __init__(self, path: str):
        self.words = ByteLevel(path, spaced=False)
        self.table = chunks.Table(self.words.ids, lambda results: self.ids.extend(results), self._clear)

    def _clear(self) -> None:
        self.ids = chunks.Lists(np.uint32)

    def encode(self, data: np.ndarray, bounds: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts, each closed by ``end``, and the texts' bounds."""
        found = wordhash.words(data, bounds, fold=False)
        which = self.table.numbers(data, found.starts, found.ends)  # may begin a new list of ids
        ids, word_bounds = self.ids.take(which)
        text_bounds = word_bounds[found.bounds]
        return np.insert(ids, text_bounds[1:], end).astype("<u4"), text_bounds + np.arange(len(text_bounds))


@lru_cache(1)
def encoder_of(path: str) -> Encoder:
    return Encoder(path)


def _splitter(text: str, path: str, longest: int, end: int):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        for batch in batches:
            column = batch.column(batch.schema.names.index(text))
            rest = batch.drop_columns([text])
            for first, after, data, bounds in wordhash.slices(column):
                ids, places = encoder.encode(data, bounds, end)
                sizes = np.diff(places)
                pieces = [lengths(int(n), longest) for n in sizes]
                n = np.fromiter(chain.from_iterable(pieces), np.int64)
                row = np.repeat(np.arange(len(sizes)), list(map(len, pieces)))
                at = np.concatenate([[0], np.cumsum(n)])
                body = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(at * 4), pa.py_buffer(ids)])
                for low in range(0, len(n), 4096):
                    some = slice(low, low + 4096)
                    kept = rest.slice(first, after - first).take(pa.array(row[some]))
                    yield pa.RecordBatch.from_arrays(
                        [
                            *kept.columns,
                            pa.array(at[:-1][some] - places[row[some]]),
                            pa.array(n[some]),
                            body.slice(low, len(n[some])).cast(pa.binary()),
                            pa.array(sizes[row[some]]),
                        ],
                        names=[*kept.schema.names, *OWN],
                    )

    return split


def decompose(docs: DataFrame, tokenizer: str, text: str = "text", longest: int = LONGEST, end: int = END) -> DataFrame:
    """One row per piece: the columns of ``docs`` but ``text`` (clashing ones are replaced), start (tokens of the document before
    it), length (a power of two up to ``longest``), ids (little-endian unsigned 32-bit), doc_tokens.

    Every document, with an empty or null text too, is closed by ``end`` and so has a piece. Null and repeated keys keep their
    rows; an empty table gives an empty result. ``tokenizer``: file of a tokenizer whose words never hold white space.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest piece must be a power of two")
    base = without(docs, OWN)
    kept = base.drop(text)
    schema = extended(kept, "start long, length long, ids binary, doc_tokens long")
    return base.mapInArrow(_splitter(text, tokenizer, longest, end), schema)


def with_sequences(pieces: DataFrame, key: str = "doc_id", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``pieces`` (key, start, length and any small columns) with sequence_id, numbered from 0 without gaps bucket by bucket from
    short to long, and offset: 0, as a piece fills its sequence. Within a bucket the order is by a hash of all columns; pieces that
    agree in all of them are interchangeable. Numbers are counted in groups of about ``bucket_rows``, not by one task."""
    slim = stored(without(pieces, ["sequence_id", "offset"]), "pieces")
    rows = slim.count()
    parts = min(MOST_BUCKETS // 64, max(1, -(-rows // bucket_rows)))
    mark = F.xxhash64(*slim.columns)
    place = F.log2("length").cast("int") * parts + F.pmod(mark, F.lit(parts))
    marked = slim.withColumns({"_mark": mark, "_bucket": place.cast("long")})
    order = ["_mark", F.col(key).asc_nulls_first(), *[c for c in slim.columns if c != key]]
    return numbered(marked, [], "_bucket", order, "sequence_id").drop("_mark").withColumn("offset", F.lit(0).cast("long"))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Sequences in one folder per length, so that a reader of one shape opens one folder. Files take rows as they come."""
    pieces.write.partitionBy("length").parquet(path)
