"""Removal of repeated byte strings by partial suffix sorting.

A string of ``length`` bytes is repeated if it also starts earlier: in a document with a smaller key, or earlier in the same one.

Suffixes are sorted only where it can matter. The anchor of a string is the ANCHOR-byte substring in it with the smallest hash,
the leftmost of several: a function of the string alone, so equal strings have equal anchors at equal offsets. One anchor serves
a run of neighbouring strings, its stretch, and one row per stretch is dealt by the anchor's content. Stretches that are equal
throughout are classes; all but the earliest of a class are repeated as a whole, and only that one can matter to others. Copies
within a slice of a task meet there and travel as one row.

What remains are the earliest stretches of different classes at equal anchors: they agree around the anchor and part somewhere
left or right of it. For these the bytes are fetched, the suffixes at the anchors and the reversed prefixes before them are put
in order by deep-shallow sorting, and the lengths shared by neighbours tell, for every offset, which strings are equal.

Sorting takes groups of up to ``most`` stretches per anchor. The strings of larger groups are counted one by one instead (by
128-bit hash, the earliest of each found by a combined minimum), so that no group has to fit a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.deepsort import deep_shallow
from riskflow.llm.frames import stored, whole_text
from riskflow.llm.sharding import BUCKET_ROWS, MOST_BUCKETS, numbered
from riskflow.llm.wordhash import PLAIN, _BASE, _INVERSE, _power, mix, slices

LENGTH = 100
ANCHOR = 32
MOST = 4096
SLICE = 1 << 21
#: Rows sorted together: many groups at once, so that small ones cost little.
CHUNK = 16_384
#: Places within a piece of text take so many bits of a packed (hash, place).
PLACE_BITS = 24

STRETCH = "anchor long, stretch long, row long, place long, others array<struct<row:bigint,place:bigint>>"
CONTEXT = "anchor long, row long, place long, bytes binary"
SPAN = "row long, start long, end long"


def pack_place(first: np.ndarray, count: np.ndarray, ahead: np.ndarray) -> np.ndarray:
    """First string of a stretch, number of strings (1 .. 127), anchor's distance from the first."""
    return (first.astype(np.int64) << 14) | ((count - 1).astype(np.int64) << 7) | ahead.astype(np.int64)


def unpack_place(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 14, ((place >> 7) & 127) + 1, place & 127


def stretches(data: np.ndarray, bounds: np.ndarray, length: int, anchor: int):
    """(text, first string, strings, anchor's distance, anchor's hash, stretch's hash) of all texts in ``data``."""
    n, width = len(data), length - anchor + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(PLAIN[data] * _power(_BASE, n), out=sums[1:])
    inverse = _power(_INVERSE, n)
    hashes = mix((sums[anchor:] - sums[:-anchor]) * inverse[: n - anchor + 1])
    bits = np.uint64(PLACE_BITS)
    least = ((hashes >> bits) << bits) | np.arange(len(hashes), dtype=np.uint64)
    done = 1
    while done < width:
        step = min(done, width - done)
        least = np.minimum(least[:-step], least[step:])
        done += step
    at = (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    strings = len(at)
    inside = np.ones(strings, bool)
    for edge in bounds[1:-1]:
        inside[max(0, edge - length + 1) : edge] = False
    starts = np.flatnonzero(inside)
    if not len(starts):
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    served = at[starts]
    new = np.flatnonzero(np.append(True, served[1:] != served[:-1]))
    first, last = starts[new], starts[np.append(new[1:], len(starts)) - 1]
    anchors = served[new]
    count, ahead = last - first + 1, anchors - first
    whole = (sums[last + length] - sums[first]) * inverse[first]
    whole = mix(whole + (count * 128 + ahead).astype(np.uint64))
    text = np.searchsorted(bounds, first, "right") - 1
    return text, first - bounds[text], count, ahead, hashes[anchors], whole


def _pieces(column: pa.Array, length: int):
    """(first row, bytes, bounds, place of the bytes in a text that is cut); cut texts overlap so that no string is lost."""
    most = (1 << PLACE_BITS) - length
    for first, after, data, bounds in slices(column, SLICE):
        if after - first > 1 or len(data) <= most:
            yield first, data, bounds, 0
            continue
        for at in range(0, max(1, len(data) - length + 1), most):
            part = data[at : at + most + length - 1]
            yield first, part, np.array([0, len(part)]), at


def _finder(length: int, anchor: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows_of = batch.column(0).to_numpy(zero_copy_only=False)
            for first, data, bounds, shift in _pieces(batch.column(1), length):
                text, begin, count, ahead, anchors, whole = stretches(data, bounds, length, anchor)
                if not len(text):
                    continue
                rows, places = rows_of[first + text], pack_place(begin + shift, count, ahead)
                both = mix(anchors + whole * np.uint64(3))
                order = np.lexsort((places, rows, both))
                new = np.flatnonzero(np.append(True, both[order][1:] != both[order][:-1]))
                lead = order[new]
                rest = np.ones(len(order), bool)
                rest[new] = False
                sizes = np.diff(np.append(new, len(order))) - 1
                others = pa.StructArray.from_arrays(
                    [pa.array(rows[order][rest]), pa.array(places[order][rest])], names=["row", "place"]
                )
                offsets = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchors[lead].view(np.int64)),
                        pa.array(whole[lead].view(np.int64)),
                        pa.array(rows[lead]),
                        pa.array(places[lead]),
                        pa.ListArray.from_arrays(offsets, others),
                    ],
                    names=["anchor", "stretch", "row", "place", "others"],
                )

    return find


def _fetcher(length: int):
    """The bytes of stretches: rows (row, text, wanted)."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(2)
            for first, after, data, bounds in slices(batch.column(1), SLICE):
                part = wanted.slice(first, after - first)
                flat = part.flatten()
                if not len(flat):
                    continue
                sizes = np.diff(part.offsets.to_numpy())
                anchors, places = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                rows = np.repeat(batch.column(0).to_numpy(zero_copy_only=False)[first:after], sizes)
                begin, count, _ = unpack_place(places)
                begin = begin + np.repeat(bounds[:-1], sizes)
                end = begin + count - 1 + length
                raw = data.tobytes()
                context = [raw[b:e] for b, e in zip(begin.tolist(), end.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchors), pa.array(rows), pa.array(places), pa.array(context, pa.binary())],
                    names=["anchor", "row", "place", "bytes"],
                )

    return fetch


def _spans(rows: np.ndarray, starts: np.ndarray, length: int) -> pa.RecordBatch:
    """Strings as spans, neighbouring starts of one row together."""
    order = np.lexsort((starts, rows))
    rows, starts = rows[order], starts[order]
    new = np.append(True, (rows[1:] != rows[:-1]) | (starts[1:] > starts[:-1] + 1))
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(rows)) - 1
    return pa.RecordBatch.from_arrays(
        [pa.array(rows[at]), pa.array(starts[at]), pa.array(starts[last] + length)], names=["row", "start", "end"]
    )


def repeated_strings(groups, rows, places, contexts: list[bytes], length: int, anchor: int):
    """(row, start) of the strings of these stretches that start earlier in another stretch of their group."""
    begin, count, ahead = unpack_place(places)
    width = length - anchor
    ahead_list = ahead.tolist()
    right_width, left_width = -(-length // 8) * 8, -(-max(width, 1) // 8) * 8
    right = b"".join(c[a : a + length].ljust(right_width, b"\0") for c, a in zip(contexts, ahead_list))
    left = b"".join(c[:a][::-1].ljust(left_width, b"\0") for c, a in zip(contexts, ahead_list))
    n = len(rows)
    keys_right = np.frombuffer(right, np.uint8).reshape(n, right_width)
    keys_left = np.frombuffer(left, np.uint8).reshape(n, left_width)
    # All suffixes of a group begin with the anchor: the shallow part starts behind it.
    skip = anchor // 8 * 8
    order_r, shared_r = deep_shallow(groups, keys_right[:, skip:])
    shared_r = np.where(shared_r >= 0, shared_r + skip, -1)
    order_l, shared_l = deep_shallow(groups, keys_left)
    earlier = np.empty(n, np.int64)
    earlier[np.lexsort((begin + ahead, rows))] = np.arange(n)
    found_rows, found_starts = [], []
    class_r, class_l = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(width + 1):
        # Strings that begin d bytes before the anchor.
        valid = np.flatnonzero((d <= ahead) & (d >= ahead - count + 1))
        if len(valid) < 2:
            continue
        class_r[order_r] = np.cumsum(shared_r < length - d)
        class_l[order_l] = np.cumsum(shared_l < d)
        key = class_r[valid] * (n + 1) + class_l[valid]
        order = np.lexsort((earlier[valid], key))
        key = key[order]
        again = valid[order[1:][key[1:] == key[:-1]]]
        if len(again):
            found_rows.append(rows[again])
            found_starts.append(begin[again] + ahead[again] - d)
    if not found_rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_rows), np.concatenate(found_starts)


def _sorter(length: int, anchor: int):
    """Rows (CONTEXT) ordered by anchor; whole groups are sorted together."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def work(table: pa.Table):
            groups, rows, places = (table.column(i).to_numpy() for i in range(3))
            rows, starts = repeated_strings(groups, rows, places, table.column(3).to_pylist(), length, anchor)
            if len(rows):
                yield _spans(rows, starts, length)

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                held.append(batch.slice(at, CHUNK))
                at += CHUNK
                table = pa.Table.from_batches(held)
                if table.num_rows < CHUNK:
                    continue
                anchors = table.column(0).to_numpy()
                cut = int(np.searchsorted(anchors, anchors[-1], "left"))
                if cut:
                    yield from work(table.slice(0, cut))
                held = table.slice(cut).to_batches()
        if held:
            yield from work(pa.Table.from_batches(held))

    return sort


def _exploder(length: int):
    """Every string of large groups by itself: 128-bit hash, row, start."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, place, raw in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                count = ((place >> 7) & 127) + 1
                both = [hashlib.blake2b(raw[i : i + length], digest_size=16).digest() for i in range(count)]
                parts = np.frombuffer(b"".join(both), np.int64).reshape(count, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(parts[:, 0]), pa.array(parts[:, 1]), pa.array([row] * count), pa.array(np.arange(count) + (place >> 14))],
                    names=["high", "low", "row", "start"],
                )

    return explode


def _finisher(keep_bytes: bool):
    """Rows (key, text, spans): lengths, merged spans, hash of the rest."""

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(2)
            for first, after, data, bounds in slices(batch.column(1), SLICE):
                part = spans.slice(first, after - first)
                out: list[list] = [[], [], [], [], []]
                raw = data.tobytes()
                for i, found in enumerate(part.to_pylist()):
                    text = raw[bounds[i] : bounds[i + 1]]
                    merged: list[list[int]] = []
                    for s in sorted((x["start"], x["end"]) for x in found or ()):
                        if merged and s[0] <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], s[1])
                        else:
                            merged.append(list(s))
                    at, left = 0, []
                    for s, e in merged:
                        left.append(text[at:s])
                        at = e
                    left.append(text[at:])
                    rest = b"".join(left)
                    values = (len(text), len(text) - len(rest), [{"start": s, "end": e} for s, e in merged],
                              hashlib.sha256(rest).hexdigest(), rest if keep_bytes else None)
                    for column, value in zip(out, values):
                        column.append(value)
                types = (pa.int64(), pa.int64(), spans.type, pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, after - first), *(pa.array(c, t) for c, t in zip(out, types))],
                    names=["_key", "n_bytes", "n_removed", "spans", "kept_sha256", "kept_bytes"],
                )

    return finish


def _with_rows(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, bool]:
    """(_key, _row, _text); _row orders documents. Whether rows repeat.

    Usually the key is the row. If keys are null or repeat, the distinct (key, content) pairs are numbered: null keys last,
    rows of one key in the order of their content's hash, equal rows alike.
    """
    slim = docs.select(F.col(key).cast("long").alias("_key"), whole_text(text).alias("_text"))
    n, keys, distinct = slim.agg(F.count(F.lit(1)), F.count("_key"), F.countDistinct("_key")).first()
    if n == keys == distinct:
        return slim.select("_key", F.col("_key").alias("_row"), "_text"), False
    marked = slim.withColumn("_mark", F.sha2(F.col("_text").cast("binary"), 256))
    pairs = stored(marked.select("_key", "_mark").distinct(), "documents")
    low, high = pairs.agg(F.coalesce(F.min("_key"), F.lit(0)), F.coalesce(F.max("_key"), F.lit(0))).first()
    buckets = min(MOST_BUCKETS, max(1, -(-n // BUCKET_ROWS)))
    bucket = F.floor((F.col("_key").cast("double") - low) / max(1, high - low + 1) * buckets).cast("long")
    # Null keys are spread by content, behind all others.
    spread = F.floor(F.conv(F.substring("_mark", 1, 8), 16, 10).cast("long") * buckets / 2**32).cast("long")
    bucket = F.coalesce(bucket, buckets + spread)
    rows = numbered(pairs.withColumn("_bucket", bucket), [], "_bucket", [F.col("_key").asc_nulls_last(), "_mark"], "_row")
    same = F.col("a._key").eqNullSafe(F.col("b._key")) & (F.col("a._mark") == F.col("b._mark"))
    joined = marked.alias("a").join(rows.alias("b"), same)
    return joined.select(F.col("a._key").alias("_key"), F.col("b._row").alias("_row"), F.col("a._text").alias("_text")), True


def remove_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    anchor: int = ANCHOR,
    most: int = MOST,
    keep_bytes: bool = False,
) -> DataFrame:
    """One row per input row: key, n_bytes, n_removed, n_spans, spans (start, end in bytes; maximal runs), kept_sha256, kept_bytes
    (the rest, which may cut a character; null unless ``keep_bytes``).

    Texts are UTF-8 bytes; strings are judged on the input, and overlapping ones count. Null and empty texts and those shorter
    than ``length`` lose nothing. Rows with equal keys and texts are one document and share its result; rows with one key and
    different texts count as different documents, ordered by their content's hash; rows without a key come last. An empty table
    gives an empty result. Other columns are not read.
    """
    if not 8 <= anchor <= length <= anchor + 126:
        raise ValueError("length may exceed anchor by at most 126")
    keyed, repeated = _with_rows(docs, key, text)
    single = keyed.select("_row", "_text")
    single = single.dropDuplicates(["_row"]) if repeated else single
    found = single.filter(F.octet_length("_text") >= length).mapInArrow(_finder(length, anchor), STRETCH)
    # One exchange and one sort serve both windows.
    in_order = Window.partitionBy("anchor").orderBy("stretch", "row", "place")
    of_anchor = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    of_class = Window.partitionBy("anchor", "stretch").orderBy("row", "place")
    classed = found.withColumn("several", F.first("stretch").over(of_anchor) != F.last("stretch").over(of_anchor))
    classed = classed.withColumn("earliest", F.row_number().over(of_class) == 1)
    flagged = stored(classed.filter("several or not earliest or size(others) > 0").drop("stretch"), "stretches")

    own = F.when(~F.col("earliest"), F.array(F.struct("row", "place")))
    none = F.array().cast("array<struct<row:bigint,place:bigint>>")
    gone = flagged.select(F.inline(F.concat(F.coalesce(own, none), "others")))
    begin, count = F.shiftright("place", 14), F.shiftright("place", 7).bitwiseAND(F.lit(127))
    spans = gone.select("row", begin.alias("start"), (begin + count + length).alias("end"))

    # The same exchange of the texts serves this join and the last one.
    texts = single.select(F.col("_row").alias("row"), "_text")
    firsts = flagged.filter("several and earliest")
    large = stored(firsts.groupBy("anchor").count().filter(F.col("count") > most).select("anchor"), "large-groups")
    wanted = firsts.groupBy("row").agg(F.collect_list(F.struct("anchor", "place")).alias("wanted"))
    context = texts.join(wanted.hint("shuffle_hash"), "row").select("row", "_text", "wanted").mapInArrow(_fetcher(length), CONTEXT)
    if large.isEmpty():
        small = context
    else:
        context = stored(context, "contexts")
        small = context.join(large, "anchor", "left_anti")
        strings = context.join(large, "anchor", "left_semi").select("anchor", "row", "place", "bytes")
        strings = stored(strings.mapInArrow(_exploder(length), "high long, low long, row long, start long"), "strings")
        least = strings.groupBy("high", "low").agg(F.min(F.struct("row", "start")).alias("least"), F.count(F.lit(1)).alias("n"))
        again = strings.join(least.filter("n > 1"), ["high", "low"]).filter("struct(row, start) > least")
        spans = spans.unionByName(again.select("row", "start", (F.col("start") + length).alias("end")))
    ordered = small.select("anchor", "row", "place", "bytes").repartition("anchor").sortWithinPartitions("anchor")
    spans = spans.unionByName(ordered.mapInArrow(_sorter(length, anchor), SPAN))

    by_row = spans.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    base = keyed.select(F.col("_row").alias("row"), "_text", "_key") if repeated else texts
    joined = base.join(by_row.hint("shuffle_hash"), "row", "left")
    id_ = F.col("_key") if repeated else F.col("row")
    fields = "_key long, n_bytes long, n_removed long, spans array<struct<start:bigint,end:bigint>>, kept_sha256 string, kept_bytes binary"
    done = joined.select(id_.alias("_key"), "_text", "spans").mapInArrow(_finisher(keep_bytes), fields)
    return done.select(
        F.col("_key").alias(key), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "spans", "kept_sha256", "kept_bytes"
    )
