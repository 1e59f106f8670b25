"""Variable-capacity best-fit packing.

Texts become pieces of at most the largest permitted length; pieces go into sequences (bins) of several permitted lengths. Pieces
are taken from long to short. Each goes into the open bin it fills best; if none has room, a bin is opened, and at the end every
bin is cut down to the cheapest length that holds its contents. Which size to open is decided for all sizes together: the
packing is computed for the size of least cost per token and for every smallest size to open, and the cheapest total wins.

What best fit does depends on lengths only, so it is computed on the histogram of lengths: all pieces of one length are placed in
one step on all bins of equal room. Histogram, plan and work are bounded by the largest permitted length, whatever the number of
rows. The rows then find their place by their rank within their length: ranks are counted in buckets (no length is numbered by
one task), and the plan, of bounded size, is broadcast.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.frames import stored, whole_text
from riskflow.llm.sharding import numbered

CAPACITIES = (2048, 4096, 8192, 16384)
#: Cost of a sequence of n tokens: n * (1 + n / ATTENTION) + PER_SEQUENCE.
ATTENTION, PER_SEQUENCE = 65_536, 64
#: Pieces in a bucket of equal length, and the most buckets.
BUCKET_ROWS = 4096
MOST_BUCKETS = 65_536
#: The histogram is collected; its bound is the largest capacity, which may not exceed this.
LARGEST_CAPACITY = 1 << 20

RUN = "n long, low long, high long, bin long, per_bin long, offset long, capacity long, used long"


def cost(capacity: int) -> float:
    return capacity * (1 + capacity / ATTENTION) + PER_SEQUENCE


@dataclass
class Range:
    """Bins first .. after - 1, all alike: opened size and tokens in use."""

    first: int
    after: int
    size: int
    used: int


@dataclass
class Run:
    """Pieces of length n and rank low .. high - 1, ``per_bin`` to a bin from ``bin`` on, the first at ``offset``."""

    n: int
    low: int
    high: int
    bin: int
    per_bin: int
    offset: int


class Plan:
    """Best fit, longest first, over a histogram of lengths."""

    def __init__(self, histogram: dict[int, int], capacities: Iterable[int], smallest: int | None):
        """``smallest``: open the smallest size of at least this; None: the one of least cost per token."""
        self.capacities, self.smallest = sorted(capacities), smallest
        self.rooms: list[int] = []
        self.open: dict[int, list[Range]] = {}
        self.done: list[Range] = []
        self.runs: list[Run] = []
        self.bins = 0
        for n in sorted(histogram, reverse=True):
            self._place(n, histogram[n])
        self.done += [r for ranges in self.open.values() for r in ranges]
        self.done.sort(key=lambda r: r.first)

    def _opened(self, n: int) -> int:
        fitting = [c for c in self.capacities if c >= n]
        if self.smallest is None:
            return min(fitting, key=lambda c: (cost(c) / c, -c))
        return next((c for c in fitting if c >= self.smallest), fitting[-1])

    def _keep(self, r: Range) -> None:
        room = r.size - r.used
        if not room:
            self.done.append(r)
            return
        if room not in self.open:
            bisect.insort(self.rooms, room)
            self.open[room] = []
        self.open[room].append(r)

    def _fill(self, r: Range, n: int, low: int, count: int) -> int:
        """Fill the bins of ``r`` one after the other; returns how many pieces went in."""
        per = (r.size - r.used) // n
        full = min(r.after - r.first, count // per)
        placed, at = full * per, r.first + full
        if full:
            self.runs.append(Run(n, low, low + placed, r.first, per, r.used))
            self._keep(Range(r.first, at, r.size, r.used + per * n))
        rest = count - placed
        if rest and at < r.after:
            self.runs.append(Run(n, low + placed, low + count, at, rest, r.used))
            self._keep(Range(at, at + 1, r.size, r.used + rest * n))
            placed, at = count, at + 1
        if at < r.after:
            self._keep(Range(at, r.after, r.size, r.used))
        return placed

    def _place(self, n: int, count: int) -> None:
        low = 0
        while low < count:
            i = bisect.bisect_left(self.rooms, n)
            if i < len(self.rooms):
                room = self.rooms[i]
                r = self.open[room].pop()
                if not self.open[room]:
                    del self.open[room], self.rooms[i]
            else:
                size = self._opened(n)
                needed = -(-(count - low) // (size // n))
                r = Range(self.bins, self.bins + needed, size, 0)
                self.bins += needed
            low += self._fill(r, n, low, count - low)

    def downsized(self, r: Range) -> int:
        return min((c for c in self.capacities if c >= r.used), key=cost)

    def total(self) -> float:
        return sum((r.after - r.first) * cost(self.downsized(r)) for r in self.done)

    def rows(self) -> list[tuple]:
        """The runs, cut where the bins' final contents differ."""
        starts = [r.first for r in self.done]
        out = []
        for run in self.runs:
            bins_after = run.bin + -(-(run.high - run.low) // run.per_bin)
            i = bisect.bisect_right(starts, run.bin) - 1
            while i < len(self.done) and self.done[i].first < bins_after:
                r = self.done[i]
                first, after = max(run.bin, r.first), min(bins_after, r.after)
                low = run.low + (first - run.bin) * run.per_bin
                high = min(run.high, run.low + (after - run.bin) * run.per_bin)
                out.append((run.n, low, high, first, run.per_bin, run.offset, self.downsized(r), r.used))
                i += 1
        return out


def best_plan(histogram: dict[int, int], capacities: Iterable[int] = CAPACITIES) -> Plan:
    plans = [Plan(histogram, capacities, s) for s in (None, *sorted(capacities))]
    return min(plans, key=lambda p: p.total())


def byte_tokens(text: str = "text") -> Column:
    """One token per UTF-8 byte and one for the end of the text."""
    return F.octet_length(whole_text(text)).cast("long") + 1


def pack(docs: DataFrame, key: str = "doc_id", length: Column | None = None, capacities: Iterable[int] = CAPACITIES) -> DataFrame:
    """One row per piece: key, piece, start, n_tokens, bin_id, offset, capacity, used.

    ``length`` counts a row's tokens (default ``byte_tokens``). A text longer than the largest capacity is cut into pieces of that
    size and a rest; nothing is dropped. Rows of length null or below 1 have no tokens and no piece. Null keys and repeated
    rows are packed like any other. Pieces of equal length are interchangeable, ties go by a hash of the key, then the key. An
    empty table gives an empty result. Other columns are not read.
    """
    capacities = sorted(set(capacities))
    if not capacities or capacities[0] < 1 or capacities[-1] > LARGEST_CAPACITY:
        raise ValueError(f"capacities must lie in 1 .. {LARGEST_CAPACITY}")
    spark, most = docs.sparkSession, capacities[-1]
    sized = docs.select(F.col(key).alias("_key"), (byte_tokens() if length is None else length).cast("long").alias("_length"))
    sized = sized.filter("_length > 0")
    each = sized.select("_key", "_length", F.explode(F.expr(f"sequence(0L, (_length - 1) div {most})")).alias("piece"))
    start = F.col("piece") * most
    pieces = stored(
        each.select("_key", "piece", start.alias("start"), F.least(F.lit(most), F.col("_length") - start).cast("long").alias("n")),
        "pieces",
    )
    histogram = {r["n"]: r["count"] for r in pieces.groupBy("n").count().collect()}
    buckets = min(MOST_BUCKETS, max(1, -(-max(histogram.values(), default=0) // BUCKET_ROWS)))
    mark = F.xxhash64("_key", "piece")
    ranked = numbered(
        pieces.withColumns({"_mark": mark, "_bucket": F.pmod(mark, F.lit(buckets))}),
        ["n"],
        "_bucket",
        ["_mark", F.col("_key").asc_nulls_first(), "piece"],
        "_rank",
    )
    plan = best_plan(histogram, capacities)
    runs = F.broadcast(spark.createDataFrame(plan.rows(), RUN)).withColumnRenamed("n", "_n")
    inside = (F.col("n") == F.col("_n")) & (F.col("_rank") >= F.col("low")) & (F.col("_rank") < F.col("high"))
    place = F.col("_rank") - F.col("low")
    return ranked.join(runs, inside).select(
        F.col("_key").alias(key),
        "piece",
        "start",
        F.col("n").alias("n_tokens"),
        (F.col("bin") + F.floor(place / F.col("per_bin"))).cast("long").alias("bin_id"),
        (F.col("offset") + (place % F.col("per_bin")) * F.col("n")).cast("long").alias("offset"),
        "capacity",
        "used",
    )


def assemble(placed: DataFrame, docs: DataFrame, key: str = "doc_id", text: str = "text", name: str | None = None, end: bytes = b"\x00") -> DataFrame:
    """The sequences of a packing by ``byte_tokens``: bin_id, capacity, used, doc_ids (in order), content (binary).

    ``end`` is the byte that closes a text. ``key`` must be unique and not null in ``docs``: other rows cannot be told apart;
    ``name`` (default: the key) is what doc_ids lists. A sequence is at most as long as its capacity, so one group is of bounded
    size.
    """
    body = F.concat(whole_text(text).cast("binary"), F.lit(end))
    rows = placed.join(docs.select(F.col(key), F.col(name or key).alias("_name"), body.alias("_body")), key)
    cut = F.substring(F.col("_body"), (F.col("start") + 1).cast("int"), F.col("n_tokens").cast("int"))
    parts = rows.select("bin_id", "capacity", "used", F.struct("offset", F.col("_name").alias("id"), cut.alias("part")).alias("one"))
    grouped = parts.groupBy("bin_id", "capacity", "used").agg(F.array_sort(F.collect_list("one")).alias("all"))
    content = F.array_join(F.transform("all", lambda x: F.hex(x["part"])), "")
    return grouped.select(
        "bin_id", "capacity", "used", F.transform("all", lambda x: x["id"]).alias("doc_ids"), F.unhex(content).alias("content")
    )
