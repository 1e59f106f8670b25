"""Texts cut into short strings that repeat a lot (words, chunks between safe places), and what is computed once per string.

A tokenizer takes about a second per megabyte, and nearly all words of a corpus are copies. A Python worker keeps a table of the
strings it has met, of fixed size and with two places for each string, found by a 128-bit hash of the bytes; the strings of a
slice are looked up together, and only those that are not there are spelt out and computed. Long strings are never looked up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from itertools import chain
from typing import Any

import numpy as np
import pyarrow as pa

from riskflow.llm.wordhash import _BASE, PLAIN, _power, mix

#: Slots of a table, and the results it may hold before it starts anew.
SLOTS, MOST_RESULTS = 1 << 22, 1_000_000
#: Longer strings (bytes) are computed anew whenever they come.
LONG = 200
_OTHER = 0x2545F4914F6CDD1D


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.LargeStringArray:
    """The strings at bytes ``starts`` .. ``ends`` - 1 of ``data``, in the order given."""
    sizes = ends - starts
    bounds = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(sizes, out=bounds[1:])
    body = data[np.repeat(starts - bounds[:-1], sizes) + np.arange(bounds[-1])]
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(body))


def _hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    power, inverse = _power(base, len(data)), _power(pow(base, -1, 1 << 64), len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(PLAIN[data] * power, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


class Lists:
    """Lists one after the other in one array that grows."""

    def __init__(self, kind=np.int64):
        self.items, self.bounds, self.n = np.empty(1 << 12, kind), np.zeros(1 << 10, np.int64), 0

    @staticmethod
    def _room(array: np.ndarray, size: int) -> np.ndarray:
        if size <= len(array):
            return array
        more = np.empty(max(size, 2 * len(array)), array.dtype)
        more[: len(array)] = array
        return more

    def extend(self, lists: Sequence[Iterable[int]]) -> None:
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        used = int(self.bounds[self.n])
        after = used + int(sizes.sum())
        self.items, self.bounds = self._room(self.items, after), self._room(self.bounds, self.n + len(lists) + 1)
        self.items[used:after] = np.fromiter(chain.from_iterable(lists), self.items.dtype, after - used)
        self.bounds[self.n + 1 : self.n + len(lists) + 1] = used + np.cumsum(sizes)
        self.n += len(lists)

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lists ``which``, one after the other, and their bounds."""
        sizes = self.bounds[which + 1] - self.bounds[which]
        out = np.zeros(len(which) + 1, np.int64)
        np.cumsum(sizes, out=out[1:])
        return self.items[np.repeat(self.bounds[which] - out[:-1], sizes) + np.arange(out[-1])], out


class Table:
    """``compute``: results of a list of different strings, each of which depends on its string alone; ``add`` takes the results
    in, in order, and ``clear`` forgets them all."""

    def __init__(self, compute: Callable[[list[str]], Sequence[Any]], add: Callable[[Sequence[Any]], None], clear: Callable[[], None]):
        self.compute, self.add, self.clear = compute, add, clear
        self._empty()

    def _empty(self) -> None:
        self.clear()
        self.held = 0
        self.number = np.full(SLOTS, -1, np.int64)
        self.key, self.check = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.uint64)

    def numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The result's number of every string; numbers hold until the next call."""
        if self.held > MOST_RESULTS:
            self._empty()
        if len(starts) == 0:
            return np.zeros(0, np.int64)
        key, check = _hash(data, starts, ends, _BASE), _hash(data, starts, ends, _OTHER)
        slot, other = ((h & np.uint64(SLOTS - 1)).astype(np.int64) for h in (key, check))
        short = ends - starts <= LONG

        def there(at: np.ndarray, place: np.ndarray) -> np.ndarray:
            return (self.number[place] >= 0) & (self.key[place] == key[at]) & (self.check[place] == check[at]) & short[at]

        every = np.arange(len(starts))
        out = self.number[slot]
        at = np.flatnonzero(~there(every, slot))
        second = there(at, other[at])
        out[at[second]] = self.number[other[at[second]]]
        at = at[~second]
        if len(at):
            order = np.lexsort((check[at], key[at]))
            at = at[order]
            new = np.ones(len(at), bool)
            new[1:] = (key[at][1:] != key[at][:-1]) | (check[at][1:] != check[at][:-1]) | ~short[at][1:]
            first = at[new]
            self.add(self.compute(strings(data, starts[first], ends[first]).to_numpy(zero_copy_only=False).tolist()))
            fresh = self.held + np.arange(len(first))
            self.held += len(first)
            place = np.where(self.number[slot[first]] < 0, slot[first], other[first])
            # Of several new strings in one slot the last one written stays: key, check and number are written alike.
            self.number[place], self.key[place], self.check[place] = fresh, key[first], check[first]
            out[at] = fresh[np.cumsum(new) - 1]
        return out
