"""Runs of periodic words: longest-common-extension queries over a difference cover drive a harmonic grid.

A run is a stretch of consecutive words with smallest period q and at least ``max(LEAST_LENGTH, LEAST_POWER * q)``
words that no neighbouring word extends keeping period q. Every such run holds ``LEAST_POWER`` consecutive multiples of
q, whose words are equal, as are those at one distance after each of them; the grid of all multiples of all periods (n/1 + n/2 + ... places) is sieved by that, and at the places left
the words that agree after and before a place and the one q words on give the run's ends.

How many words agree after two places is found without sorting all suffixes. Of every ``COVER`` words only those at a difference cover are
sampled, so that from any two places the same few words lead to two samples; those few are compared one by one. Sampled suffixes are
sorted by their first words and then by doubling of ranks, neighbours' common prefixes are kept, and a sparse table of
range minima answers for two samples. Words before a place are the same on the reversed text. A document without a place left by the sieve sorts nothing.

Words are maximal runs of bytes other than white space (0x20, 0x09-0x0D). Null and empty texts have no words and no runs.
Texts are read whole; memory is a few dozen bytes a word of one document, as the grid is made in slices of bounded size. Documents
are independent: repeated rows, ties and empty tables need no rule, and other columns are not read.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

LEAST_LENGTH = 6
LEAST_POWER = 4
COVER = 13
#: Differences of these cover all remainders by 13.
MARKS = (0, 1, 3, 9)
GRID_WORDS = 2048
GRID_SLICE = 1 << 20
RUN_TYPE = "struct<runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string,n_words:bigint>"


def _shifts() -> np.ndarray:
    """Words to go from places of two remainders until both are marked."""
    marked = np.isin(np.arange(2 * COVER) % COVER, MARKS)
    table = np.zeros((COVER, COVER), np.int64)
    for a, b in itertools.product(range(COVER), repeat=2):
        table[a, b] = next(s for s in range(COVER) if marked[a + s] and marked[b + s])
    return table


SHIFTS = _shifts()


class Extensions:
    """How many words agree after two places of one text."""

    def __init__(self, ids: np.ndarray):
        self.n = n = len(ids)
        self.ids = np.concatenate([ids, np.full(COVER + 1, -1, ids.dtype)])
        sampled = np.flatnonzero(np.isin(np.arange(n) % COVER, MARKS))
        self.nth = np.full(n + COVER + 1, -1, np.int64)
        self.nth[sampled] = np.arange(len(sampled))
        rank = self._first_ranks(sampled)
        levels, width = [rank], COVER
        while len(rank) and rank.max() + 1 < len(rank):
            after = sampled + width
            follow = np.where(after < n, rank[self.nth[np.minimum(after, n)]], -1)
            rank = np.unique(rank * (len(rank) + 1) + follow + 1, return_inverse=True)[1]
            levels.append(rank)
            width *= 2
        self.rank = rank
        order = np.argsort(rank)
        self._minima(self._neighbours(sampled[order], levels))

    def _first_ranks(self, sampled: np.ndarray) -> np.ndarray:
        """Ranks of the sampled suffixes by their first COVER words, as many words to a number as fit."""
        values = self.ids.astype(np.int64) + 1
        bits = max(1, int(values.max(initial=1)).bit_length())
        fit = 62 // bits
        keys = []
        for begin in range(0, COVER, fit):
            key = np.zeros(len(sampled), np.int64)
            for k in range(begin, min(COVER, begin + fit)):
                key = key << bits | values[sampled + k]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(sampled), np.int64)
        for key in keys:
            new[1:] |= np.diff(key[order]) != 0
        rank = np.empty(len(sampled), np.int64)
        rank[order] = np.cumsum(new)
        return rank

    def _neighbours(self, places: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common words of each sampled suffix and the next one in order, by the ranks from wide to narrow."""
        a, b = places[:-1].copy(), places[1:].copy()
        common = np.zeros(len(a), np.int64)
        for level in range(len(levels) - 1, -1, -1):
            width, rank = COVER << level, levels[level]
            inside = np.flatnonzero((a < self.n) & (b < self.n))
            same = inside[rank[self.nth[a[inside]]] == rank[self.nth[b[inside]]]]
            # equal ranks of distinct suffixes are never at the end of the text: a shorter one ends first
            common[same] += width
            a[same] += width
            b[same] += width
        open_ = np.flatnonzero((a < self.n) & (b < self.n))
        for k in range(COVER):
            open_ = open_[self.ids[a[open_] + k] == self.ids[b[open_] + k]]
            common[open_] += 1
        return common

    def _minima(self, common: np.ndarray) -> None:
        self.table = [common]
        width = 1
        while 2 * width <= len(common):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def _sampled(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common words after two different sampled places."""
        low, high = np.sort(np.stack([self.rank[self.nth[i]], self.rank[self.nth[j]]]), axis=0)
        level = np.frexp((high - low).astype(float))[1] - 1
        out = np.empty(len(i), np.int64)
        for k in np.unique(level):
            at = level == k
            row = self.table[k]
            out[at] = np.minimum(row[low[at]], row[high[at] - (1 << int(k))])
        return out

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common words after places i and j, where i < j <= n."""
        shift = SHIFTS[i % COVER, j % COVER]
        out = np.zeros(len(i), np.int64)
        open_ = np.arange(len(i))
        for k in range(COVER):
            open_ = open_[shift[open_] > k]
            open_ = open_[self.ids[i[open_] + k] == self.ids[j[open_] + k]]
            out[open_] += 1
        reached = np.flatnonzero((out == shift) & (j + shift < self.n))
        if len(reached):
            out[reached] += self._sampled(i[reached] + shift[reached], j[reached] + shift[reached])
        return out


def _grid(first: int, last: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places kq and periods q of [first, last) for which the next multiples of q are places of the text too."""
    periods = np.arange(first, last)
    counts = np.maximum(-(-n // periods) - (LEAST_POWER - 1), 0)
    q = np.repeat(periods, counts)
    k = np.arange(len(q)) - np.repeat(np.cumsum(counts) - counts, counts)
    return k * q, q


def _short_grid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The grid of GRID_WORDS words in the order of the last multiple, so that a shorter text has the first part of it."""
    at, q = _grid(1, GRID_WORDS // LEAST_POWER + 1, GRID_WORDS)
    reach = at + (LEAST_POWER - 1) * q
    order = np.argsort(reach, kind="stable")
    at, q = at[order].astype(np.int32), q[order].astype(np.int32)
    return at, q, np.searchsorted(reach[order], np.arange(GRID_WORDS + 1))


_SHORT = _short_grid()


def _places(ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grid places and periods whose LEAST_POWER multiples hold equal words, and no period longer than n / LEAST_POWER."""
    n = len(ids)

    def sieved(at: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for k in range(1, LEAST_POWER):
            equal = ids[at + (k - 1) * q] == ids[at + k * q]
            at, q = at[equal], q[equal]
        # the first multiple in a run has all periods up to the last of them inside of it
        for half in (False, True):
            inner = q // 2 if half else np.minimum(1, q - 1)
            one, two = at + inner, at + inner + q
            equal = (ids[one] == ids[two]) & (ids[two] == ids[two + q])
            at, q = at[equal], q[equal]
        return at.astype(np.int64), q.astype(np.int64)

    if n <= GRID_WORDS:
        at, q, stops = _SHORT
        yield sieved(at[: stops[n]], q[: stops[n]])
        return
    first = 1
    while first <= n // LEAST_POWER:
        last = first + 1
        while last <= n // LEAST_POWER and (last - first) * (n // first) < GRID_SLICE:
            last *= 2
        last = min(last, n // LEAST_POWER + 1)
        at, q = _grid(first, last, n)
        for begin in range(0, len(at), GRID_SLICE):
            yield sieved(at[begin : begin + GRID_SLICE], q[begin : begin + GRID_SLICE])
        first = last


def find_runs(ids: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs of a sequence of word numbers (not negative), by start, then period."""
    ids = np.ascontiguousarray(ids, np.int32)
    n, none = len(ids), np.empty((0, 3), np.int64)
    if n < LEAST_LENGTH:
        return none
    after = before = None
    found = [none]
    for i, q in _places(ids):
        if not len(i):
            continue
        if after is None:
            after, before = Extensions(ids), Extensions(ids[::-1])
        stop = i + q + after.common(i, i + q)
        start = i - before.common(n - i - q, n - i)
        length = stop - start
        long = length >= np.maximum(LEAST_LENGTH, LEAST_POWER * q)
        if long.any():
            found.append(np.unique(np.stack([start[long], length[long], q[long]], axis=1), axis=0))
    if sum(map(len, found)) == 0:
        return none
    rows = np.unique(np.concatenate(found), axis=0)
    # a multiple of the smallest period has the same ends, as runs are at least four periods long
    first = np.ones(len(rows), bool)
    first[1:] = (np.diff(rows[:, :2], axis=0) != 0).any(axis=1)
    rows = rows[first]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """True for the words that no run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:n]) == 0


def split_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def numbered(words: list[bytes]) -> np.ndarray:
    numbers: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
    return np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))


def runs(text: Column) -> Column:
    """A struct of a text's runs, of the text without repeated periods (its words joined by one space), and its number of words."""

    @F.arrow_udf(RUN_TYPE)
    def periodic(texts: pa.Array) -> pa.Array:
        offsets, rows, collapsed, counts = [0], [], [], []
        for one in texts:
            words = split_words(one.as_py())
            found = find_runs(numbered(words))
            if len(found):
                kept = itertools.compress(words, kept_words(len(words), found).tolist())
            else:
                kept = words
            rows.append(found)
            offsets.append(offsets[-1] + len(found))
            collapsed.append(b" ".join(kept))
            counts.append(len(words))
        flat = np.concatenate(rows) if rows else np.empty((0, 3), np.int64)
        fields = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), fields)
        texts_left = pa.array(collapsed, pa.binary()).cast(pa.string())
        return pa.StructArray.from_arrays([lists, texts_left, pa.array(counts, pa.int64())], ["runs", "collapsed", "n_words"])

    return periodic(text)
