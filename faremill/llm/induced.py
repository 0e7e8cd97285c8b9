"""Induced sorting of suffixes with common-prefix values, on disk.

A text is an array of symbols that ends with a unique 0, its smallest one. A suffix is L if it is larger than the next one, else S; an
S suffix behind an L one is a seed. Seeds are sorted by their substrings (up to the next seed), named, and, where names repeat, by
sorting the shorter text of names in the same way. From sorted seeds, all L suffixes follow in one scan from the smallest suffix on, and
all S suffixes in one scan from the largest on: whatever is met puts the suffix before it into the queue of its first symbol.

All queues of a scan are one file: the slots of a symbol lie together, are filled in order and are read in order, so it is a
priority queue whose entries are tuples of place and common prefix with the entry before. A scan takes as many entries at once as
come before the first slot that they themselves fill. Common prefixes are carried along: two neighbours in a queue share one symbol more than
the least value between the entries that put them there. Values stop at ``cap``; so ``cap`` + 1 places tell the least value of
any stretch that ends where the scan stands.

A text of names of at most ``DIRECT`` symbols is sorted in memory, by ranks of twice the length each time.

Texts, types, queues, names and bucket tables above ``IN_MEMORY`` bytes are mapped files without a name in the task's own temporary folder: they are
gone with the task, lost with an executor, and made anew by the task that replaces it. Of any other array, at most ``BLOCK`` entries are
in memory. A text of its 0 alone has one suffix.
"""

from __future__ import annotations

import tempfile

import numpy as np

BLOCK = 1 << 15
IN_MEMORY = 1 << 24
DIRECT = 1 << 21
FEW = 8


def room(n: int, kind: type, fill: int | None = None) -> np.ndarray:
    """An array of n entries, in a mapped file if it is large; zeros unless ``fill`` is given."""
    size = n * np.dtype(kind).itemsize
    if size <= IN_MEMORY:
        made = np.zeros(n, kind)
    else:
        with tempfile.TemporaryFile() as file:
            file.truncate(size)
            made = np.memmap(file, kind, "r+", shape=(n,))
    if fill is not None:
        made[:] = fill
    return made


def _blocks(n: int):
    return ((begin, min(n, begin + BLOCK)) for begin in range(0, n, BLOCK))


def _types(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each suffix is S, and how many equal symbols it begins with."""
    n = len(text)
    small, run = room(n, np.bool_), room(n, np.int32)
    small[n - 1], run[n - 1], stop = True, 1, n - 1
    while stop:
        begin = max(0, stop - BLOCK)
        part, at = np.asarray(text[begin : stop + 1]), np.arange(stop - begin)
        differ = np.append(np.flatnonzero(part[1:] != part[:-1]), stop - begin)
        end = differ[np.searchsorted(differ, at)]
        known = end < stop - begin
        inside = np.where(known, end, 0)
        small[begin:stop] = np.where(known, part[inside + 1] > part[inside], small[stop])
        run[begin:stop] = np.where(known, end - at + 1, stop - begin - at + run[stop])
        stop = begin
    return small, run


class _Buckets:
    """Where the slots of each symbol begin, turn from L to S, and end."""

    def __init__(self, text: np.ndarray, small: np.ndarray, symbols: int):
        large, count = room(symbols, np.int64), room(symbols, np.int64)
        for begin, stop in _blocks(len(text)):
            seen, n = np.unique(text[begin:stop], return_counts=True)
            count[seen] += n
            seen, n = np.unique(text[begin:stop][~small[begin:stop]], return_counts=True)
            large[seen] += n
        self.ends, self.begins, self.borders = (room(symbols, np.int64) for _ in range(3))
        np.cumsum(count, out=self.ends)
        self.begins[:] = self.ends
        self.begins -= count
        self.borders[:] = self.begins
        self.borders += large


def _dealt(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The order by symbol (equal ones as given), the number of each among equal ones, where a symbol begins, and how many it has."""
    order = symbols.argsort(kind="stable")
    ordered = symbols[order]
    new = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    first = new.nonzero()[0]
    counts = np.empty_like(first)
    counts[:-1], counts[-1:] = first[1:] - first[:-1], len(ordered) - first[-1:]
    return order, np.arange(len(ordered)) - first.repeat(counts), first, counts


def _least(values: np.ndarray, begin: np.ndarray, end: np.ndarray, cap: int) -> np.ndarray:
    """The least value of each stretch [begin, end); ``cap`` for an empty one."""
    length = end - begin
    out = np.full(len(begin), cap, np.int64)
    some = (length > 0).nonzero()[0]
    if not len(some):
        return out
    begin, end, level = begin[some], end[some], np.frexp(length[some])[1] - 1
    row, found, highest = values, np.empty(len(some), np.int64), int(level.max())
    for depth in range(highest + 1):
        here = (level == depth).nonzero()[0]
        if len(here):
            found[here] = np.minimum(row[begin[here]], row[end[here] - (1 << depth)])
        if depth < highest:
            row = np.minimum(row[: -(1 << depth)], row[1 << depth :])
    out[some] = found
    return out


def _seeds_in_place(text, buckets, seeds, prefixes, cap, queue, common) -> np.ndarray:
    """Put the seeds at the ends of their buckets, in the order given; the first slot of each symbol's seeds."""
    count = room(len(buckets.ends), np.int64)
    for begin, stop in _blocks(len(seeds)):
        seen, n = np.unique(text[seeds[begin:stop]], return_counts=True)
        count[seen] += n
    heads = room(len(count), np.int64)
    heads[:] = buckets.ends
    heads -= count
    firsts = heads[count > 0].copy()
    for begin, stop in _blocks(len(seeds)):
        symbols = text[seeds[begin:stop]]
        order, nth, first, counts = _dealt(symbols)
        slots = heads[symbols[order]] + nth
        queue[slots] = seeds[begin:stop][order]
        if common is not None:
            common[slots] = np.minimum(prefixes[begin:stop][order], cap)
        heads[symbols[order][first]] += counts
    return np.sort(firsts)


def _scan_up(text, small, run, buckets, firsts, cap, queue, common) -> None:
    """All L suffixes, from the smallest suffix on."""
    n, begin, width = len(text), 0, BLOCK
    heads, last = room(len(buckets.begins), np.int64), room(len(buckets.begins), np.int64)
    heads[:] = buckets.begins
    latest = np.full(cap + 1, -1, np.int64)  # the last slot of at most each value
    while begin < n:
        stop = min(n, begin + width)
        entry = np.asarray(queue[begin:stop])
        at = (entry > 0).nonzero()[0]
        place = entry[at] - 1
        large = ~small[place]
        at, place = at[large], place[large]
        symbol = text[place]
        least = int(heads[symbol].min()) if len(at) else stop
        if least < stop:
            some = at < least - begin
            at, place, symbol, stop = at[some], place[some], symbol[some], least
            width = max(64, min(BLOCK, 2 * (stop - begin)))
        else:
            width = min(BLOCK, 2 * width)
        if common is not None:
            for slot in firsts[np.searchsorted(firsts, begin) : np.searchsorted(firsts, stop)].tolist():
                of = int(text[queue[slot]])
                border = int(buckets.borders[of])
                common[slot] = min(int(run[queue[slot]]), int(run[queue[border - 1]]), cap) if border > buckets.begins[of] else 0
            values = np.asarray(common[begin:stop])
        if len(at):
            order, nth, first, counts = _dealt(symbol)
            at, place, symbol = at[order], place[order], symbol[order]
            slots = heads[symbol] + nth
            queue[slots] = place
            if common is not None:
                before = np.empty_like(at)
                before[1:] = at[:-1] + 1
                before[first] = 0
                least_between = _least(values, before, at + 1, cap)
                carried = np.searchsorted(latest, last[symbol[first]], side="right")
                least_between[first] = np.minimum(least_between[first], carried)
                shared = np.minimum(least_between + 1, cap)
                shared[first[heads[symbol[first]] == buckets.begins[symbol[first]]]] = 0
                common[slots] = shared
                last[symbol[first]] = begin + at[first + counts - 1]
            heads[symbol[first]] += counts
        if common is not None:
            newest = np.full(cap + 1, -1, np.int64)
            newest[values] = np.arange(begin, stop)
            latest = np.maximum(latest, np.maximum.accumulate(newest))
        begin = stop


def _scan_down(text, small, run, buckets, cap, queue, common) -> None:
    """All S suffixes, from the largest suffix on."""
    n, width = len(text), BLOCK
    stop = n
    tails, last = room(len(buckets.ends), np.int64), room(len(buckets.ends), np.int64)
    tails[:] = buckets.ends
    tails[0] = 0  # the last suffix stands in its slot
    latest = np.full(cap + 1, n, np.int64)  # the first slot of at most each value
    while stop:
        begin = max(0, stop - width)
        entry = np.asarray(queue[begin:stop])
        at = (entry > 0).nonzero()[0][::-1]
        place = entry[at] - 1
        chosen = small[place]
        at, place = at[chosen], place[chosen]
        symbol = text[place]
        most = int(tails[symbol].max()) if len(at) else begin
        if most > begin:
            some = at >= most - begin
            at, place, symbol, begin = at[some] - (most - begin), place[some], symbol[some], most
            width = max(64, min(BLOCK, 2 * (stop - begin)))
        else:
            width = min(BLOCK, 2 * width)
        if len(at):
            order, nth, first, counts = _dealt(symbol)
            at, place, symbol = at[order], place[order], symbol[order]
            slots = tails[symbol] - 1 - nth
            queue[slots] = place
            if common is not None:
                values = np.asarray(common[begin:stop])
                after = np.empty_like(at)
                after[1:] = at[:-1] + 1
                after[first] = stop - begin
                between = _least(values, at + 1, after, cap)
                carried = np.searchsorted(-latest, -last[symbol[first]], side="left")
                between[first] = np.minimum(between[first], carried)
                known = np.ones(len(at), bool)
                known[first] = tails[symbol[first]] < buckets.ends[symbol[first]]
                common[slots[known] + 1] = np.minimum(between[known] + 1, cap)
                border = buckets.borders[symbol]
                lowest = np.flatnonzero(slots == border)
                beside = border[lowest]
                some = beside > buckets.begins[symbol[lowest]]
                shared = np.minimum(run[place[lowest]], run[queue[np.maximum(beside - 1, 0)]])
                common[beside] = np.where(some, np.minimum(shared, cap), 0)
                last[symbol[first]] = begin + at[first + counts - 1]
            tails[symbol[first]] -= counts
        if common is not None:
            values = np.asarray(common[begin:stop])
            newest = np.full(cap + 1, n, np.int64)
            newest[values[::-1]] = np.arange(begin, stop)[::-1]
            latest = np.minimum(latest, np.minimum.accumulate(newest))
        stop = begin


def _induced(text, small, run, buckets, seeds, prefixes, cap) -> tuple[np.ndarray, np.ndarray | None]:
    """All suffixes in the order that the order of the seeds implies, with common prefixes if those of the seeds are given."""
    n = len(text)
    queue = room(n, np.int32, -1)
    common = None if prefixes is None else room(n, np.int16, cap)
    firsts = _seeds_in_place(text, buckets, seeds, prefixes, cap, queue, common)
    _scan_up(text, small, run, buckets, firsts, cap, queue, common)
    for begin, stop in _blocks(n):
        entry = np.asarray(queue[begin:stop])
        gone = np.flatnonzero((entry >= 0) & small[entry])
        queue[begin + gone] = -1
        if common is not None:
            common[begin + gone] = cap
    queue[0] = n - 1
    if common is not None:
        common[0] = 0
    _scan_down(text, small, run, buckets, cap, queue, common)
    return queue, common


def _seeds(small: np.ndarray) -> np.ndarray:
    """Places of the seeds."""
    found = room(sum(int(np.count_nonzero(small[max(b, 1) : s] & ~small[max(b, 1) - 1 : s - 1])) for b, s in _blocks(len(small))), np.int32)
    done = 0
    for begin, stop in _blocks(len(small)):
        begin = max(begin, 1)
        here = begin + np.flatnonzero(small[begin:stop] & ~small[begin - 1 : stop - 1])
        found[done : done + len(here)] = here
        done += len(here)
    return found


def _equal(text: np.ndarray, left: np.ndarray, right: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the substrings at both places are equal over the length."""
    out = np.ones(len(left), bool)
    open_, step = np.arange(len(left)), 0
    while len(open_) > FEW:
        same = text[left[open_] + step] == text[right[open_] + step]
        out[open_[~same]] = False
        step += 1
        open_ = open_[same]
        open_ = open_[length[open_] > step]
    for i in open_.tolist():
        at = step
        while out[i] and at < length[i]:
            size = min(BLOCK, int(length[i]) - at)
            out[i] = np.array_equal(text[left[i] + at : left[i] + at + size], text[right[i] + at : right[i] + at + size])
            at += size
    return out


def _direct(text: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """What ``sorted_suffixes`` returns, for a text that fits in memory many times over."""
    n = len(text)
    open_, rank, ranks = np.arange(n), np.zeros(n, np.int64), []
    key, step = np.asarray(text, np.int64), 0
    while len(open_):
        order = key.argsort()
        open_, key = open_[order], key[order]
        whole = rank[open_]
        begins, parts = np.ones(len(open_), bool), np.ones(len(open_), bool)
        np.not_equal(whole[1:], whole[:-1], out=begins[1:])
        np.not_equal(key[1:], key[:-1], out=parts[1:])
        at = np.arange(len(open_))
        inside = np.maximum.accumulate(np.where(parts, at, 0)) - np.maximum.accumulate(np.where(begins, at, 0))
        rank = rank.copy()
        rank[open_] = whole + inside
        ranks.append(rank)
        alone = parts.copy()
        alone[:-1] &= parts[1:]
        open_, step = open_[~alone], max(1, 2 * step)
        key = rank[open_] * n + rank[open_ + step]
    ordered = np.empty(n, np.int32)
    ordered[rank] = np.arange(n, dtype=np.int32)
    left, right, length = ordered[:-1].copy(), ordered[1:].copy(), np.zeros(n, np.int64)
    for depth in range(len(ranks) - 1, -1, -1):
        more = np.where(ranks[depth][left] == ranks[depth][right], 1 << depth, 0)
        left, right = left + more, right + more
        length[1:] += more
    return ordered, np.minimum(length, cap).astype(np.int16)


def sorted_suffixes(text: np.ndarray, symbols: int, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all suffixes in order, and how many symbols each shares with the one before, up to ``cap``."""
    n = len(text)
    if n == 1:
        return room(1, np.int32), room(1, np.int16)
    small, run = _types(text)
    buckets = _Buckets(text, small, symbols)
    seeds = _seeds(small)
    m = len(seeds)
    queue, _ = _induced(text, small, run, buckets, seeds, None, cap)
    # seeds in the order of their substrings, by number
    ordered, done = room(m, np.int32), 0
    for begin, stop in _blocks(n):
        entry = np.asarray(queue[begin:stop])
        entry = entry[entry > 0]
        entry = entry[small[entry] & ~small[entry - 1]]
        ordered[done : done + len(entry)] = np.searchsorted(seeds, entry)
        done += len(entry)
    del queue
    names, name = room(m, np.int32), 0
    for begin, stop in _blocks(m - 1):
        a, b = np.asarray(ordered[begin:stop]), np.asarray(ordered[begin + 1 : stop + 1])
        size_a, size_b = (seeds[np.minimum(x + 1, m - 1)] - seeds[x] + 1 for x in (a, b))
        like = (size_a == size_b) & (a < m - 1) & (b < m - 1)
        like[like] = _equal(text, seeds[a[like]], seeds[b[like]], size_a[like])
        numbers = name + np.cumsum(~like)
        names[b] = numbers
        name = int(numbers[-1])
    shared = room(m, np.int16)
    if name + 1 < m:
        del ordered
        ordered, shared = _direct(names, cap) if m <= DIRECT else sorted_suffixes(names, name + 1, cap)
    by_order, prefixes = room(m, np.int32), room(m, np.int16)
    for begin, stop in _blocks(m):
        here = np.asarray(ordered[begin:stop])
        by_order[begin:stop] = seeds[here]
        before = np.asarray(ordered[max(begin, 1) - 1 : stop - 1])
        b, equal = (here, shared[begin:stop]) if begin else (here[1:], shared[1:stop])
        # equal names reach to the seed behind them; from there on symbols are compared
        x, y = seeds[before + equal], seeds[b + equal]
        length = np.minimum(y - seeds[b], cap).astype(np.int64)
        open_, step = np.flatnonzero(length < cap), 0
        while len(open_):
            open_ = open_[text[x[open_] + step] == text[y[open_] + step]]
            length[open_] += 1
            step += 1
            open_ = open_[length[open_] < cap]
        prefixes[stop - len(b) : stop] = length
    return _induced(text, small, run, buckets, by_order, prefixes, cap)
