"""Suffix arrays with common prefixes, by induced sorting with queues that go to disk.

The suffixes that start a rise after a fall are sorted first; from them the
falling ones follow in one pass upwards through the symbols and the rising ones
in one pass downwards. Each pass takes tuples from a priority queue by symbol
and pushes those of their predecessors; equal symbols leave in the order in
which they came.

A tuple is a position and the length of the prefix that its suffix shares with
the one before it in the queue. Two predecessors of one symbol share one symbol
more than the least that was shared anywhere between the suffixes they come
from, so the lengths are carried through both passes; only the starts of rises,
and the two suffixes that meet where falls end and climbs begin, are compared
in the text. Lengths stop at a cap of 255 at most.

The names of the sorted rises form a shorter string, which is sorted the same
way, or by doubling ranks once it is no longer than what four queues may hold.
A queue holds so many tuples in memory; the others go to files of its own below
a folder (of any filesystem that Arrow opens) that are gone when the pass ends.
The text, and the sorted positions that come out, are arrays in memory.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
from pyarrow import fs

IN_MEMORY = 1 << 20
_SCAN = 1 << 16
_QUEUES = 4
_CAP_BITS = 8
MOST_SHARED = (1 << _CAP_BITS) - 1


def _tuples(at: np.ndarray, shared: np.ndarray) -> np.ndarray:
    return at.astype(np.int64) << _CAP_BITS | shared


def _at(tuples: np.ndarray) -> np.ndarray:
    return tuples >> _CAP_BITS


def _shared(tuples: np.ndarray) -> np.ndarray:
    return (tuples & MOST_SHARED).astype(np.int16)


class SymbolQueue:
    """First in, first out for each symbol; the caller takes symbols by priority."""

    def __init__(self, in_memory: int = IN_MEMORY, folder: str | None = None):
        self.parts: dict[int, list[np.ndarray]] = {}
        self.spilled: dict[int, list[tuple[str, int, int]]] = {}
        self.held, self.in_memory, self.spills = 0, in_memory, 0
        self.folder, self.files, self.local = folder, None, None

    def __enter__(self) -> SymbolQueue:
        return self

    def __exit__(self, *_) -> None:
        if self.local:
            self.local.cleanup()
        elif self.files:
            self.files.delete_dir(self.path)

    def push(self, symbols: np.ndarray, tuples: np.ndarray) -> None:
        """Tuples with their symbols, which are sorted."""
        if not len(tuples):
            return
        cuts = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
        firsts = symbols[np.r_[0, cuts]].tolist()
        for symbol, part in zip(firsts, np.split(tuples, cuts), strict=True):
            self.parts.setdefault(symbol, []).append(part)
        self.held += len(tuples)
        if self.held > self.in_memory:
            self._spill()

    def _open(self) -> None:
        if self.folder:
            self.files, path = fs.FileSystem.from_uri(self.folder)
            self.path = f"{path}/{uuid.uuid4().hex}"
            self.files.create_dir(self.path)
        else:
            self.local = tempfile.TemporaryDirectory(prefix="suffixes-")
            self.files, self.path = fs.LocalFileSystem(), self.local.name

    def _spill(self) -> None:
        """All that is held, as one file with the symbols one after the other."""
        if not self.files:
            self._open()
        path, place = f"{self.path}/{self.spills}", 0
        self.spills += 1
        with self.files.open_output_stream(path) as f:
            for symbol, parts in self.parts.items():
                count = sum(map(len, parts))
                for part in parts:
                    f.write(part.tobytes())
                self.spilled.setdefault(symbol, []).append((path, place, count))
                place += count * 8
        self.parts, self.held = {}, 0

    def take(self, symbol: int) -> Iterator[np.ndarray]:
        """What is queued for `symbol`, including what comes while this runs."""
        step = max(1, self.in_memory)
        while symbol in self.spilled or symbol in self.parts:
            runs = self.spilled.pop(symbol, [])
            parts = self.parts.pop(symbol, [])
            self.held -= sum(map(len, parts))
            for path, place, count in runs:
                with self.files.open_input_file(path) as f:
                    for lo in range(0, count, step):
                        raw = f.read_at(min(step, count - lo) * 8, place + lo * 8)
                        yield np.frombuffer(raw, dtype=np.int64)
            if parts:
                yield np.concatenate(parts)


class _Carried:
    """What induced suffixes share with the one induced before for the same symbol."""

    def __init__(self, top: int, cap: int):
        self.cap = cap
        # The least shared among those scanned since; -1 where none was induced yet.
        self.least = np.full(top + 1, -1, dtype=np.int16)

    def of(self, shared: np.ndarray, which: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """For `which` of the scanned suffixes, in order of their predecessors' `symbols`."""
        first = np.ones(len(which), dtype=bool)
        first[1:] = symbols[1:] != symbols[:-1]
        lo = np.where(first, 0, np.r_[0, which[:-1] + 1])
        level = np.frexp((which - lo + 1).astype(np.float64))[1] - 1
        # Least values of 1, 2, 4, ... neighbours; two of them cover a stretch.
        mins = [shared]
        for i in range(int(level.max(initial=0))):
            mins.append(np.minimum(mins[-1][: -(1 << i)], mins[-1][1 << i :]))
        found = np.empty(len(which), dtype=np.int16)
        for i, row in enumerate(mins):
            mine = np.flatnonzero(level == i)
            a, b = row[lo[mine]], row[which[mine] - (1 << i) + 1]
            found[mine] = np.minimum(a, b)
        found[first] = np.minimum(found[first], self.least[symbols[first]])

        later = np.full(len(shared) + 1, self.cap, dtype=np.int16)
        later[:-1] = np.minimum.accumulate(shared[::-1])[::-1]
        np.minimum(self.least, later[0], out=self.least)
        final = np.append(first[1:], True)[: len(which)]
        self.least[symbols[final]] = later[which[final] + 1]
        return np.minimum(found + 1, self.cap)


def rising(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next; the last one, a sentinel, counts as such."""
    change = np.sign(np.diff(text.astype(np.int64)))
    place = np.where(change != 0, np.arange(len(change)), len(change))
    following = np.minimum.accumulate(place[::-1])[::-1]
    return np.r_[change[following] > 0, True]


def _run(text: np.ndarray, at: int, cap: int) -> int:
    """How often the symbol at `at` occurs in a row, `cap` at most."""
    other = np.flatnonzero(text[at : at + cap] != text[at])
    return int(other[0]) if len(other) else cap


def _induce(
    text: np.ndarray,
    rise: np.ndarray,
    starts: np.ndarray,
    top: int,
    cap: int,
    in_memory: int,
    folder: str | None,
) -> list[np.ndarray]:
    """All suffixes in order, as parts of tuples, induced from the tuples of rises' starts.

    Symbols above `top` occur once each, in rising order, and are followed by a
    smaller one. `starts` is sorted by symbol; the last position holds the only 0.
    """
    single = np.flatnonzero(text > top)
    symbols = np.unique(text[text <= top]).tolist()
    first = text[_at(starts)]
    low, high = (np.searchsorted(first, symbols, side=s).tolist() for s in ("left", "right"))
    falls: dict[int, list[np.ndarray]] = {s: [] for s in symbols}
    climbs: dict[int, list[np.ndarray]] = {s: [] for s in symbols}

    def scan(tuples: np.ndarray, kind: bool, queue: SymbolQueue, carried: _Carried) -> None:
        """Queues the predecessors of a kind, whose symbols are not single."""
        for lo in range(0, len(tuples), _SCAN):
            part = tuples[lo : lo + _SCAN]
            before = _at(part) - 1
            which = np.flatnonzero((before >= 0) & (rise[before] == kind) & (text[before] <= top))
            symbol = text[before[which]]
            order = np.argsort(symbol, kind="stable")
            which, symbol = which[order], symbol[order]
            shared = carried.of(_shared(part), which, symbol) if cap else 0
            queue.push(symbol, _tuples(before[which], shared))

    def seam(symbol: int, other: np.ndarray) -> int:
        """What the greatest fall of a symbol shares with a climb of it: the run of the symbol."""
        if not cap or not falls[symbol]:
            return 0
        ends = int(_at(falls[symbol][-1][-1])), int(_at(other))
        return min(_run(text, at, cap) for at in ends)

    carried = _Carried(top if cap else 0, cap)
    with SymbolQueue(in_memory, folder) as queue:
        for symbol, a, b in zip(symbols, low, high, strict=True):
            for part in queue.take(symbol):
                falls[symbol].append(part)
                scan(part, False, queue, carried)
            if a < b:
                mine = starts[a:b].copy()
                mine[0] = _tuples(_at(mine[0]), seam(symbol, mine[0]))
                scan(mine, False, queue, carried)

    carried = _Carried(top if cap else 0, cap)
    out = {}
    with SymbolQueue(in_memory, folder) as queue:
        scan(_tuples(single[::-1], 0), True, queue, carried)
        for symbol in symbols[:0:-1]:
            for part in queue.take(symbol):
                climbs[symbol].append(part)
                scan(part, True, queue, carried)
            meet = seam(symbol, climbs[symbol][-1][-1]) if climbs[symbol] else 0
            # Downwards, a suffix shares with the one above it.
            with_above = meet
            for part in reversed(falls[symbol]):
                shared = _shared(part)
                scan(
                    _tuples(_at(part)[::-1], np.r_[with_above, shared[:0:-1]]), True, queue, carried
                )
                with_above = shared[0]
            upwards, with_below = [], meet
            for part in reversed(climbs.pop(symbol)):
                at, shared = _at(part)[::-1], _shared(part)[::-1]
                upwards.append(_tuples(at, np.r_[with_below, shared[:-1]]))
                with_below = shared[-1]
            out[symbol] = [*falls.pop(symbol), *upwards]
    parts = [part for symbol in symbols[1:] for part in out[symbol]]
    return [_tuples(np.array([len(text) - 1]), 0), *parts, _tuples(single, 0)]


def ranks_by_doubling(names: np.ndarray) -> np.ndarray:
    """The order of the suffixes of a string that fits in memory.

    A rank is the number of smaller suffixes as far as is known; each round
    sorts those that still share one by the ranks `span` further on.
    """
    n, span = len(names), 1
    order = np.argsort(names, kind="stable")
    new = np.ones(n, dtype=bool)
    new[1:] = names[order][1:] != names[order][:-1]
    rank = np.empty(n + 1, dtype=np.int64)
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    rank[n] = -1
    alone = new & np.append(new[1:], True)[:n]
    left = order[~alone]
    while len(left):
        key = rank[left] * (n + 1) + rank[np.minimum(left + span, n)] + 1
        by_key = np.argsort(key)
        left, key = left[by_key], key[by_key]
        old = rank[left]
        group = np.ones(len(left), dtype=bool)
        group[1:] = old[1:] != old[:-1]
        new = np.ones(len(left), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        rank[left] = old + first - np.flatnonzero(group)[np.cumsum(group) - 1]
        left = left[~(new & np.append(new[1:], True))]
        span *= 2
    order = np.empty(n, dtype=np.int64)
    order[rank[:n]] = np.arange(n)
    return order


def _names(text: np.ndarray, sorted_starts: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Ranks of the stretches from each start to the next, equal ones alike, in text order."""
    end = np.full(len(text), len(text) - 1, dtype=np.int64)
    end[starts[:-1]] = starts[1:]
    a, b = sorted_starts[:-1], sorted_starts[1:]
    length = end[b] - b
    same = (end[a] - a) == length
    alive, step = np.flatnonzero(same), 0
    while len(alive):
        equal = text[a[alive] + step] == text[b[alive] + step]
        same[alive[~equal]] = False
        alive, step = alive[equal], step + 1
        alive = alive[length[alive] >= step]
    name = np.empty(len(text), dtype=np.int64)
    name[sorted_starts] = np.r_[0, np.cumsum(~same)]
    return name[starts]


def _prefixes(text: np.ndarray, at: np.ndarray, top: int, cap: int) -> np.ndarray:
    """What each of the suffixes at `at` shares with the one before it, `cap` at most.

    Symbols to `top` differ in their last eight bits; any other one ends a prefix.
    """
    packed = np.zeros(len(text) + cap + 8, dtype=np.uint64)
    for i in range(min(8, len(text))):
        packed[: len(text) - i] |= (text[i:].astype(np.uint64) & np.uint64(255)) << np.uint64(8 * i)
    ends = np.flatnonzero((text > top) | (text == 0))
    room = np.minimum(ends[np.searchsorted(ends, at)] - at, cap)
    a, b, limit = at[:-1], at[1:], np.minimum(room[:-1], room[1:])
    found = limit.copy()
    alive = np.flatnonzero(limit > 0)
    for step in range(0, cap, 8):
        differ = packed[a[alive] + step] ^ packed[b[alive] + step]
        ended = differ != 0
        lowest = differ[ended] & (~differ[ended] + np.uint64(1))
        equal = (np.frexp(lowest.astype(np.float64))[1] - 1) // 8
        mine = alive[ended]
        found[mine] = np.minimum(limit[mine], step + equal)
        alive = alive[~ended]
        alive = alive[limit[alive] > step + 8]
        if not len(alive):
            break
    return np.r_[0, found]


def suffixes(
    text: np.ndarray, top: int, cap: int, in_memory: int = IN_MEMORY, folder: str | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Positions of `text` by their suffixes, and what each shares with the one before.

    `text` has symbols from 1 to `top`, any number of larger ones that rise and
    occur once, each followed by a smaller one, the last before a final 0. No
    prefix counts beyond `cap` symbols; with a cap, `top` is at most 256.
    """
    if cap > MOST_SHARED or (cap and top > 256):
        raise ValueError(f"common prefixes of at most {MOST_SHARED} symbols from 1 to 256")
    rise = rising(text)
    starts = np.flatnonzero(rise[1:] & ~rise[:-1]) + 1
    by_symbol = starts[np.argsort(text[starts], kind="stable")]
    rough = _induce(text, rise, _tuples(by_symbol, 0), top, 0, in_memory, folder)
    is_start = np.zeros(len(text), dtype=bool)
    is_start[starts] = True
    rough = [_at(part) for part in rough]
    names = _names(text, np.concatenate([at[is_start[at]] for at in rough]), starts)
    del rough, is_start
    if len(names) <= _QUEUES * in_memory:
        exact = starts[ranks_by_doubling(names)]
    else:
        exact = starts[suffixes(names, int(names.max()), 0, in_memory, folder)[0]]
    shared = _prefixes(text, exact, top, cap) if cap else 0
    order = np.concatenate(_induce(text, rise, _tuples(exact, shared), top, cap, in_memory, folder))
    return _at(order), _shared(order)


def suffix_array(text: np.ndarray, top: int, in_memory: int = IN_MEMORY) -> np.ndarray:
    """Positions of `text` by their suffixes."""
    return suffixes(text, top, 0, in_memory)[0]
