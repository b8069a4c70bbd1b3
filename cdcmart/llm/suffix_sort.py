"""External induced sorting of suffixes with their common-prefix lengths.

A set of short byte strings is sorted suffix by suffix. Each string ends in an
end mark of its own, smaller than every byte. Suffixes are of type L (greater
than their successor) or S (smaller); an S suffix after an L suffix is a seed.

1. The substrings between seeds are ranked; if ranks repeat, the string of
   ranks is sorted by recursion (``induced_order``).
2. From the sorted seeds the L suffixes are induced in ascending order, then
   from these the S suffixes in descending order. A priority queue holds the
   tuples (first symbol, order of arrival, position, common prefix with the
   tuple before it under the same symbol); the common prefix of two induced
   tuples is one more than the least one met between their successors.

The queues keep a bounded number of tuples in memory and the rest on disk
(the task's own temporary folder; the files have no name and go with the
process). The byte level pops a whole symbol at once; the recursion's alphabet
has no bound, so it pops runs of symbols that are complete.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

#: tuples that a queue keeps in memory
IN_MEMORY = 1 << 20
_FAR = 1 << 14
_SYMBOLS = 257


class SymbolQueue:
    """A monotone priority queue of (symbol, arrival) with payload (position,
    common prefix). Arrivals under one symbol come in order, so each symbol is
    a first-in first-out list whose older parts may lie on disk."""

    def __init__(self, symbols: int = _SYMBOLS, in_memory: int = IN_MEMORY):
        self.held: list[list[np.ndarray]] = [[] for _ in range(symbols)]
        self.on_disk: list[list[tuple[int, int]]] = [[] for _ in range(symbols)]
        self.file = None
        self.count, self.in_memory = 0, in_memory

    def push(self, symbol: int, rows: np.ndarray) -> None:
        self.held[symbol].append(rows)
        self.count += len(rows)
        if self.count > self.in_memory:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        for symbol, parts in enumerate(self.held):
            if parts:
                rows = np.concatenate(parts)
                self.file.seek(0, 2)
                self.on_disk[symbol].append((self.file.tell(), len(rows)))
                self.file.write(np.ascontiguousarray(rows).tobytes())
                self.held[symbol] = []
        self.count = 0

    def pop(self, symbol: int) -> np.ndarray | None:
        """All tuples of a symbol in their order; None if there are none."""
        parts = []
        for at, n in self.on_disk[symbol]:
            self.file.seek(at)
            parts.append(np.frombuffer(self.file.read(n * 16), np.int64).reshape(n, 2))
        self.on_disk[symbol] = []
        self.count -= sum(len(p) for p in self.held[symbol])
        parts += self.held[symbol]
        self.held[symbol] = []
        return np.concatenate(parts) if parts else None


class SlotQueue:
    """The queue for alphabets without bound: the tuples of a symbol have a
    fixed number of slots, filled in the order of arrival. The slots lie on
    disk when there are more than ``in_memory``."""

    def __init__(self, symbols: np.ndarray, alphabet: int, in_memory: int):
        self.symbol = np.sort(symbols)  # of each slot
        self.start = np.searchsorted(self.symbol, np.arange(alphabet + 1))
        self.head = self.start[:-1].copy()
        size = len(symbols)
        self.slots = (np.memmap(tempfile.TemporaryFile(), np.int64, "w+", shape=size) if size > in_memory
                      else np.empty(size, np.int64))

    def push(self, symbols: np.ndarray, positions: np.ndarray) -> None:
        """Tuples in their order of arrival."""
        order = np.argsort(symbols, kind="stable")
        own = symbols[order]
        begin = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        count = np.diff(np.append(begin, len(own)))
        self.slots[np.repeat(self.head[own[begin]] - begin, count) + np.arange(len(own))] = positions[order]
        self.head[own[begin]] += count


def suffix_types(text: np.ndarray, last_smaller: bool) -> np.ndarray:
    """True where the suffix is of type S. ``last_smaller``: type of the last."""
    n = len(text)
    smaller = np.empty(n, bool)
    differs = np.ones(n, bool)
    smaller[:-1], smaller[-1] = text[:-1] < text[1:], last_smaller
    differs[:-1] = text[:-1] != text[1:]
    at = np.where(differs, np.arange(n), n)
    return smaller[np.minimum.accumulate(at[::-1])[::-1]]


def seed_positions(is_s: np.ndarray) -> np.ndarray:
    return np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1


def substring_ranks(text: np.ndarray, is_s: np.ndarray, seeds: np.ndarray, bits: int, ends_apart: bool) -> np.ndarray:
    """Rank of the substring from each seed through the next; equal substrings
    share a rank. ``ends_apart``: those through an end mark (0) never are equal
    but stand in the order of the text."""
    k, n = len(seeds), len(text)
    end = np.append(seeds[1:] + 1, n)
    own_end = text[end - 1] == 0 if ends_apart else np.zeros(k, bool)
    if ends_apart:
        end = np.where(text[seeds] == 0, seeds + 1, end)
        own_end |= text[seeds] == 0
    width = 62 // bits
    rank, active, depth = np.zeros(k, np.int64), np.arange(k), 0
    while len(active):
        key = np.zeros(len(active), np.int64)
        for j in range(width):
            at = seeds[active] + depth + j
            inside = at < end[active]
            at = np.minimum(at, n - 1)
            key = (key << bits) | np.where(inside, (text[at].astype(np.int64) << 1 | is_s[at]) + 1, 0)
        order = np.lexsort((key, rank[active]))
        active, key = active[order], key[order]
        old = rank[active]
        fresh = np.ones(len(active), bool)
        fresh[1:] = (old[1:] != old[:-1]) | (key[1:] != key[:-1])
        group_start = np.ones(len(active), bool)
        group_start[1:] = old[1:] != old[:-1]
        here = np.arange(len(active))
        rank[active] = old + np.maximum.accumulate(np.where(fresh, here, 0)) - np.maximum.accumulate(np.where(group_start, here, 0))
        alone = fresh & np.append(fresh[1:], True)
        depth += width
        active = active[~alone & (seeds[active] + depth < end[active])]
    if own_end.any():
        order = np.lexsort((np.arange(k), rank))
        sorted_rank = rank[order]
        start = np.searchsorted(sorted_rank, sorted_rank)
        within = np.empty(k, np.int64)
        within[order] = np.arange(k) - start
        rank = rank + np.where(own_end, within, 0)
    return rank


def _induce(text: np.ndarray, takes: np.ndarray, seeds: np.ndarray, begin: int | None, in_memory: int) -> np.ndarray:
    """Scan in the order of symbols, under each the queue's tuples and then the
    (sorted) seeds; push what precedes a scanned suffix where ``takes`` holds.
    The queue's suffixes in their order.

    Many symbols are scanned at once: up to the first under which one of the
    scanned suffixes pushes, as that one's tuples are not complete."""
    alphabet = int(text.max()) + 1
    queue = SlotQueue(text[takes], alphabet, in_memory)
    edge = np.searchsorted(text[seeds], np.arange(alphabet + 1))
    before = queue.start + edge
    if begin is not None:
        queue.push(text[[begin]], np.array([begin]))

    def pushes(scanned: np.ndarray) -> np.ndarray:
        pred = scanned[scanned > 0] - 1
        return pred[takes[pred]]

    c, wanted = 0, 512
    while c < alphabet:
        until = max(c + 1, int(np.searchsorted(before, before[c] + wanted, "right")) - 1)
        slots = np.arange(queue.start[c], queue.start[until])
        slots = slots[slots < queue.head[queue.symbol[slots]]]
        own = seeds[edge[c]:edge[until]]
        key = np.concatenate([queue.symbol[slots] * 2, text[own] * 2 + 1])
        order = np.argsort(key, kind="stable")
        key, scanned = key[order], np.concatenate([queue.slots[slots], own])[order]
        pred = pushes(scanned)
        if len(pred):
            nearest = int(text[pred].min())
            if nearest == c:  # a run of one symbol: its tuples push under the symbol itself
                done = queue.start[c]
                while done < queue.head[c]:
                    upto = queue.head[c]
                    pred = pushes(np.asarray(queue.slots[done:upto]))
                    done = upto
                    if len(pred):
                        queue.push(text[pred], pred)
                pred, until = pushes(seeds[edge[c]:edge[c + 1]]), c + 1
            elif nearest < until:
                until, wanted = nearest, max(64, wanted // 2)
                pred = pushes(scanned[:np.searchsorted(key, 2 * nearest)])
            else:
                wanted = min(1 << 16, wanted * 2)
            if len(pred):
                queue.push(text[pred], pred)
        c = until
    return queue.slots


def induced_order(names: np.ndarray, in_memory: int = IN_MEMORY) -> np.ndarray:
    """The sorted order of all suffixes of a string of numbers."""
    n = len(names)
    order = np.argsort(names, kind="stable")
    if n < 2 or (np.diff(names[order]) > 0).all():
        return order
    text = np.cumsum(np.append(0, np.diff(names[order]) > 0))[np.argsort(order, kind="stable")]
    is_s = suffix_types(text, False)
    seeds = seed_positions(is_s)
    if len(seeds):
        ranks = substring_ranks(text, is_s, seeds, int(2 * n + 2).bit_length(), False)
        seeds = seeds[induced_order(ranks, in_memory)]
    rising = _induce(text, ~is_s, seeds, n - 1, in_memory)
    falling = _induce(text.max() - text, is_s, np.asarray(rising[::-1]), None, in_memory)
    both = np.concatenate([rising, falling[::-1]])
    smaller = np.append(np.zeros(len(rising), np.int64), np.ones(len(falling), np.int64))
    return both[np.argsort(text[both] * 2 + smaller, kind="stable")]


class _Inducer:
    """One pass of induction over the bytes, in the order of its scans."""

    def __init__(self, text: np.ndarray, induced: np.ndarray, cap: int, in_memory: int):
        self.text, self.induced, self.cap = text, induced, cap
        self.queue = SymbolQueue(in_memory=in_memory)
        self.since = np.full(_SYMBOLS, -1, np.int64)  # least common prefix scanned since a symbol's last push

    def scan(self, rows: np.ndarray) -> None:
        """Push what precedes the scanned suffixes; column 1 of ``rows`` is the
        common prefix with the suffix scanned before."""
        position, common = rows[:, 0], rows[:, 1]
        before = position - 1
        takes = (position > 0) & self.induced[before]
        at = np.flatnonzero(takes)
        so_far = np.minimum.accumulate(common)
        after = np.append(np.minimum.accumulate(common[::-1])[::-1], _FAR)
        if len(at):
            symbol = self.text[before[at]].astype(np.int64)
            order = np.argsort(symbol, kind="stable")
            at, symbol = at[order], symbol[order]
            first = np.ones(len(at), bool)
            first[1:] = symbol[1:] != symbol[:-1]
            least = np.empty(len(at), np.int64)
            least[first] = np.minimum(self.since[symbol[first]], so_far[at[first]])
            rest = np.flatnonzero(~first)
            if len(rest):
                ranges = np.empty(2 * len(rest), np.int64)
                ranges[0::2], ranges[1::2] = at[rest - 1] + 1, at[rest] + 1
                least[rest] = np.minimum.reduceat(np.append(common, _FAR), ranges)[::2]
            pushed = np.column_stack([before[at], np.minimum(least + 1, self.cap)])
            begin = np.flatnonzero(first)
            until = np.append(begin[1:], len(at))
            self.since = np.minimum(self.since, so_far[-1])
            self.since[symbol[begin]] = after[at[until - 1] + 1]
            for a, b in zip(begin.tolist(), until.tolist()):
                self.queue.push(int(symbol[a]), pushed[a:b])
        else:
            self.since = np.minimum(self.since, so_far[-1])


def _run(text: np.ndarray, p: int, cap: int) -> int:
    """How often the symbol at ``p`` repeats from there, up to ``cap``."""
    differs = np.flatnonzero(text[p:p + cap] != text[p])
    return int(differs[0]) if len(differs) else len(text[p:p + cap])


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefixes of pairs of suffixes, up to ``cap``, read off the text."""
    out, live = np.zeros(len(a), np.int64), np.arange(len(a))
    for d in range(cap):
        same = (text[a[live] + d] == text[b[live] + d]) & (text[a[live] + d] != 0)
        live = live[same]
        if not len(live):
            break
        out[live] += 1
    return out


def sorted_suffixes(data: np.ndarray, offsets: np.ndarray, cap: int,
                    in_memory: int = IN_MEMORY) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The suffixes of the strings data[offsets[i]:offsets[i + 1]] (none empty),
    by first byte from the greatest down; inside one in ascending order.

    Yields (positions, common): positions count the string number on top of the
    byte's index, for the end marks; ``common`` is the common prefix with the
    suffix before, up to ``cap``, 0 for the first.
    """
    m = len(offsets) - 1
    if m == 0:
        return
    text = np.zeros(len(data) + m, np.uint16)
    marks = offsets[1:] + np.arange(m)
    inside = np.ones(len(text), bool)
    inside[marks] = False
    text[inside] = data.astype(np.uint16) + 1
    is_s = suffix_types(text, True)
    seeds = seed_positions(is_s)
    ranks = substring_ranks(text, is_s, seeds, 11, True)
    seeds = seeds[induced_order(ranks, in_memory)]
    common = np.zeros(len(seeds), np.int64)
    common[1:] = _common(text, seeds[:-1], seeds[1:], cap)
    edges = np.searchsorted(text[seeds], np.arange(_SYMBOLS + 1))
    rows = np.column_stack([seeds, common])

    rising, parts = _Inducer(text, ~is_s, cap, in_memory), SymbolQueue(in_memory=in_memory)
    rising.scan(rows[:edges[1]])  # the end marks
    for c in range(1, _SYMBOLS):
        last = None
        while (batch := rising.queue.pop(c)) is not None:
            parts.push(c, batch)
            last = int(batch[-1, 0])
            rising.scan(batch)
        if edges[c] < edges[c + 1]:
            own = rows[edges[c]:edges[c + 1]].copy()
            own[0, 1] = 0 if last is None else min(_run(text, last, cap), _run(text, int(own[0, 0]), cap))
            rising.scan(own)

    falling = _Inducer(text, is_s & (text != 0), cap, in_memory)
    for c in range(_SYMBOLS - 1, 0, -1):
        down = []
        while (batch := falling.queue.pop(c)) is not None:
            down.append(batch)
            falling.scan(batch)
        low = parts.pop(c)
        high = np.concatenate(down) if down else None
        border = 0
        if low is not None and high is not None:
            border = min(_run(text, int(low[-1, 0]), cap), _run(text, int(high[-1, 0]), cap))
        if low is not None:
            # downwards each suffix is compared with the one above it
            falling.scan(np.column_stack([low[::-1, 0], np.append(border, low[:0:-1, 1])]))
        if high is not None:
            up = np.column_stack([high[::-1, 0], np.append(border, high[:0:-1, 1])])
            low = up if low is None else np.concatenate([low, up])
        if low is not None:
            yield low[:, 0], low[:, 1]
