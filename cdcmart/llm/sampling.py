"""Sampled segmentations without replacement, and decoding.

The lattice of a text has a path for every way to write it in pieces; a path's
probability is the product of its pieces' over the sum of all paths. Gumbel
top-k draws k different paths as if one after another without replacement:
every path has its log probability plus Gumbel noise, and the k greatest win.
The noise is drawn top down: a set of paths with one prefix has the greatest
noise of its paths, and a best-first (A*) search takes the set with the
greatest value, draws its best path by the forward probabilities, and puts the
sets that branch off that path back into the queue with noise below it.

Pieces never reach across the start of a run of blanks, so the lattice is a
chain of units (blanks and the word after them). Units are compiled once, many
at a time; all units of a batch of texts are sampled together in numpy.

The model file gives merge ranks, not probabilities; here a piece's weight is
1 / (rank + 2), normalised, to the power ``alpha``. Characters without a piece
are written in byte pieces.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, ragged, slices

BLANK = "▁"
#: compiled units that a worker keeps before it starts again
UNITS_KEPT = 450_000
#: code points of the texts that are sampled together
BATCH_CHARS = 120_000
_UNITS = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)
_TURN = np.uint64(0xD6E8FEB86659FD93)
_TABLE_BITS = 18


class Pieces:
    """The pieces of a model: weights, bytes, and a hash table of all prefixes."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        normal = [i for i in range(size) if not (self.model.is_byte(i) or self.model.is_control(i)
                                                 or self.model.is_unknown(i) or self.model.is_unused(i))]
        self.byte_ids = np.array([self.model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        mass = np.zeros(size)
        mass[normal] = 1 / (np.arange(len(normal)) + 2.0)
        mass[self.byte_ids] = 1 / (len(normal) + 2.0)
        self.weight = np.full(size, -np.inf)
        self.weight[mass > 0] = alpha * np.log(mass[mass > 0] / mass.sum())
        text = [b""] * size
        for i in normal:
            text[i] = self.model.id_to_piece(i).encode()
        for b, i in enumerate(self.byte_ids.tolist()):
            text[i] = bytes([b])
        self.text = pa.array(text, pa.large_binary())
        # what a piece is in a decoded text; None where only the library knows
        surface = [None] * size
        for i in normal:
            surface[i] = text[i].decode().replace(BLANK, " ").encode()
        for b, i in enumerate(self.byte_ids.tolist()):
            surface[i] = bytes([b])
        self.surface = pa.array(surface, pa.large_binary())
        self.led = np.zeros(size, bool)  # pieces that lose a blank at the start of a text
        self.led[[i for i in normal if text[i].startswith(BLANK.encode())]] = True
        blank = self.model.piece_to_id(BLANK)
        self.drops_one = self.model.decode([blank, blank]) == " "
        prefixes: dict[int, int] = {}
        self.longest = 0
        for i in normal:
            h, piece = 0, self.model.id_to_piece(i)
            self.longest = max(self.longest, len(piece))
            for c in piece[:-1]:
                h = (h * int(_STEP) + ord(c) + 1) % (1 << 64)
                prefixes.setdefault(h, -1)
            h = (h * int(_STEP) + ord(piece[-1]) + 1) % (1 << 64)
            prefixes[h] = i
        self.keys = np.zeros(1 << _TABLE_BITS, np.uint64)
        self.ids = np.full(1 << _TABLE_BITS, -2, np.int32)
        for h, i in prefixes.items():
            at = self._slot(np.array([h], np.uint64))[0]
            while self.ids[at] != -2:
                at = (at + 1) & ((1 << _TABLE_BITS) - 1)
            self.keys[at], self.ids[at] = h, i

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return (mix(h) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece id of each hash, -1 for a mere prefix of one, -2 for neither."""
        at = self._slot(h)
        out = self.ids[at]
        other = np.flatnonzero((self.keys[at] != h) & (out != -2))
        while len(other):  # another hash holds the slot: the next one
            at[other] = (at[other] + 1) & ((1 << _TABLE_BITS) - 1)
            out[other] = self.ids[at[other]]
            other = other[(self.keys[at[other]] != h[other]) & (out[other] != -2)]
        return out


@functools.lru_cache(maxsize=2)
def _pieces(path: str, alpha: float) -> Pieces:
    return Pieces(path, alpha)


class Lattices:
    """Compiled units: states (places in a unit) and edges (pieces) between
    them, each edge with its probability among the edges of its state."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self._held: dict[str, np.ndarray] = {}
        self._used: dict[str, int] = {}
        for name, kind in (("first_state", np.int64), ("last_state", np.int64),
                           ("state_edge", np.int64),  # edges of state s: state_edge[s] .. state_edge[s + 1]
                           ("target", np.int32),
                           ("piece", np.int32),       # or minus the code point, for byte pieces
                           ("log_p", np.float64),
                           ("upto", np.float64)):     # running sum of probabilities in the state
            self._held[name], self._used[name] = np.zeros(1 << 12, kind), 0
            self._add(name, np.zeros(0, kind))
        self._add("state_edge", np.zeros(1, np.int64))

    def _add(self, name: str, values: np.ndarray) -> None:
        """Append, in room that doubles when it is full."""
        held, used = self._held[name], self._used[name]
        if used + len(values) > len(held):
            larger = np.empty(max(2 * len(held), used + len(values)), held.dtype)
            larger[:used] = held[:used]
            self._held[name] = held = larger
        held[used:used + len(values)] = values
        self._used[name] = used + len(values)
        setattr(self, name, held[:used + len(values)])

    def numbers(self, units: pa.Array) -> np.ndarray:
        """The number of each unit; unknown ones are compiled first."""
        coded = units.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = np.fromiter(map(self.number.get, distinct, itertools.repeat(-1)), np.int64, len(distinct))
        lacking = np.flatnonzero(found < 0)
        if len(lacking):
            if len(self.number) + len(lacking) > UNITS_KEPT:
                self.clear()
                lacking = np.arange(len(distinct))
            start = len(self.number)
            self._compile([distinct[i] for i in lacking.tolist()])
            found[lacking] = start + np.arange(len(lacking))
        return found[coded.indices.to_numpy()]

    def _compile(self, units: list[str]) -> None:
        table = self.pieces
        chars = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.uint64)
        size = np.fromiter(map(len, units), np.int64, len(units))
        end = np.cumsum(size)
        place = np.arange(len(chars))
        left = np.repeat(end, size) - place
        # pieces by length; each place has one of one character, or that character's bytes
        count = np.zeros(len(chars), np.int64)
        known, ids, nths = [], [], []
        alive, h = place, np.zeros(len(chars), np.uint64)
        for length in range(1, table.longest + 1):
            if length > 1:
                inside = left[alive] >= length
                alive, h = alive[inside], h[inside]
            h = h * _STEP + chars[alive + (length - 1)] + np.uint64(1)
            found = table.find(h)
            if length == 1:
                at, piece = alive, np.where(found < 0, -chars.astype(np.int32), found)
            else:
                here = np.flatnonzero(found >= 0)
                at, piece = alive[here], found[here]
            known.append(at)
            ids.append(piece)
            nths.append(count[at])
            count[at] += 1
            begun = np.flatnonzero(found > -2)
            alive, h = alive[begun], h[begun]
            if not len(alive):
                break
        # edges by place and length; states: the places of a unit and its end
        first = np.cumsum(count) - count
        edges = int(count.sum())
        piece, length = np.empty(edges, np.int32), np.empty(edges, np.int32)
        for i, (at, own, nth) in enumerate(zip(known, ids, nths), 1):
            to = first[at] + nth
            piece[to], length[to] = own, i
        state = place + np.repeat(np.arange(len(units)), size)
        source = np.repeat(state, count)
        target = source + length
        weight = table.weight[np.maximum(piece, 0)]
        bare = np.flatnonzero(piece <= 0)
        weight[bare] = byte_count(-piece[bare]) * table.weight[table.byte_ids[0]]
        # from the units' ends to their starts
        sums = np.zeros(len(chars) + len(units))
        longest = int(left.max()) if len(left) else 0
        by_left = np.argsort(left.astype(np.uint16) if longest < 1 << 16 else left, kind="stable")
        counts, states = count[by_left], state[by_left]
        order = ragged(first[by_left], counts)
        weights, targets = weight[order], target[order]
        begin = np.cumsum(counts) - counts
        bounds = np.append(0, np.cumsum(np.bincount(left)[1:])).tolist()
        for a, b in zip(bounds[:-1], bounds[1:]):
            if a == b:
                continue
            lo, hi = int(begin[a]), int(begin[b - 1] + counts[b - 1])
            value = weights[lo:hi] + sums[targets[lo:hi]]
            starts = begin[a:b] - lo
            top = np.maximum.reduceat(value, starts)
            value -= np.repeat(top, counts[a:b])
            sums[states[a:b]] = top + np.log(np.add.reduceat(np.exp(value, out=value), starts))
        log_p = weight + sums[target]
        log_p -= np.repeat(sums[state], count)
        # in whole numbers, so that a state's sums do not depend on the units compiled beside it
        p = np.minimum(log_p, 0)
        np.exp(p, out=p)
        p *= 2.0 ** 52
        running = np.append(np.uint64(0), np.cumsum(p.astype(np.uint64), dtype=np.uint64))
        upto = (running[1:] - np.repeat(running[first], count)) * 2.0 ** -52
        upto[first + count - 1] = 2.0  # the last edge takes what rounding leaves
        counts = np.zeros(len(sums), np.int64)
        counts[state] = count
        base, before = self._used["state_edge"] - 1, self._used["target"]
        self._add("first_state", end - size + np.arange(len(units)) + base)
        self._add("last_state", end + np.arange(len(units)) + base)
        self._add("state_edge", before + np.cumsum(counts))
        self._add("target", target + base)
        self._add("piece", piece)
        self._add("log_p", log_p)
        self._add("upto", upto)
        start = len(self.number)
        self.number.update(zip(units, range(start, start + len(units))))

    def draw(self, state: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge of each state by a uniform number: the first whose running sum is above it."""
        first, edge = self.state_edge[state], self.state_edge[state + 1] - 1
        todo = np.flatnonzero(edge > first)
        while len(todo):  # from the longest piece down
            at = edge[todo] - 1
            less = self.upto[at] > u[todo]
            todo, at = todo[less], at[less]
            edge[todo] = at
            todo = todo[at > first[todo]]
        return edge

    def state_of(self, edge: np.ndarray) -> np.ndarray:
        """The state that each edge leaves."""
        return np.searchsorted(self.state_edge, edge, "right") - 1


@functools.lru_cache(maxsize=1)
def _lattices(path: str, alpha: float) -> Lattices:
    """The compiled units of a Python worker: its next tasks go on with them."""
    return Lattices(_pieces(path, alpha))


def byte_count(code: np.ndarray) -> np.ndarray:
    """UTF-8 bytes of a code point."""
    return 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)


def uniform(key: np.ndarray, counter: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from keys and counters."""
    return _fraction(key + (counter.astype(np.uint64) + np.uint64(1)) * _TURN)


def _fraction(turned: np.ndarray) -> np.ndarray:
    return ((mix(turned) >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0 ** -52


def row_keys(ids: list, seed: int, draw: int) -> np.ndarray:
    """A 64-bit key per row: digest of its id, the seed and the draw's number."""
    return np.array([int.from_bytes(hashlib.blake2b(f"{seed}|{draw}|{i}".encode(), digest_size=8).digest(), "little")
                     for i in ids], np.uint64)


def sample_paths(lat: Lattices, units: np.ndarray, start: np.ndarray, row: np.ndarray, nth: np.ndarray, keys: np.ndarray):
    """Draw a path through each unit from its ``start`` state: the edges, unit
    after unit, and how many each unit has."""
    state, end = start, lat.last_state[units]
    turned = keys[row] + (nth.astype(np.uint64) * np.uint64(65_536) + np.uint64(1)) * _TURN
    taken, of, steps = [], [], np.zeros(len(units), np.int64)
    live = np.flatnonzero(state != end)
    state, end, turned = state[live], end[live], turned[live]
    while len(live):
        edge = lat.draw(state, _fraction(turned))
        taken.append(edge)
        of.append(live)
        steps[live] += 1
        state = lat.target[edge].astype(np.int64)
        on = np.flatnonzero(state != end)
        live, state, end, turned = live[on], state[on], end[on], turned[on] + _TURN
    edges = np.empty(int(steps.sum()), np.int64)
    at = np.cumsum(steps) - steps
    for i, (edge, which) in enumerate(zip(taken, of)):
        edges[at[which] + i] = edge
    return edges, steps


class _Row:
    """The search over one text: its samples and the queue of open sets."""

    def __init__(self, units: np.ndarray):
        self.units = units
        self.samples: list[tuple[np.ndarray, np.ndarray | None, float, float]] = []  # edges, edges up to each unit's end, log p, perturbed
        self.open: list = []  # (-perturbed, order, sample it branches off, edge's place, excluded edges, log mass)
        self.order = 0

    def put(self, perturbed: float, sample: int, place: int, excluded: tuple, mass: float) -> None:
        heapq.heappush(self.open, (-perturbed, self.order, sample, place, excluded, mass))
        self.order += 1


def _truncated(mass: np.ndarray, noise: np.ndarray, top: np.ndarray) -> np.ndarray:
    """Gumbel values of log masses that stay below ``top``: from exponential noise."""
    with np.errstate(over="ignore", divide="ignore"):
        out = -np.log(np.exp(-mass) * noise + np.exp(-top))
        far = np.flatnonzero((mass < -600) & (mass > -np.inf))  # where exp(-mass) is out of range
        out[far] = -np.logaddexp(np.log(noise[far]) - mass[far], -top[far])
    return out


def sample_rows(lat: Lattices, texts: list[list[str]], ids: list, k: int, seed: int) -> list[_Row]:
    """k different paths (all, if there are fewer) of each row's lattice, and
    the queue that is left: its first value is the threshold."""
    numbers = lat.numbers(pa.array([u for t in texts for u in t], pa.string()))
    return sample_units(lat, numbers, np.fromiter(map(len, texts), np.int64, len(texts)), ids, k, seed)


def sample_units(lat: Lattices, numbers: np.ndarray, counts: np.ndarray, ids: list, k: int, seed: int) -> list[_Row]:
    """``sample_rows`` of the numbers of all rows' units, one row after another."""
    cut = np.append(0, np.cumsum(counts)).tolist()
    rows = [_Row(numbers[a:b]) for a, b in zip(cut[:-1], cut[1:])]
    none = np.zeros(len(rows), np.int64)
    top = -np.log(-np.log(uniform(row_keys(ids, seed, -1), none)))
    of, place, sample, edge = list(range(len(rows))), [-1] * len(rows), [-1] * len(rows), none
    for draw in range(k):
        if not of:
            break
        own_ids = [ids[i] for i in of]
        keys, noise_keys = row_keys(own_ids, seed, draw), row_keys(own_ids, seed, draw + 1_000_000)
        # the unit of each row that is drawn first; those before it stay as in the path it branches off
        if draw:
            first = [int(np.searchsorted(rows[i].samples[s][1], p, "right")) for i, p, s in zip(of, place, sample)]
            units = np.concatenate([rows[i].units[f:] for i, f in zip(of, first)])
        else:
            first, units = [0] * len(of), numbers
        firsts = np.array(first, np.int64)
        lengths = np.array([len(rows[i].units) for i in of], np.int64) - firsts
        start = lat.first_state[units]
        if draw:
            start[np.cumsum(lengths) - lengths] = lat.target[edge]
        drawn, steps = sample_paths(lat, units, start, np.repeat(np.arange(len(of)), lengths), ragged(firsts, lengths), keys)
        upto = np.append(0, np.cumsum(steps))
        unit_cut = np.append(0, np.cumsum(lengths))
        part = upto[unit_cut]
        # whole paths: what they share with the one they branch off, the edge that leaves it, and what is drawn
        heads = np.array(place, np.int64) + 1
        ends = np.cumsum(heads + np.diff(part))
        begin = ends - heads - np.diff(part)
        cuts = list(zip(begin.tolist(), ends.tolist()))
        if draw:
            every = np.empty(int(ends[-1]), np.int64)
            every[ragged(begin + heads, np.diff(part))] = drawn
            every[begin + heads - 1] = edge
            for i, (lo, _), p, s in zip(of, cuts, place, sample):
                every[lo:lo + p] = rows[i].samples[s][0][:p]
        else:
            every = drawn
        log_p = lat.log_p[every]
        # sums of each row alone, so that they do not depend on the rows beside it
        running = np.empty(len(every))
        for lo, hi in cuts:
            np.cumsum(log_p[lo:hi], out=running[lo:hi])
        # the sets that leave the path where it has another edge, after the place at which it branched off (others at
        # that place are put back when it is drawn): prefix times what the edge leaves
        fork = np.flatnonzero(log_p < 0)
        if draw:
            fork = fork[fork >= np.repeat(begin + heads, np.diff(np.searchsorted(fork, np.append(begin, ends[-1]))))]
        fork_cut = np.searchsorted(fork, np.append(begin, ends[-1]))
        owner = np.repeat(np.arange(len(of)), np.diff(fork_cut))
        with np.errstate(divide="ignore"):
            mass = running[fork] - log_p[fork] + np.log(np.maximum(-np.expm1(log_p[fork]), 0))
        value = _truncated(mass, -np.log(uniform(noise_keys[owner], fork - begin[owner])), top[owner])
        tops, fork_cut, unit_cut = top.tolist(), fork_cut.tolist(), unit_cut.tolist()
        for n, (i, (lo, hi)) in enumerate(zip(of, cuts)):
            row, unit_ends = rows[i], None
            if draw + 1 < k:
                unit_ends = upto[unit_cut[n] + 1:unit_cut[n + 1] + 1] - upto[unit_cut[n]] + (place[n] + 1)
                if draw:
                    unit_ends = np.concatenate([row.samples[sample[n]][1][:first[n]], unit_ends])
            row.samples.append((every[lo:hi], unit_ends, float(log_p[lo:hi].sum()), tops[n]))
            a, b = fork_cut[n], fork_cut[n + 1]
            best = min(k - draw, b - a)  # no more of them can come before the threshold
            if best == 1:
                chosen = [a + int(np.argmax(value[a:b]))]
            else:
                chosen = (np.argpartition(-value[a:b], best - 1)[:best] + a).tolist() if best else []
            for j in chosen:
                if mass[j] > -np.inf:
                    row.put(float(value[j]), len(row.samples) - 1, int(fork[j]) - lo, (int(every[fork[j]]),), float(mass[j]))
        if draw + 1 < k:
            of = [i for i, row in enumerate(rows) if row.open]
            place, sample, edge, top = _branch(lat, [rows[i] for i in of], row_keys([ids[i] for i in of], seed, draw + 2_000_000))
    return rows


def _branch(lat: Lattices, rows: list[_Row], keys: np.ndarray):
    """Take the best open set of each row: draw the edge with which its best path
    leaves; the set's other edges go back to the queue below that path."""
    taken = [heapq.heappop(row.open) for row in rows]
    top = -np.array([t[0] for t in taken])
    place, sample, mass = [t[3] for t in taken], [t[2] for t in taken], np.array([t[5] for t in taken])
    state = lat.state_of(np.array([t[4][0] for t in taken], np.int64))
    edge = np.zeros(len(rows), np.int64)
    same_count: dict[int, list[tuple[int, list[int]]]] = {}
    for n, (t, lo, hi) in enumerate(zip(taken, lat.state_edge[state].tolist(), lat.state_edge[state + 1].tolist())):
        others = [e for e in range(lo, hi) if e not in t[4]]
        same_count.setdefault(len(others), []).append((n, others))
    first, second = (uniform(keys, np.full(len(keys), i)) for i in (0, 1))
    for count, group in same_count.items():
        which = np.array([n for n, _ in group])
        others = np.array([o for _, o in group], np.int64)
        p = np.exp(lat.log_p[others])
        total = p.sum(axis=1)
        below = (np.cumsum(p, axis=1) / total[:, None] <= first[which][:, None]).sum(axis=1)
        chosen = others[np.arange(len(which)), np.minimum(below, count - 1)]
        edge[which] = chosen
        if count > 1:
            rest = mass[which] - np.log(total) + np.log(np.maximum(total - np.exp(lat.log_p[chosen]), 1e-300))
            value = _truncated(rest, -np.log(second[which]), top[which])
            for n, e, v, m in zip(which.tolist(), chosen.tolist(), value.tolist(), rest.tolist()):
                rows[n].put(v, sample[n], place[n], (*taken[n][4], e), m)
    return place, sample, edge, top


def split_units(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The units of all texts (UTF-8), one text after another, and how many each
    has: a unit starts where a text or a run of blanks does."""
    data = b"".join(texts)
    codes = np.frombuffer(data, np.uint8)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    text_start = np.cumsum(size) - size
    lead, *more = BLANK.encode()
    blank = np.flatnonzero(codes == lead)
    for i, byte in enumerate(more, 1):
        blank = blank[codes[blank + i] == byte]
    start = np.zeros(len(codes) + 1, bool)
    start[blank] = True
    start[blank[1:][np.diff(blank) == len(BLANK.encode())]] = False
    start[text_start[size > 0]] = True
    at = np.append(np.flatnonzero(start[:-1]), len(codes))
    units = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(data))
    return units, np.diff(np.searchsorted(at[:-1], np.append(text_start, len(codes))))


def token_ids(lat: Lattices, edges: np.ndarray) -> np.ndarray:
    """The piece ids of a path; characters without a piece as their bytes."""
    return path_tokens(lat, edges, np.array([0, len(edges)]))[0]


def path_tokens(lat: Lattices, edges: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``token_ids`` of several paths, one after another, and where each of them is cut off."""
    piece = lat.piece[edges]
    bare = np.flatnonzero(piece <= 0)
    if not len(bare):
        return piece, cuts
    code = -piece[bare].astype(np.int64)
    count = np.ones(len(piece), np.int64)
    count[bare] = size = byte_count(code)
    upto = np.append(0, np.cumsum(count))
    out = np.repeat(piece, count)
    # UTF-8: six bits in each byte but the first, which begins with a bit for each byte there is
    for n, marks in enumerate((0x00, 0xC0, 0xE0, 0xF0), 1):
        own = size == n
        for i in range(n):
            bits = code[own] >> 6 * (n - 1 - i)
            out[upto[bare[own]] + i] = lat.pieces.byte_ids[bits | marks if i == 0 else bits & 0x3F | 0x80]
    return out, upto[cuts]


def decode(pieces: Pieces, ids: np.ndarray) -> tuple[pa.Buffer, np.ndarray]:
    """The normalised text of piece ids, in UTF-8, and where each id's begins in it (and the last ends)."""
    if not len(ids):
        return pa.py_buffer(b""), np.zeros(1, np.int64)
    _, offsets, data = pieces.text.take(pa.array(ids)).buffers()
    return data, np.frombuffer(offsets, np.int64)[:len(ids) + 1]


def decoded_texts(pieces: Pieces, ids: np.ndarray, cuts: np.ndarray) -> list[str]:
    """The texts of several rows' ids, one row after another, as the SentencePiece
    library decodes them; by the library itself where a row has ids that are no
    pieces or bytes that are no UTF-8."""
    library = np.zeros(len(cuts) - 1, bool)
    if not pieces.drops_one:
        library[:] = True
    inside = (ids >= 0) & (ids < len(pieces.surface))
    known = pieces.surface.take(pa.array(np.where(inside, ids, 0)))
    lacking = np.flatnonzero(~inside | known.is_null().to_numpy(zero_copy_only=False))
    library[np.searchsorted(cuts, lacking, "right") - 1] = True
    _, offsets, data = known.buffers()
    raw = memoryview(data) if data is not None else memoryview(b"")
    at = np.frombuffer(offsets, np.int64)[cuts] if len(ids) else np.zeros(len(cuts), np.int64)
    first = np.where(np.diff(cuts) > 0, np.append(ids, -1)[cuts[:-1]], -1)
    begin = at[:-1] + np.where((first >= 0) & (first < len(pieces.led)), pieces.led[np.clip(first, 0, len(pieces.led) - 1)], False)
    out = []
    for i, (lo, hi, by_library) in enumerate(zip(begin.tolist(), at[1:].tolist(), library.tolist())):
        if not by_library:
            try:
                out.append(str(raw[lo:hi], "utf-8"))
                continue
            except UnicodeDecodeError:
                pass
        out.append(pieces.model.decode(ids[cuts[i]:cuts[i + 1]].tolist()))
    return out


def sample_segmentations(docs: DataFrame, model_path: str, k: int = 2, alpha: float = 1.0, seed: int = 0,
                         with_ids: bool = True, with_text: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs`` its k sampled segmentations, ranked by perturbed value:
    doc_id, rank, n_tokens, log_prob, perturbed, threshold, inclusion,
    log_inclusion, ids_sha256 (over the ids as little-endian 32-bit numbers),
    round_trip, with ``with_ids`` ids, and with ``with_text`` decoded, the text
    of the ids as ``decode_ids`` gives it.

    ``inclusion`` is the probability that a path of this log probability
    exceeds the threshold, the greatest perturbed value outside the sample; 1
    if the sample holds every segmentation, which has no threshold (null).
    ``log_inclusion`` is its logarithm, also where ``inclusion`` is too small
    for a double, as for most long texts. ``round_trip``: the ids decode to
    the text as the model normalises it. The draws depend on the seed, the id
    and the text alone, not on how rows are spread.

    A null text counts as empty and has the one empty segmentation. A text with
    fewer than k segmentations gives them all. Rows that repeat an id and a text give
    equal samples; a null id is a key of its own; an empty table gives an
    empty result; other columns are ignored.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lat = _lattices(model_path, alpha)
        for batch in batches:
            texts, lo = batch.column("text").to_pylist(), 0
            while lo < len(texts):
                hi, chars = lo, 0
                while hi < len(texts) and (hi == lo or chars + len(texts[hi]) <= BATCH_CHARS):
                    chars += len(texts[hi])
                    hi += 1
                yield _answer(lat, batch.column("doc_id").slice(lo, hi - lo), texts[lo:hi])
                lo = hi

    def _answer(lat: Lattices, ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
        written = [lat.pieces.model.normalize(t).encode() for t in texts]
        units, counts = split_units(written)
        found = sample_units(lat, lat.numbers(units), counts, ids.to_pylist(), k, seed)
        of = [i for i, row in enumerate(found) for _ in row.samples]
        samples = [s for row in found for s in row.samples]
        cuts = np.cumsum([0, *(len(edges) for edges, *_ in samples)])
        tokens, cuts = path_tokens(lat, np.concatenate([np.zeros(0, np.int64), *(edges for edges, *_ in samples)]), cuts)
        decoded, starts = decode(lat.pieces, tokens)
        log_p, perturbed = (np.array([s[i] for s in samples]) for i in (2, 3))
        threshold = np.array([-found[i].open[0][0] if found[i].open else -np.inf for i in of])
        inclusion = np.where(threshold > -np.inf, -np.expm1(-np.exp(np.minimum(log_p - threshold, 700.0))), 1.0)
        with np.errstate(divide="ignore"):  # log(1 - exp(-x)) is log(x) where x is small
            log_inclusion = np.where(log_p - threshold < -40, log_p - threshold, np.log(inclusion))
        digests, round_trip = [], []
        for i, a, b in zip(of, cuts[:-1].tolist(), cuts[1:].tolist()):
            digests.append(hashlib.sha256(tokens[a:b]).hexdigest())
            lo, hi = int(starts[a]), int(starts[b])
            round_trip.append(hi - lo == len(written[i]) and decoded.slice(lo, hi - lo).equals(pa.py_buffer(written[i])))
        ranks = [rank for row in found for rank in range(1, len(row.samples) + 1)]
        columns = [ids.take(pa.array(of, pa.int64())), pa.array(ranks, pa.int32()), pa.array(np.diff(cuts), pa.int64()),
                   *(pa.array(x, pa.float64()) for x in (log_p, perturbed)),
                   pa.array(threshold, pa.float64(), mask=threshold == -np.inf),
                   *(pa.array(x, pa.float64()) for x in (inclusion, log_inclusion)),
                   pa.array(digests, pa.string()), pa.array(round_trip, pa.bool_())]
        names = ["doc_id", "rank", "n_tokens", "log_prob", "perturbed", "threshold", "inclusion", "log_inclusion",
                 "ids_sha256", "round_trip"]
        if with_ids:
            columns.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(tokens, pa.int32())))
            names.append("ids")
        if with_text:
            columns.append(pa.array(decoded_texts(lat.pieces, tokens, cuts), pa.string()))
            names.append("decoded")
        return pa.RecordBatch.from_arrays(columns, names)

    schema = (f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, rank int, n_tokens long, log_prob double, "
              "perturbed double, threshold double, inclusion double, log_inclusion double, ids_sha256 string, round_trip boolean")
    return rows.mapInArrow(run, schema + ", ids array<int>" * with_ids + ", decoded string" * with_text)


def decode_ids(rows: DataFrame, model_path: str, ids_col: str = "ids", alpha: float = 1.0) -> DataFrame:
    """``decoded``: the model's text of each row's ids (null for null ids), as the
    SentencePiece library decodes them; a row of ``rows`` per row, that column only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model_path, alpha)
        for batch in slices(batches):
            ids = batch.column(0)
            cuts = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)))
            texts = decoded_texts(pieces, ids.flatten().to_numpy(zero_copy_only=False), cuts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string(), mask=ids.is_null().to_numpy(zero_copy_only=False))], ["decoded"])
    return rows.select(rows[ids_col]).mapInArrow(run, "decoded string")
