"""Elias-Fano sequences and n-gram tries in flat arrays that can be memory-mapped."""

from __future__ import annotations

import os

import numpy as np

_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)
#: place of the k-th set bit (from the low end) of every byte value
_NTH = np.zeros((256, 8), np.uint8)
for _b in range(256):
    for _k, _place in enumerate(p for p in range(8) if _b >> p & 1):
        _NTH[_b, _k] = _place
#: probabilities are held as whole numbers of this fraction of a decimal power
STEPS = 1024


def quantised(log_prob: np.ndarray) -> np.ndarray:
    """log10 probabilities in 16 bits, down to 32 decimal powers."""
    return np.clip(np.rint(-log_prob * STEPS), 0, 65535).astype(np.uint16)


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bits of every value, one after another, with 8 spare bytes."""
    out = [np.zeros(0, np.uint8)]
    for lo in range(0, len(values), 1 << 16):  # whole bytes, as these are multiples of 8 values
        part = values[lo:lo + (1 << 16)]
        bits = np.zeros((len(part), width), np.uint8)
        for k in range(width):
            bits[:, k] = (part >> np.uint64(k)) & np.uint64(1)
        out.append(np.packbits(bits.ravel(), bitorder="little"))
    return np.concatenate([*out, np.zeros(8, np.uint8)])


class EliasFano:
    """Non-decreasing numbers: low bits packed, high parts as a unary bitmap
    with a directory of the ones before each 64 bits."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.n, self.width = (int(x) for x in arrays["head"])
        self.low, self.high, self.before = arrays["low"], arrays["high"], arrays["before"]

    @staticmethod
    def arrays(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
        n = len(values)
        width = max(0, int(universe // max(n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        high = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        size = (int(high[-1]) + 1 if n else 0) // 64 + 1
        bitmap = np.zeros(size * 64, np.uint8)
        bitmap[high] = 1
        packed = np.packbits(bitmap, bitorder="little")
        ones = _ONES[packed].reshape(-1, 8).sum(axis=1, dtype=np.int64)
        return {"head": np.array([n, width], np.int64), "low": _packed(values, width), "high": packed,
                "before": np.cumsum(ones) - ones}

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        """The numbers at the given places."""
        word = np.searchsorted(self.before, at, "right") - 1
        left = at - self.before[word]
        held = np.ascontiguousarray(self.high).reshape(-1, 8)[word]
        upto = np.cumsum(_ONES[held], axis=1, dtype=np.int16)
        byte = (upto <= left[:, None]).sum(axis=1)
        lane = np.arange(len(at))
        inside = left - np.where(byte > 0, upto[lane, byte - 1], 0)
        high = word * 64 + byte * 8 + _NTH[held[lane, byte], inside] - at
        if self.width == 0:
            return high.astype(np.int64)
        return (high << self.width) | self._low(at)

    def _low(self, at: np.ndarray) -> np.ndarray:
        bit = at * self.width
        unaligned = np.ndarray((len(self.low) - 7,), "<u8", np.ascontiguousarray(self.low), strides=(1,))
        low = (unaligned[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.width) - 1)
        return low.astype(np.int64)

    def read(self, wanted: int) -> "EliasFano | np.ndarray":
        """For so many lookups: all numbers in one scan, if they are a good part of them, or else this."""
        if 8 * wanted < self.n:
            return self
        every = np.arange(self.n)
        high = np.flatnonzero(np.unpackbits(self.high, bitorder="little")) - every
        return high if self.width == 0 else (high << self.width) | self._low(every)


def _levels(grams: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per level: parent of each node, its word, and the level's node of every gram."""
    out, node = [], np.zeros(len(grams[0]), np.int64)
    for words in grams:
        new = np.ones(len(words), bool)
        new[1:] = (node[1:] != node[:-1]) | (words[1:] != words[:-1])
        first = np.flatnonzero(new)
        out.append((node[first], words[first], np.cumsum(new) - 1))
        node = np.cumsum(new) - 1
    return out


def trie_arrays(grams: list[np.ndarray], log_prob: np.ndarray | None, counts: np.ndarray) -> dict[str, np.ndarray]:
    """A trie of sorted distinct n-grams (one array of word ids per place).

    A level holds its words by parent, each raised by parent times the id
    bound, which makes the level monotone, and the monotone pointers to each
    parent's first child; the last level also the quantised probability (if
    there are any) and the running sum of the counts.
    """
    bound = 1 + max((int(g.max(initial=0)) for g in grams))
    out = {"bound": np.array([bound], np.int64)}
    parents = 1
    for k, (parent, words, _) in enumerate(_levels(grams)):
        pointers = np.concatenate([[0], np.cumsum(np.bincount(parent, minlength=parents))])
        parts = {"words": EliasFano.arrays(parent * bound + words, parents * bound),
                 "pointers": EliasFano.arrays(pointers, len(words) + 1)}
        out |= {f"{k}.{name}.{x}": a for name, arrays in parts.items() for x, a in arrays.items()}
        parents = len(words)
    sums = np.concatenate([[0], np.cumsum(counts)])
    if log_prob is not None:
        out["steps"] = quantised(log_prob)
    return out | {f"counts.{x}": a for x, a in EliasFano.arrays(sums, int(sums[-1]) + 1).items()}


class Trie:
    """Looks n-grams up in the arrays of ``trie_arrays``."""

    def __init__(self, arrays: dict[str, np.ndarray], order: int):
        def sequence(name: str) -> EliasFano:
            return EliasFano({x: arrays[f"{name}.{x}"] for x in ("head", "low", "high", "before")})
        self.bound = int(arrays["bound"][0])
        self.levels = [(sequence(f"{k}.words"), sequence(f"{k}.pointers")) for k in range(order)]
        self.steps, self.counts = arrays.get("steps"), sequence("counts")

    @classmethod
    def mapped(cls, arrays: dict[str, np.ndarray], order: int, folder: str) -> "Trie":
        """The arrays written to files of a folder and memory-mapped from there."""
        for name, array in arrays.items():
            np.save(os.path.join(folder, name + ".npy"), array)
        return cls({name: np.load(os.path.join(folder, name + ".npy"), mmap_mode="r") for name in arrays}, order)

    def find(self, grams: list[np.ndarray]) -> np.ndarray:
        """The leaf of each n-gram, -1 where there is none; the n-grams are
        sorted, so every distinct context is looked up once. Within the range
        of successors that its context points to, a word is found by halving."""
        node = np.zeros(1, np.int64)  # nodes of the distinct contexts of one level
        for level, (parent, word, _) in zip(self.levels, _levels(grams)):
            words, pointers = (sequence.read(len(word)) for sequence in level)
            above = node[parent]
            known = np.flatnonzero((above >= 0) & (word < self.bound))
            lo, end = pointers[above[known]], pointers[above[known] + 1]
            wanted = above[known] * self.bound + word[known]
            if isinstance(words, np.ndarray):  # read whole: the level is in order over all parents
                lo = np.maximum(lo, np.searchsorted(words, wanted))
                open_ = np.zeros(0, np.int64)
            else:
                hi = end.copy()
                open_ = np.flatnonzero(lo < hi)
            while len(open_):
                middle = (lo[open_] + hi[open_]) >> 1
                less = words[middle] < wanted[open_]
                lo[open_[less]] = middle[less] + 1
                hi[open_[~less]] = middle[~less]
                open_ = open_[lo[open_] < hi[open_]]
            inside = np.flatnonzero(lo < end)
            there = inside[words[lo[inside]] == wanted[inside]]
            node = np.full(len(word), -1, np.int64)
            node[known[there]] = lo[there]
        return node

    def log_prob(self, leaf: np.ndarray) -> np.ndarray:
        return -self.steps[leaf].astype(np.float64) / STEPS

    def count(self, leaf: np.ndarray) -> np.ndarray:
        sums = self.counts.read(len(leaf))
        return sums[leaf + 1] - sums[leaf]
