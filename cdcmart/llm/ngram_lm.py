"""N-gram language model of a corpus, and the score of every text under it.

The model is interpolated from order to order: with the counts c of the texts
learned from, a context h, and h' without its first word,

    P(w | h) = (c(h w) + m * P(w | h')) / (c(h) + m),      m = WEIGHT[order]

down to P(w) = (c(w) + 1) / (N + V + 1), so it sums to one over all words and
one unknown word. Texts start after start marks and close with one end token.

Every table row of the work is a block: some megabytes of whole texts, as
numbers of the block's distinct words. Per order the distinct n-grams of each
block go, packed, to shards; a shard adds up the counts of all blocks, builds an
Elias-Fano trie of what was learned (see ``elias_fano``), memory-mapped from the
task's own folder, looks up every n-gram asked for, and answers the blocks. The
answer is the count alone: a block knows all else that a probability is made of.
For the last order it builds such a trie with 16-bit probabilities of what its
texts need, and looks them up there. The answer also says whether any other
block holds the n-gram. If none does, the longer n-grams with it are in no other
block either, and the block asks no shard for them. Copies of a frequent n-gram
are added up in the blocks. N-grams are spread by their context,
so that what is sent of a context is sent once, and those of a frequent context
by the last word too, in as many lanes as its count asks for, so neither a
frequent word nor a frequent context can fill a shard.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import mix, released, released_table, row_chunks, running_hash, span_hash, total_bytes, utf8
from .elias_fano import STEPS, Trie, quantised, trie_arrays

BLOCK_BYTES, SHARD_BYTES, BUCKET_BYTES = 4 << 20, 8 << 20, 32 << 20
#: Spark's own bound for a table's buckets
MOST_BUCKETS = 100_000
#: a context goes to one more shard for each so many of its occurrences
LANE_PLACES = 1024
#: how many observations the shorter context's estimate is worth, by order
WEIGHT = {2: 1000.0, 3: 50.0}
START, END, UNKNOWN = 0, 1, -1


def pack(arrays: dict[str, np.ndarray]) -> bytes:
    """Arrays by byte planes, compressed."""
    head = json.dumps([[k, a.dtype.str, len(a)] for k, a in arrays.items()]).encode()
    planes = [np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T).tobytes()
              for a in arrays.values()]
    return zstandard.ZstdCompressor(level=1).compress(len(head).to_bytes(4, "little") + head + b"".join(planes))


def unpack(data: bytes) -> dict[str, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    at = 4 + int.from_bytes(raw[:4], "little")
    out = {}
    for name, kind, n in json.loads(raw[4:at]):
        size = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n)
        out[name] = np.ascontiguousarray(planes.T).view(kind).reshape(n)
        at += n * size
    return out


# --------------------------------------------------------------------------- blocks

_BLOCK = ("block long, doc_id array<bigint>, train array<boolean>, tokens binary, words binary, times binary, "
          "learned long, docs_learned long, places long")


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of some texts, and how many each text has."""
    small = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    blank = (small == 32) | ((small >= 9) & (small <= 13))
    first = ~blank
    first[1:] &= blank[:-1]
    begins = offsets[:-1][(offsets[:-1] < len(data)) & (np.diff(offsets) > 0)]
    first[begins] |= ~blank[begins]
    letters = small[~blank]
    starts = np.flatnonzero(first[~blank])
    ends = np.concatenate([starts, [len(letters)]]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(letters.tobytes())])
    seen = np.concatenate([[0], np.cumsum(first)])
    return words, np.diff(seen[offsets])


def _blocks(shards: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for lo, hi in row_chunks(offsets, BLOCK_BYTES):
                words, sizes = _words(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                coded = words.dictionary_encode()
                held, index = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                order = pc.sort_indices(held).to_numpy().astype(np.int64)
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order))
                index = place[index]
                train = np.array(batch.column("train").slice(lo, hi - lo).to_pylist(), bool)
                learned = np.repeat(train, sizes)
                times = np.bincount(index[learned], minlength=len(order))
                sent = held.take(pa.array(order)).to_pylist()
                blob = b"\n".join(sent)
                ends = np.cumsum([len(w) + 1 for w in sent], dtype=np.int64)
                starts = np.concatenate([[0], ends])[:-1]
                shard = span_hash(running_hash(np.frombuffer(blob, np.uint8)), starts, ends - 1) % np.uint64(shards)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.array([batch.column("doc_id").slice(lo, hi - lo).to_pylist()], pa.list_(pa.int64())),
                     pa.array([train.tolist()], pa.list_(pa.bool_())),
                     pa.array([pack({"index": index.astype(np.uint32), "sizes": sizes.astype(np.uint32)})], pa.binary()),
                     pa.array([zstandard.ZstdCompressor(level=3).compress(blob)], pa.binary()),
                     pa.array([pack({"times": times.astype(np.uint64), "shard": shard.astype(np.uint32)})], pa.binary()),
                     pa.array([int(learned.sum())], pa.int64()), pa.array([int(train.sum())], pa.int64()),
                     pa.array([len(index)], pa.int64())],
                    [f.split()[0] for f in _BLOCK.split(", ")])
                number += 1
    return cut


# --------------------------------------------------------------------------- words

def _ask_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, words, times in zip(*(batch.column(c).to_pylist() for c in ("block", "words", "times"))):
            held, count = zstandard.ZstdDecompressor().decompress(words).split(b"\n"), unpack(times)
            for s in np.unique(count["shard"]).tolist():
                mine = np.flatnonzero(count["shard"] == s)
                sent = zstandard.ZstdCompressor(level=1).compress(b"\n".join([held[i] for i in mine.tolist()]))
                yield _row(["shard", "block", "words", "asked"], [s, block, sent, pack({"times": count["times"][mine]})])


def _row(names: list[str], values: list) -> pa.RecordBatch:
    kinds = {"words": pa.binary(), "asked": pa.binary(), "answer": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([v], kinds.get(n, pa.int64())) for n, v in zip(names, values)], names)


_ANSWER = "block long, shard long, answer binary, known long"


def _answers(blocks: list, shard: int, answers: list[bytes | None], known: list) -> pa.Table:
    return pa.table([pa.array(blocks, pa.int64()), pa.array([shard] * len(blocks), pa.int64()),
                     pa.array(answers, pa.binary()), pa.array(known, pa.int64())], ["block", "shard", "answer", "known"])


def _count_words(shards: int):
    """Ids by falling count, different in all shards, and counts; the last row
    has the number of words learned."""
    def count(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        asked = [unpack(a) for a in table.column("asked").to_pylist()]
        held = [zstandard.ZstdDecompressor().decompress(w).split(b"\n") for w in table.column("words").to_pylist()]
        coded = pa.chunked_array([pa.array(h, pa.binary()) for h in held]).combine_chunks().dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        counts = np.zeros(len(coded.dictionary), np.int64)
        np.add.at(counts, index, np.concatenate([a["times"] for a in asked]).astype(np.int64))
        by_word = pc.sort_indices(coded.dictionary).to_numpy().astype(np.int64)
        order = by_word[np.argsort(-counts[by_word], kind="stable")]
        ids = np.empty(len(order), np.int64)
        ids[order] = np.arange(len(order)) * shards + key[0].as_py() + 2
        ids[counts == 0] = UNKNOWN
        alone = np.bincount(index, minlength=len(ids)) == 1  # a block asks once for a word
        out, at = [], 0
        for a in asked:
            mine = index[at:at + len(a["times"])]
            at += len(mine)
            out.append(pack({"ids": ids[mine], "counts": counts[mine].astype(np.uint64), "alone": alone[mine].astype(np.uint8)}))
        blocks = table.column("block").to_pylist()
        return _answers([*blocks, None], key[0].as_py(), [*out, None], [None] * len(blocks) + [int((counts > 0).sum())])
    return count


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time: with its answers, that of a block has many parts."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield from batch.slice(k, 1).to_pylist()


def _by_shard(shard: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of every shard, in order, one shard after another, and where each begins."""
    kind = np.uint16 if shards <= 1 << 16 else np.uint32
    return np.argsort(shard.astype(kind), kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(shard, minlength=shards))])


_STATE = "block long, doc_id array<bigint>, train array<boolean>, state binary"


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks with their words numbered in the order of the ids, unknown
    words last; frequent words thus have small numbers, and no text is needed."""
    for row in _each(batches):
        stored, shard = unpack(row["tokens"]), unpack(row["times"])["shard"]
        ids, counts, alone = np.full(len(shard), UNKNOWN, np.int64), np.zeros(len(shard), np.uint64), np.zeros(len(shard), np.uint8)
        places, cuts = _by_shard(shard, int(shard.max(initial=0)) + 1)
        for a in row["answers"] or []:
            at, part = places[cuts[a["shard"]]:cuts[a["shard"] + 1]], unpack(a["answer"])
            ids[at], counts[at], alone[at] = part["ids"], part["counts"], part["alone"]
        order = np.lexsort((ids, ids == UNKNOWN))
        number = np.empty(len(order), np.uint32)
        number[order] = np.arange(len(order))
        known = order[:np.count_nonzero(ids != UNKNOWN)]
        state = pack({"index": number[stored["index"]], "sizes": stored["sizes"], "alone": alone[order],
                      "ids": np.diff(ids[known], prepend=0).astype(np.uint64), "counts": counts[known]})
        yield pa.RecordBatch.from_arrays(
            [pa.array([row["block"]], pa.int64()), pa.array([row["doc_id"]], pa.list_(pa.int64())),
             pa.array([row["train"]], pa.list_(pa.bool_())), pa.array([state], pa.binary())],
            [f.split()[0] for f in _STATE.split(", ")])


# --------------------------------------------------------------------------- n-grams

class _Corpus:
    """What every task knows: tokens, words and texts learned, the weights by
    order, and how many learned occurrences of a context go to one shard."""

    def __init__(self, tokens: int, words: int, texts: int, weights: dict[int, float], lane: int = LANE_PLACES):
        self.tokens, self.words, self.texts, self.weights, self.lane = tokens, words, texts, weights, lane

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1.0) / (self.tokens + self.words + 1.0))


class _Block:
    """A block's texts as one sequence: per text its start marks, its words
    and the end; with the state of one order at every place."""

    def __init__(self, state: bytes, train: list[bool], corpus: _Corpus, order: int, shards: int):
        stored = unpack(state)
        index, sizes = stored["index"].astype(np.int64), stored["sizes"].astype(np.int64)
        alone, known = stored["alone"] > 0, len(stored["ids"])
        ids, counts = np.full(len(alone), UNKNOWN, np.int64), np.zeros(len(alone), np.int64)
        ids[:known], counts[:known] = np.cumsum(stored["ids"].astype(np.int64)), stored["counts"].astype(np.int64)
        pad = order - 1
        length = sizes + pad + 1
        starts = np.cumsum(length) - length
        total = int(length.sum())
        self.doc = np.repeat(np.arange(len(sizes)), length)
        self.scored = np.ones(total, bool)
        for k in range(pad):
            self.scored[starts + k] = False
        word = self.scored.copy()
        word[starts + length - 1] = False
        self.ids, self.count = np.full(total, START, np.int64), np.full(total, corpus.texts, np.int64)
        self.ids[starts + length - 1] = END
        self.ids[word], self.count[word] = ids[index], counts[index]
        # the block's own numbers, in the order of the ids; unknown words come last, each for itself
        self.word = self.ids.copy()
        self.word[word] = index + 2
        self.alone = np.zeros(total, bool)  # no other block has the n-gram that ends here
        self.alone[word] = alone[index]
        self.sizes = sizes + 1
        self.train = np.array(train, bool)[self.doc] if len(sizes) else np.zeros(0, bool)
        self.base = np.where(self.scored, corpus.base(self.count), 0.0)
        self.known = self.scored & (self.count > 0)
        self.log_prob = self.base.copy()
        self.rank = np.where(self.scored, self.word, -1)
        self.clear = self.ids != UNKNOWN  # no unknown word in the n-gram that ends here
        self.weights, self.lane, self.level, self.shards = corpus.weights, corpus.lane, 1, shards

    def step(self) -> None:
        """Take up the n-grams one longer: their context counts, ranks, distinct ones."""
        self.level += 1
        before = np.concatenate([[0], np.arange(len(self.ids) - 1)])
        self.context = np.where(self.scored, self.count[before], 0)
        self.clear &= self.clear[before]
        key = (self.rank[before] + 1 << 32) | self.word
        at = np.flatnonzero(self.scored)
        first, inverse = _distinct(key[at])
        rank = np.full(len(self.ids), -1, np.int64)
        rank[at] = inverse
        self.rank, self.first, self.at, self.inverse = rank, at[first], at, inverse
        # unseen until the shards answer; without a known context the shorter one decides alone
        weight = self.weights[self.level]
        self.lower = self.log_prob
        seen = self.context > 0
        self.log_prob = np.where(seen, self.lower + np.log10(weight / (self.context + weight)), self.lower)
        self.alone = self.scored & (self.alone | self.alone[before])
        wanted = self.clear[self.first] & seen[self.first]
        self.own = np.flatnonzero(wanted & self.alone[self.first])
        self.asks = np.flatnonzero(wanted & ~self.alone[self.first])
        self.times = np.bincount(inverse, weights=self.train[at], minlength=len(first)).astype(np.int64)
        grams = self.grams(self.asks)
        code = np.zeros(len(self.asks), np.uint64)
        for g in grams[:-1]:
            code = mix(code * np.uint64(31) + g.astype(np.uint64) + np.uint64(1))
        lanes = (1 + self.context[self.first[self.asks]] // self.lane).astype(np.uint64)
        code = mix(code * np.uint64(31) + mix(grams[-1].astype(np.uint64)) % lanes)
        self.by_shard, self.cuts = _by_shard((code % np.uint64(self.shards)).astype(np.int64), self.shards)

    def grams(self, which: np.ndarray) -> list[np.ndarray]:
        """The words of some of the distinct n-grams."""
        place = self.first[which]
        return [self.ids[place - self.level + 1 + k] for k in range(self.level)]

    def absorb(self, answers: list[dict], last: bool = False) -> None:
        """Take the shards' answers, then what is known of every distinct
        n-gram to all its places; for the last order from a trie."""
        total, alone = self.times.copy(), self.alone[self.first]
        for part in answers:
            mine = self.asks[self.by_shard[self.cuts[part["shard"]]:self.cuts[part["shard"] + 1]]]
            total[mine] += part["others"].astype(np.int64)
            alone[mine] = part["alone"] > 0
        counts, log_prob = np.zeros(len(self.first), np.int64), self.log_prob[self.first]
        known = np.sort(np.concatenate([self.own, self.asks]))
        place = self.first[known]
        smooth = _smoothed(total[known], self.context[place], quantised(self.lower[place]), self.weights[self.level])
        if last:
            grams, total = self.grams(known), total[known]
            # what only longer n-grams would need goes before the trie is made
            del place, counts, alone, self.ids, self.word, self.rank, self.clear, self.lower, self.context, self.count, self.alone
            log_prob[known] = _looked_up(grams, total, smooth)[1]
        else:
            rounded = total > 0  # as tries hold them; what a shard was asked for, also if it was not learned
            rounded[self.asks] = True
            counts[known] = total[known]
            log_prob[known] = np.where(rounded[known], -quantised(smooth).astype(np.float64) / STEPS, smooth)
        self.log_prob[self.at] = log_prob[self.inverse]
        if last:
            return
        self.alone[self.at] = alone[self.inverse]
        self.count = self.count.copy()
        self.count[self.at] = counts[self.inverse]

    def per_doc(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.doc, weights=values, minlength=len(self.sizes))


def _differences(grams: list[np.ndarray]) -> list[np.ndarray]:
    """Sorted n-grams, every word as the difference from the row above where
    all words before it are the same."""
    out, same = [], np.ones(len(grams[0]), bool)
    for g in grams:
        out.append(np.where(same, np.diff(g, prepend=0), g))
        same &= out[-1] == 0
    return out


def _from_differences(differences: list[np.ndarray]) -> list[np.ndarray]:
    out, same = [], np.ones(len(differences[0]), bool)
    for d in differences:
        begins = ~same
        begins[:1] = True
        run = np.maximum.accumulate(np.where(begins, np.arange(len(d)), 0))
        upto = np.cumsum(d)
        out.append(upto - (upto - d)[run])
        same &= d == 0
    return out


_ASK = "shard long, block long, asked binary"


def _at_level(row: dict, level: int, order: int, shards: int, corpus: _Corpus) -> _Block:
    """A block that has taken up the n-grams of a level, with all shorter ones answered."""
    block = _Block(row["state"], row["train"], corpus, order, shards)
    block.step()
    while block.level < level:
        block.absorb(_parts(row, block.level))
        block.step()
    return block


def _parts(row: dict, level: int) -> list[dict]:
    return [unpack(a["answer"]) | {"shard": a["shard"]} for a in row[f"answers_{level}"] or []]


def _ask_grams(level: int, order: int, shards: int, corpus: _Corpus):
    """The distinct n-grams of every block to their shards."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            yield from _asked(row["block"], _at_level(row, level, order, shards, corpus))
    return ask


def _asked(number: int, block: _Block) -> Iterator[pa.RecordBatch]:
    grams, times = block.grams(block.asks), block.times[block.asks].astype(np.uint32)
    for s in np.flatnonzero(np.diff(block.cuts)).tolist():
        mine = block.by_shard[block.cuts[s]:block.cuts[s + 1]]
        part = {f"g{k}": d.astype(np.uint64) for k, d in enumerate(_differences([g[mine] for g in grams]))}
        yield _row(["shard", "block", "asked"], [s, number, pack(part | {"times": times[mine]})])


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A row of every distinct key, in order, and each row's key."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    inverse = np.empty(len(keys), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return order[new], inverse


def _merge(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct n-grams in order, a row of each, and each row's n-gram."""
    inverse = np.zeros(len(columns[0]), np.int64)
    first = np.zeros(0, np.int64)
    for c in columns:
        if int(c.max(initial=0)) >> 32:  # by rank, where the ids are wider
            c = np.unique(c, return_inverse=True)[1]
        first, inverse = _distinct((inverse << 32) | c)
    return [c[first] for c in columns], first, inverse


def _smoothed(counts: np.ndarray, context: np.ndarray, lower: np.ndarray, weight: float) -> np.ndarray:
    """Log probabilities from counts, context counts and shorter estimates."""
    context, lower, out = context.astype(np.float64), -lower.astype(np.float64) / STEPS, np.empty(len(counts))
    seen = counts > 0
    out[~seen] = lower[~seen] + np.log10(weight / (context[~seen] + weight))
    out[seen] = np.log10((counts[seen] + weight * 10.0 ** lower[seen]) / (context[seen] + weight))
    return out


def _looked_up(grams: list[np.ndarray], counts: np.ndarray, log_prob: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """What a trie of the n-grams learned, of sorted distinct ones, says of each
    of them: counts and log probabilities, if it is given any."""
    learned = np.flatnonzero(counts)
    found, found_prob = np.zeros(len(counts), np.int64), None if log_prob is None else log_prob.copy()
    if len(learned):
        arrays = trie_arrays([g[learned] for g in grams], None if log_prob is None else log_prob[learned], counts[learned])
        with tempfile.TemporaryDirectory(prefix="ngrams-") as folder:  # the task's own, gone with it
            trie = Trie.mapped(arrays, len(grams), folder)
            leaf = trie.find(grams)
            there = np.flatnonzero(leaf >= 0)
            found[there] = trie.count(leaf[there])
            if log_prob is not None:
                found_prob[there] = trie.log_prob(leaf[there])
            del trie
    return found, found_prob


def _answer_grams(level: int):
    def answer(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        asked = [unpack(a) for a in table.column("asked").to_pylist()]
        read = [_from_differences([a[f"g{k}"].astype(np.int64) for k in range(level)]) for a in asked]
        grams, first, inverse = _merge([np.concatenate([r[k] for r in read]) for k in range(level)])
        total = np.bincount(inverse, weights=np.concatenate([a["times"] for a in asked]), minlength=len(first)).astype(np.int64)
        counts, _ = _looked_up(grams, total)
        alone, out, at = np.bincount(inverse, minlength=len(first)) == 1, [], 0  # a block asks once for an n-gram
        for a in asked:
            mine = inverse[at:at + len(a["times"])]
            at += len(mine)
            out.append(pack({"others": (counts[mine] - a["times"]).astype(np.uint64), "alone": alone[mine].astype(np.uint8)}))
        return _answers(table.column("block").to_pylist(), key[0].as_py(), out, [None] * len(out))
    return answer


_SCORED = "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double"


def _score(order: int, shards: int, corpus: _Corpus):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            block = _at_level(row, order, order, shards, corpus)
            block.absorb(_parts(row, order), last=True)
            values = [block.sizes, block.per_doc(block.known).astype(np.int64), block.per_doc(block.base), block.per_doc(block.log_prob)]
            del block  # before the next one
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_id"], pa.int64()), pa.array(row["train"], pa.bool_()), *map(pa.array, values)],
                [f.split()[0] for f in _SCORED.split(", ")])
    return score


def score_corpus(docs: DataFrame, train: Column, order: int = 3, id_col: str = "doc_id", text_col: str = "text",
                 weights: dict[int, float] = WEIGHT, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, train, n_tokens, n_known, train_tokens, base_score, score per row
    of ``docs``, under a model learned from the rows where ``train`` holds.

    ``base_score`` and ``score`` are log10 probabilities of the whole text by
    single words and by the model of the given order. All n-grams of all rows
    to learn from count; none is dropped.

    A null or empty text is one end token. Where ``train`` is null the row is
    not learned from. Repeated rows are learned from and answered each; a null
    doc_id is kept; an empty table gives an empty result; with nothing to
    learn from every token has probability one. Other columns are ignored. A
    long text is a block of its own.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"),
                       F.coalesce(train, F.lit(False)).alias("train"))
    size = total_bytes(rows)
    shards, buckets = max(1, -(-size // shard_bytes)), max(1, min(MOST_BUCKETS, size // BUCKET_BYTES))
    spark, tables = docs.sparkSession, []

    def bucketed(df: DataFrame, name: str) -> DataFrame:
        """Bucketed by block, so that no row moves to meet its block again."""
        table = f"ngram_{name}_{uuid.uuid4().hex}"
        tables.append(table)
        with released(spark):
            df.write.bucketBy(buckets, "block").saveAsTable(table, format="parquet")
        return spark.table(table)

    def answered(df: DataFrame, name: str) -> DataFrame:
        """One row a block; the words learned are in a row without block."""
        part = F.when(F.col("block").isNotNull(), F.struct("shard", "answer"))
        return bucketed(df.repartition(buckets, "block").groupBy("block")
                        .agg(F.collect_list(part).alias(name), F.sum("known").alias("known")), name)

    try:
        blocks = bucketed(rows.mapInArrow(_blocks(shards), _BLOCK), "blocks")
        words = answered(blocks.select("block", "words", "times")
                         .mapInArrow(_ask_words, "shard long, block long, words binary, asked binary")
                         .repartition(shards, "shard").groupBy("shard").applyInArrow(_count_words(shards), _ANSWER), "answers")
        texts, tokens, places = (int(n or 0) for n in blocks.agg(F.sum("docs_learned"), F.sum("learned"), F.sum("places")).first())
        n_words = int(words.agg(F.sum("known")).first()[0] or 0)
        # where few texts are learned from, a context that is asked for often has a small count
        lane = max(1, LANE_PLACES * tokens // max(1, places))
        corpus = _Corpus(tokens + texts, n_words + (texts > 0), texts, weights, lane)
        held = bucketed(blocks.select("block", "doc_id", "train", "tokens", "times").join(words.select("block", "answers"), "block", "left")
                        .mapInArrow(_settle, _STATE), "state")
        while len(tables) > 1:  # the texts of the words, and their answers
            spark.sql(f"DROP TABLE {tables.pop(0)}")
        for level in range(2, order + 1):
            asked = held.drop("doc_id").mapInArrow(_ask_grams(level, order, shards, corpus), _ASK)
            more = answered(asked.repartition(shards, "shard").groupBy("shard").applyInArrow(_answer_grams(level), _ANSWER), f"answers_{level}")
            held = held.join(more.drop("known"), "block", "left")
        scored = released_table(held.mapInArrow(_score(order, shards, corpus), _SCORED), "scored")
    finally:
        for table in tables:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
    return scored.withColumn("train_tokens", F.lit(corpus.tokens).cast("long"))
