"""Removal of long byte strings that occur in an earlier document.

1. Every window of ``length`` bytes belongs to its anchor, the smallest hash of
   a shorter string inside it. Windows in a row with one anchor form a piece.
   Equal windows have equal anchors, wherever they stand.
2. A census finds the anchors that occur in two documents; other pieces cannot
   match anything and go no further.
3. The remaining pieces go to the shard of their anchor, once per block of
   documents with the smallest doc_id that holds them, and equal pieces are
   merged. In each shard external induced sorting (``suffix_sort``) brings
   equal windows of different pieces together and finds for every window the
   first document that holds it.
4. These go back to the blocks, which cut the covered bytes out.

Blocks and shards are sized by the bytes of the table. What travels is one
row per block and shard, so copies in very many documents do not meet as rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ragged, running_hash, span_hash, spread, total_bytes, utf8
from .suffix_sort import sorted_suffixes

LENGTH = 50
#: bytes of the strings that can be anchors, and windows of a piece
ANCHOR_BYTES, PIECE_WINDOWS = 25, 256
BLOCK_BYTES, SHARD_BYTES = 2 << 20, 8 << 20
LEAST_BLOCKS, LEAST_SHARDS = 32, 64
#: bytes of pieces sorted at once; the pieces of one anchor stay together
SORT_BYTES = 1 << 20
_CHUNK = 1 << 17
#: the census compares so many low bytes of an anchor; a chance match only lets a piece through
_CENSUS_BYTES = 5


def window_anchors(data: np.ndarray, length: int) -> np.ndarray:
    """The anchor of the window that starts at each byte."""
    n = len(data) - length + 1
    out = np.empty(max(0, n), np.uint64)
    span = length - ANCHOR_BYTES + 1
    for lo in range(0, n, _CHUNK):
        hi = min(n, lo + _CHUNK)
        part = data[lo:hi + length - 1]
        starts = np.arange(len(part) - ANCHOR_BYTES + 1)
        least, size = span_hash(running_hash(part), starts, starts + ANCHOR_BYTES), 1
        while 2 * size <= span:
            least, size = np.minimum(least[:-size], least[size:]), 2 * size
        if size < span:
            least = np.minimum(least[:len(least) - (span - size)], least[span - size:])
        out[lo:hi] = least
    return out


class Pieces:
    """The pieces of a block of documents: start, windows, anchor, document."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, taking: np.ndarray, length: int):
        n = max(0, len(data) - length + 1)
        anchor = window_anchors(data, length)
        valid = np.ones(n + 1, bool)
        valid[n:] = False
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            valid[max(a, b - length + 1) if taking[i] else a:b] = False
        fresh = valid.copy()
        fresh[1:n] &= ~valid[:n - 1] | (anchor[1:] != anchor[:-1]) if n else False
        starts = np.flatnonzero(fresh)
        stops = np.flatnonzero(valid[:n] & (fresh[1:] | ~valid[1:])) + 1
        parts = -(-(stops - starts) // PIECE_WINDOWS)
        nth = ragged(np.zeros(len(starts), np.int64), parts)
        self.start = np.repeat(starts, parts) + nth * PIECE_WINDOWS
        self.windows = np.minimum(np.repeat(stops, parts) - self.start, PIECE_WINDOWS)
        self.anchor = anchor[self.start]
        self.doc = np.searchsorted(offsets, self.start, "right") - 1
        self.length = length

    def census(self, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchors by shard, their shard, whether two documents of the
        block hold them, and for each piece the place of its anchor."""
        anchors, place = np.unique(self.anchor, return_inverse=True)
        first = np.full(len(anchors), np.iinfo(np.int64).max)
        last = np.full(len(anchors), -1)
        np.minimum.at(first, place, self.doc)
        np.maximum.at(last, place, self.doc)
        shard = (anchors % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return anchors[order], shard[order], (last > first)[order], back[place]


def _table(schema: pa.Schema, **columns) -> pa.Table:
    return pa.table([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def _ids(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column("doc_id").combine_chunks()
    known = np.asarray(ids.is_valid())
    return np.asarray(ids.fill_null(0)).astype(np.int64), known


_PACK = zstandard.ZstdCompressor(level=1)
_UNPACK = zstandard.ZstdDecompressor()


def _packed(*arrays: np.ndarray) -> bytes:
    head = np.array([len(a.tobytes()) for a in arrays], np.int64).tobytes()
    return _PACK.compress(np.int64(len(arrays)).tobytes() + head + b"".join(a.tobytes() for a in arrays))


def _unpacked(blob: bytes, *kinds) -> list[np.ndarray]:
    raw = _UNPACK.decompress(blob)
    sizes = np.frombuffer(raw, np.int64, int(np.frombuffer(raw, np.int64, 1)[0]), 8)
    at, out = 8 + 8 * len(sizes), []
    for size, kind in zip(sizes.tolist(), kinds):
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


_NOTE = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("kind", pa.int32()), ("payload", pa.binary())])
_NOTE_SQL = "shard long, block long, kind int, payload binary"
_SHARED, _FIRSTS = 0, 1
_Key = tuple[pa.Scalar, ...]


def _on_group(method):
    """A bound method as the plain function of key and rows that Spark takes."""
    def run(key: _Key, table: pa.Table) -> pa.Table:
        return method(key, table)
    return run


def _on_pair(method):
    def run(key: _Key, left: pa.Table, right: pa.Table) -> pa.Table:
        return method(key, left, right)
    return run


def anchor_runs(anchor: np.ndarray, size: np.ndarray, rows: np.ndarray, most: int = SORT_BYTES) -> list[np.ndarray]:
    """``rows`` (in the order of their anchors) cut into runs of about ``most``
    bytes; the pieces of one anchor are never parted, and pieces of different
    anchors share no window."""
    if not len(rows):
        return []
    begins = np.flatnonzero(np.insert(anchor[1:] != anchor[:-1], 0, True))
    before = np.cumsum(size) - size
    run = before[begins] // most
    return np.split(rows, begins[np.flatnonzero(run[1:] != run[:-1]) + 1])


class _Deduper:
    """The steps that run inside tasks; it holds numbers only."""

    def __init__(self, length: int, shards: int, in_memory: int):
        self.length, self.shards, self.in_memory = length, shards, in_memory

    def pieces(self, table: pa.Table):
        data, offsets = utf8(table.column("text"))
        ids, known = _ids(table)
        return data, offsets, ids, Pieces(data, offsets, known, self.length)

    def take_census(self, key: _Key, table: pa.Table) -> pa.Table:
        _, _, _, pieces = self.pieces(table)
        anchors, shard, several, _ = pieces.census(self.shards)
        low = (anchors // np.uint64(self.shards)).view(np.uint8).reshape(-1, 8)[:, :_CENSUS_BYTES]
        edges = np.searchsorted(shard, np.arange(self.shards + 1))
        used = np.flatnonzero(np.diff(edges))
        return _table(_NOTE, shard=used, block=np.full(len(used), key[0].as_py()), kind=np.zeros(len(used), np.int32),
                      payload=[np.packbits(several[edges[s]:edges[s + 1]]).tobytes() + low[edges[s]:edges[s + 1]].tobytes()
                               for s in used])

    def close_census(self, key: _Key, table: pa.Table) -> pa.Table:
        """For each block one bit per anchor: does another document hold it?"""
        low, several, sizes = [], [], []
        for blob in table.column("payload").to_pylist():
            n = (len(blob) * 8) // (8 * _CENSUS_BYTES + 1)
            while n + 1 and -(-n // 8) + n * _CENSUS_BYTES != len(blob):
                n -= 1
            bits = np.frombuffer(blob, np.uint8, -(-n // 8))
            several.append(np.unpackbits(bits, count=n).astype(bool))
            wide = np.zeros((n, 8), np.uint8)
            wide[:, :_CENSUS_BYTES] = np.frombuffer(blob, np.uint8, offset=-(-n // 8)).reshape(n, _CENSUS_BYTES)
            low.append(wide.view(np.uint64)[:, 0])
            sizes.append(n)
        values, many = np.concatenate(low), np.concatenate(several)
        _, place, count = np.unique(values, return_inverse=True, return_counts=True)
        shared = count > 1
        shared[place[many]] = True
        parts = np.split(shared[place], np.cumsum(sizes)[:-1])
        return _table(_NOTE, shard=np.full(len(parts), key[0].as_py()), block=table.column("block").to_numpy(),
                      kind=np.full(len(parts), _SHARED, np.int32), payload=[np.packbits(p).tobytes() for p in parts])

    def candidates(self, data: np.ndarray, ids: np.ndarray, pieces: Pieces, notes: pa.Table):
        """The distinct pieces of the block with a shared anchor, by shard: the
        index of one of each, its hash and shard, its smallest doc_id; and which
        pieces these are with the place of each among the distinct ones."""
        anchors, shard, _, place = pieces.census(self.shards)
        shared = np.zeros(len(anchors), bool)
        edges = np.searchsorted(shard, np.arange(self.shards + 1))
        for s, kind, blob in zip(*(notes.column(c).to_pylist() for c in ("shard", "kind", "payload"))):
            if kind == _SHARED:
                lo, hi = edges[s], edges[s + 1]
                shared[lo:hi] = np.unpackbits(np.frombuffer(blob, np.uint8), count=hi - lo)
        chosen = np.flatnonzero(shared[place]) if len(place) else np.zeros(0, np.int64)
        hashes = (span_hash(running_hash(data), pieces.start[chosen],
                            pieces.start[chosen] + pieces.windows[chosen] + self.length - 1)
                  if len(chosen) else np.zeros(0, np.uint64))
        home = shard[place[chosen]] if len(chosen) else np.zeros(0, np.int64)
        order = np.lexsort((ids[pieces.doc[chosen]], hashes, pieces.anchor[chosen], home))
        fresh = np.ones(len(order), bool)
        a, h = pieces.anchor[chosen][order], hashes[order]
        fresh[1:] = (a[1:] != a[:-1]) | (h[1:] != h[:-1])
        distinct = order[fresh]
        nth = np.empty(len(order), np.int64)
        nth[order] = np.cumsum(fresh) - 1
        return chosen[distinct], hashes[distinct], home[distinct], ids[pieces.doc[chosen[distinct]]], chosen, nth

    def send_pieces(self, key: _Key, docs: pa.Table, notes: pa.Table) -> pa.Table:
        data, _, ids, pieces = self.pieces(docs)
        one, hashes, home, first, _, _ = self.candidates(data, ids, pieces, notes)
        edges = np.searchsorted(home, np.arange(self.shards + 1))
        used, blobs = np.flatnonzero(np.diff(edges)), []
        for s in used:
            at = one[edges[s]:edges[s + 1]]
            size = pieces.windows[at] + self.length - 1
            blobs.append(_packed(pieces.anchor[at], hashes[edges[s]:edges[s + 1]], first[edges[s]:edges[s + 1]],
                                 size.astype(np.uint16), data[ragged(pieces.start[at], size)]))
        return _table(_NOTE, shard=used, block=np.full(len(used), key[0].as_py()),
                      kind=np.full(len(used), _FIRSTS, np.int32), payload=blobs)

    def sort_shard(self, key: _Key, table: pa.Table) -> pa.Table:
        """For each block's pieces the first document of every window, as runs."""
        parts = [_unpacked(b, np.uint64, np.uint64, np.int64, np.uint16, np.uint8)
                 for b in table.column("payload").to_pylist()]
        counts = [len(p[0]) for p in parts]
        anchor, hashes, first, size, text = (np.concatenate(x) for x in zip(*parts))
        size = size.astype(np.int64)
        begin = np.cumsum(size) - size
        order = np.lexsort((first, hashes, anchor))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (anchor[order][1:] != anchor[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
        nth = np.empty(len(order), np.int64)
        nth[order] = np.cumsum(fresh) - 1
        one = order[fresh]  # of equal pieces the one with the smallest doc_id
        owner = first[one]
        # a piece alone under its anchor shares no window with another piece
        same = anchor[one][1:] == anchor[one][:-1]
        meets = np.append(same, False) | np.insert(same, 0, False) if len(one) else np.zeros(0, bool)
        sorted_ones = np.flatnonzero(meets)
        found = [self._first_documents(text[ragged(begin[one[part]], size[one[part]])], size[one[part]], owner[part])
                 for part in anchor_runs(anchor[one[sorted_ones]], size[one[sorted_ones]], sorted_ones)]
        runs_of, lengths, docs = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
        n_runs = np.ones(len(one), np.int64)
        n_runs[sorted_ones] = runs_of
        to = np.cumsum(n_runs) - n_runs
        run_length, run_doc = np.empty(int(n_runs.sum()), np.uint16), np.empty(int(n_runs.sum()), np.int64)
        alone = np.flatnonzero(~meets)
        run_length[to[alone]], run_doc[to[alone]] = size[one[alone]] - self.length + 1, owner[alone]
        where = ragged(to[sorted_ones], runs_of)
        run_length[where], run_doc[where] = lengths, docs
        blobs = []
        for mine in np.split(nth, np.cumsum(counts)[:-1]):
            at = ragged(to[mine], n_runs[mine])
            blobs.append(_packed(n_runs[mine].astype(np.uint16), run_length[at], run_doc[at]))
        return _table(_NOTE, shard=np.full(len(blobs), key[0].as_py()), block=table.column("block").to_numpy(),
                      kind=np.full(len(blobs), _FIRSTS, np.int32), payload=blobs)

    def _first_documents(self, text: np.ndarray, size: np.ndarray, owner: np.ndarray):
        """Per piece the number of runs of windows with one first document; the
        runs' lengths and documents."""
        ends = np.cumsum(size)
        offsets = np.concatenate([[0], ends]).astype(np.int64)
        piece = np.repeat(np.arange(len(size)), size + 1)  # by position with end marks
        left = np.repeat(ends + np.arange(len(size)), size + 1) - np.arange(len(piece))
        first = np.full(len(piece), -1, np.int64)
        for position, common in sorted_suffixes(text, offsets, self.length, self.in_memory):
            starts = np.flatnonzero(np.insert(common[1:] < self.length, 0, True))
            least = np.minimum.reduceat(owner[piece[position]], starts)
            first[position] = np.repeat(least, np.diff(np.append(starts, len(position))))
        window = np.flatnonzero(left >= self.length)
        changes = np.ones(len(window), bool)
        p, d = piece[window], first[window]
        changes[1:] = (p[1:] != p[:-1]) | (d[1:] != d[:-1])
        at = np.flatnonzero(changes)
        return (np.bincount(p[at], minlength=len(size)), np.diff(np.append(at, len(window))).astype(np.uint16), d[at])

    def cut(self, key: _Key, docs: pa.Table, notes: pa.Table) -> pa.Table:
        data, offsets, ids, pieces = self.pieces(docs)
        _, _, home, _, chosen, nth = self.candidates(data, ids, pieces, notes)
        change = np.zeros(len(data) + 1, np.int32)
        if len(chosen):
            by_shard = {s: _unpacked(blob, np.uint16, np.uint16, np.int64)
                        for s, kind, blob in zip(*(notes.column(c).to_pylist() for c in ("shard", "kind", "payload")))
                        if kind == _FIRSTS}
            found = [by_shard[s] for s in np.unique(home).tolist()]
            n_runs, length, doc = (np.concatenate(x) for x in zip(*found))
            n_runs, length = n_runs.astype(np.int64), length.astype(np.int64)
            to = np.cumsum(n_runs) - n_runs
            before = np.cumsum(length) - length
            at = ragged(to[nth], n_runs[nth])
            of = np.repeat(np.arange(len(chosen)), n_runs[nth])
            start = pieces.start[chosen][of] + before[at] - before[to[nth]][of]
            gone = doc[at] < ids[pieces.doc[chosen]][of]
            np.add.at(change, start[gone], 1)
            np.add.at(change, (start + length[at] + self.length - 1)[gone], -1)
        covered = np.cumsum(change[:-1]) > 0
        rises = covered.copy()
        rises[1:] &= ~covered[:-1]
        edge = offsets[:-1][offsets[:-1] < len(data)]
        rises[edge] = covered[edge]
        falls = covered.copy()
        falls[:-1] &= ~covered[1:]
        edge = offsets[1:][offsets[1:] > 0] - 1
        falls[edge] = covered[edge]
        begins, ends = np.flatnonzero(rises), np.flatnonzero(falls) + 1
        first_span = np.searchsorted(begins, offsets)
        kept, digests = [], []
        for i in range(len(offsets) - 1):
            a, b = offsets[i], offsets[i + 1]
            rest = data[a:b] if first_span[i] == first_span[i + 1] else data[a:b][~covered[a:b]]
            rest = rest.tobytes()
            digests.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest)
        sums = np.concatenate([[0], np.cumsum(covered)])
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        own = np.repeat(offsets[:-1], np.diff(first_span))
        spans = pa.ListArray.from_arrays(pa.array(first_span.astype(np.int32)), pa.StructArray.from_arrays(
            [pa.array(begins - own), pa.array(ends - own)], fields=list(span)))
        columns = {
            "doc_id": docs.column("doc_id"), "n_bytes": pa.array(np.diff(offsets)),
            "n_removed": pa.array(sums[offsets[1:]] - sums[offsets[:-1]]),
            "n_spans": pa.array(np.diff(first_span)), "kept_sha256": pa.array(digests, pa.string())}
        if "carried" in docs.column_names:
            columns |= {"spans": spans, "kept_text": pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()), "carried": docs.column("carried")}
        return pa.table(columns)


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                   carry: list[str] | None = None, in_memory: int = 1 << 20) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per row of ``docs``; with
    ``carry`` (columns to pass through in the struct ``carried``) also spans (the
    removed byte ranges) and kept_text (the remaining bytes as text, without code
    points that were cut in half).

    A byte goes if a string of ``length`` bytes that covers it also starts in a
    row with a smaller doc_id; matches never cross rows, and strings are judged
    on the input. ``in_memory`` bounds the tuples a sorting queue keeps.

    A null text counts as empty; a text shorter than ``length`` keeps all its
    bytes. A row with a null doc_id takes no part and keeps all its bytes. Rows
    that repeat a doc_id never remove from each other, as neither is smaller;
    each is returned. An empty table gives an empty result. Other columns, also
    such of the same names as these, are ignored.
    """
    spark = docs.sparkSession
    columns = [docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text")]
    if carry is not None:
        columns.append(F.struct(*(docs[c] for c in carry)).alias("carried") if carry else F.struct(F.lit(0).alias("none")).alias("carried"))
    rows = docs.select(*columns)
    size = total_bytes(rows)
    blocks = spread(spark, size, BLOCK_BYTES, LEAST_BLOCKS)
    step = _Deduper(length, spread(spark, size, SHARD_BYTES, LEAST_SHARDS), in_memory)
    blocked = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))
    by_block = blocked.groupBy("block")

    census = by_block.applyInArrow(_on_group(step.take_census), _NOTE_SQL)
    shared = census.groupBy("shard").applyInArrow(_on_group(step.close_census), _NOTE_SQL)
    sent = by_block.cogroup(shared.groupBy("block")).applyInArrow(_on_pair(step.send_pieces), _NOTE_SQL)
    firsts = sent.groupBy("shard").applyInArrow(_on_group(step.sort_shard), _NOTE_SQL)
    out = T.StructType().add("doc_id", "long").add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long") \
        .add("kept_sha256", "string")
    if carry is not None:
        out = out.add("spans", T.ArrayType(T.StructType().add("start", "long").add("end", "long"))).add("kept_text", "string").add(rows.schema["carried"])
    return by_block.cogroup(shared.unionByName(firsts).groupBy("block")).applyInArrow(_on_pair(step.cut), out)
