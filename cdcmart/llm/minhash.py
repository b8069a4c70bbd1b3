"""Near-duplicate components: one-permutation MinHash, banded buckets, star edges.

1. Every text becomes its set of 5-word shingles (64-bit hashes). Texts with
   equal sets are one node, so exact copies cost nothing further.
2. A node's signature comes from one permutation: the hash range is cut into
   bins, each holds its smallest hash, and an empty bin takes the value of a
   bin found by its own random sequence (optimal densification). Bands of the
   signature are bucket keys.
3. In each bucket every node meets the bucket's centre only (a star), never
   every other node. The pairs are confirmed on the full shingle sets.
4. A node left outside the largest component of one of its buckets meets the
   nodes of that bucket's other components too, so no bucketed pair between
   two components goes unchecked. Such a pair goes on to the full sets only if
   the odd sketches of both sets differ in no more bits than linked sets may
   differ in shingles. Buckets are cut into blocks of bounded size whose pairs
   are compared in numpy; of a large bucket, a node goes first that has too
   many shingles that no other node of a large bucket has, as for a template
   around texts of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, mix, ragged, row_chunks, running_hash, scratch_table, slices, span_hash, text_rows, utf8
from .components import connected_components

WORDS = 5
BANDS, ROWS = 25, 4
#: sets up to this size get exact keys besides the bands (see ``band_keys``)
SMALL = 13
SKETCH_LONGS = 32
#: nodes of a bucket that meet in one group of a task (so many on either side), and pairs that are compared at once
BLOCK, PAIRS = 4096, 1 << 15
#: buckets with more nodes are rid of those that link with none before they are paired
WIDE = 256
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint8)
_STEP = [np.uint64(pow(0xD1342543DE82EF95, i, 1 << 64)) for i in range(WORDS)]
_SHORT = np.uint64(0xA0761D6478BD642F)
_DROPPED = np.uint64(0xE7037ED1A0B428DB)
_RNG = np.random.default_rng(7)
_BINS = BANDS * ROWS
#: for each bin the order in which it looks for a bin with a value
_PROBES = np.array([_RNG.permutation(_BINS) for _ in range(_BINS)])
_BAND_STEP = _RNG.integers(1, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its shingles: runs of five words
    (a word is a run of bytes other than 20 and 09 to 0D, with A-Z lower-cased),
    the whole sequence if there are fewer words, none without words."""
    out: list[np.ndarray] = []
    for lo, hi in row_chunks(offsets, CHUNK_BYTES):
        own = _LOWER[data[offsets[lo]:offsets[hi]]]
        edges = offsets[lo:hi + 1] - offsets[lo]
        word = ~_SPACE[own]
        begin, end = word.copy(), word.copy()
        begin[1:] &= ~word[:-1]
        end[:-1] &= ~word[1:]
        first = edges[:-1][edges[:-1] < edges[1:]]
        last = edges[1:][edges[:-1] < edges[1:]] - 1
        begin[first] |= word[first]
        end[last] |= word[last]
        starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
        hashes = span_hash(running_hash(own), starts, ends) if len(starts) else np.zeros(0, np.uint64)
        cut = np.searchsorted(starts, edges)
        n = max(0, len(hashes) - WORDS + 1)
        full = np.zeros(n, np.uint64)
        for i, step in enumerate(_STEP):
            full += hashes[i:i + n] * step
        full = mix(full)
        for a, b in zip(cut[:-1], cut[1:]):
            if b - a >= WORDS:
                out.append(np.unique(full[a:b - WORDS + 1]))
            elif b > a:
                whole = sum((hashes[a + i:a + i + 1] * _STEP[i] for i in range(b - a)), np.zeros(1, np.uint64))
                out.append(mix(whole + np.full(1, b - a, np.uint64) * _SHORT))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def signature(hashes: np.ndarray) -> np.ndarray:
    """One value per bin from a sorted, non-empty set of hashes."""
    bins = ((hashes >> np.uint64(32)) * np.uint64(_BINS)) >> np.uint64(32)
    filled, at = np.unique(bins, return_index=True)  # sorted hashes: the first of a bin is its smallest
    values = np.zeros(_BINS, np.uint64)
    has = np.zeros(_BINS, bool)
    values[filled], has[filled] = hashes[at], True
    if len(filled) < _BINS:
        empty = np.flatnonzero(~has)
        probes = _PROBES[empty]
        values[empty] = values[probes[np.arange(len(empty)), has[probes].argmax(axis=1)]]
    return values


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """Bucket keys of a non-empty set. Sets of up to 13 shingles that link
    either are equal or differ by one shingle that one of them lacks, so the
    set and each set without one shingle as keys find all of their links."""
    bands = signature(hashes).reshape(BANDS, ROWS)
    keys = mix((bands * _BAND_STEP).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * _SHORT)
    if len(hashes) <= SMALL + 1:
        each = mix(hashes)
        total = each.sum(dtype=np.uint64, keepdims=True)
        less = total - each if len(hashes) > 1 else each[:0]  # the empty set is no key
        keys = np.concatenate([keys, mix(np.concatenate([less, total]) ^ _DROPPED)])
    return np.unique(keys)


def odd_sketch(hashes: np.ndarray) -> np.ndarray:
    """2048 bits, each the parity of the shingles that fall on it. As one
    shingle flips one bit, two sketches differ in at most as many bits as the
    sets differ in shingles."""
    bits = np.bincount(((hashes * _BAND_STEP[0]) >> np.uint64(53)).astype(np.int64), minlength=64 * SKETCH_LONGS) & 1
    return np.packbits(bits.astype(bool)).view(np.uint64)


def _as_lists(parts: list[np.ndarray]) -> pa.Array:
    sizes = np.fromiter((len(p) for p in parts), np.int64, len(parts))
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.uint64).view(np.int64)))


def _identity(s: np.ndarray) -> int:
    """One 64-bit number per set."""
    total = mix(s).sum(dtype=np.uint64, keepdims=True) + np.full(1, len(s), np.uint64) * _SHORT
    return int(mix(total).view(np.int64)[0])


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    none = np.zeros(0, np.uint64)
    for batch in slices(batches):
        sets = shingle_sets(*utf8(batch.column("text")))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([_identity(s) for s in sets], pa.int64()),
             _as_lists([band_keys(s) if len(s) else none for s in sets]),
             _as_lists([odd_sketch(s) if len(s) else none for s in sets]), *batch.columns[2:]],
            ["doc_id", "n", "node", "keys", "sketch", *batch.schema.names[2:]])


def _full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        sets = shingle_sets(*utf8(batch.column("text")))
        yield pa.RecordBatch.from_arrays(
            [pa.array([_identity(s) for s in sets], pa.int64()), _as_lists(sets)], ["node", "shingles"])


def text_digest(text: Column) -> Column:
    """What tells rows of one doc_id apart; a null text counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def near_duplicates(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text",
                    identity: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per row of ``docs``; with ``identity``
    also digest (``text_digest`` of the row's text) and part (one number per
    component, null for a row that takes no part), as rows of one doc_id may
    have different texts in different components.

    Two documents link if 100 * |intersection| >= percent * |union| of their
    shingle sets (the keys are made for thresholds of 80 and more). The
    component id is the smallest doc_id reachable; ``kept`` marks that row.

    A null or wordless text has the empty set and links with nothing. Rows
    with a null doc_id take no part: component_id null, kept true. Rows that
    repeat a doc_id are judged by their own text, and each is returned. An
    empty table gives an empty result; other columns are ignored.
    """
    rows = text_rows(docs, id_col, text_col)
    schema = "doc_id long, n long, node long, keys array<long>, sketch array<long>"
    sketches = scratch_table(
        rows.withColumn("digest", text_digest(F.col("text"))).mapInArrow(_sketch, schema + ", digest string") if identity
        else rows.mapInArrow(_sketch, schema), "sketches")
    nodes = scratch_table(
        sketches.where("n > 0 AND doc_id IS NOT NULL").groupBy("node")
        .agg(F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.first("keys").alias("keys"),
             F.first("sketch").alias("sketch")), "nodes")
    keyed = nodes.select(F.explode("keys").alias("key"), "node", "doc", "n")
    centres = scratch_table(
        keyed.groupBy("key").agg(F.min(F.struct("doc", "node", "n")).alias("c"), F.count("*").alias("size"))
        .where("size > 1").select("key", F.col("c.node").alias("centre"), F.col("c.n").alias("centre_n")), "centres")
    members = scratch_table(keyed.join(centres, "key"), "members")

    taking = members.select("node", "doc").distinct()
    wanted = rows.join(taking.select(F.col("doc").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = scratch_table(wanted.mapInArrow(_full, "node long, shingles array<long>").dropDuplicates(["node"]), "sets")

    close = f"100 * least(n, other_n) >= {percent} * greatest(n, other_n)"
    star = (members.where("node != centre")
            .select("node", "n", F.col("centre").alias("other"), F.col("centre_n").alias("other_n")).where(close)
            .groupBy("node", "other").agg(F.count("*").alias("shared")))
    # one centre for each node first, the one met most often
    best = (star.groupBy("node").agg(F.max(F.struct("shared", "other")).alias("b"))
            .select("node", F.col("b.other").alias("other")))
    links = scratch_table(_confirmed(best, sets, percent), "links")
    found = connected_components(links, "node", "other")

    # what the first stars left apart: in each bucket all but its largest component meet the other components
    placed = (members.join(found.withColumnRenamed("node", "id"), F.col("node") == F.col("id"), "left")
              .select("key", "node", "n", F.coalesce("component", "node").alias("part")))
    parts = placed.groupBy("key", "part").agg(F.count("*").alias("size"))
    several = scratch_table(
        parts.groupBy("key").agg(F.max(F.struct("size", "part")).alias("m"), F.count("*").alias("parts"), F.sum("size").alias("size"))
        .where("parts > 1").select("key", F.col("m.part").alias("largest"), "size"), "several")
    apart = scratch_table(placed.join(several, "key").join(nodes.select("node", "sketch"), "node"), "apart")
    pairs = (_blocks(apart, sets, percent).repartition("key", "cell").sortWithinPartitions("key", "cell")
             .mapInArrow(_near_pairs(percent), "node long, other long").distinct())
    more = _confirmed(pairs, sets, percent)
    joined = connected_components(links.unionByName(more), "node", "other")

    of_node = scratch_table(nodes.select("node", "doc").join(joined, "node", "left")
                            .select("node", "doc", F.coalesce("component", "node").alias("part")), "parts")
    smallest = scratch_table(of_node.groupBy("part").agg(F.min("doc").alias("component_id")), "smallest")
    named = scratch_table(of_node.join(smallest, "part").select("node", "component_id", *(["part"] if identity else [])), "named")
    takes_part = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    return (sketches.select("doc_id", "n", F.when(takes_part, F.col("node")).alias("node"), *(["digest"] if identity else []))
            .join(named, "node", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("component_id", "doc_id").alias("component_id"), *(["digest", "part"] if identity else []))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def _blocks(apart: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows of ``apart`` by bucket and cell: a bucket of several blocks has a
    cell for each pair of them, in which the ``asks`` of the one meet the
    ``told`` of the other. ``lone`` is how many shingles of a node of a wide
    bucket no other such node has; a node that has too many links with none
    there and is left out."""
    wide = F.col("size") > WIDE
    alone = (sets.join(apart.where(wide).select("node").distinct(), "node", "left_semi")
             .select("node", F.explode("shingles").alias("shingle"))
             .groupBy("shingle").agg(F.count("*").alias("times"), F.min("node").alias("node")).where("times = 1")
             .groupBy("node").agg(F.count("*").alias("alone")))
    rows = (apart.join(alone, "node", "left").withColumn("lone", F.when(wide, F.coalesce("alone", F.lit(0))).otherwise(F.lit(0)))
            .where(100 * (F.col("n") - F.col("lone")) >= percent * F.col("n"))
            .withColumn("asks", F.col("part") != F.col("largest"))
            .withColumn("blocks", F.ceil(F.col("size") / BLOCK)).withColumn("own", F.expr("pmod(xxhash64(node), blocks)")))
    cells = F.expr("""array_distinct(concat(transform(sequence(0L, blocks - 1), i -> i * blocks + own),
                      if(asks, transform(sequence(0L, blocks - 1), i -> own * blocks + i), array())))""")
    return (rows.withColumn("cell", F.explode(cells))
            .select("key", "cell", "node", "n", "lone", "part", "sketch",
                    F.expr("asks AND cell div blocks = own").alias("asks"), F.expr("cell % blocks = own").alias("told")))


def _near_pairs(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From rows of ``_blocks`` that lie together by key and cell: the pairs
    (node, other) of different parts whose sizes, lone shingles and sketches
    leave a link possible."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            key, cell = (rows.column(c).to_numpy() for c in ("key", "cell"))
            begin = np.flatnonzero((key[1:] != key[:-1]) | (cell[1:] != cell[:-1])) + 1
            last = int(begin[-1]) if len(begin) else 0  # the last group may go on in the next batch
            yield from _compared(rows.slice(0, last), begin, percent)
            held = rows.slice(last)
        if held is not None:
            yield from _compared(held, np.zeros(0, np.int64), percent)
    return run


def _compared(rows: pa.Table, begin: np.ndarray, percent: int) -> Iterator[pa.RecordBatch]:
    """``_near_pairs`` of whole groups, which begin at row 0 and at ``begin``."""
    if not len(rows):
        return
    node, n, lone, part, asks, told = (rows.column(c).to_numpy() for c in ("node", "n", "lone", "part", "asks", "told"))
    sketch = rows.column("sketch").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, SKETCH_LONGS)
    group = np.searchsorted(begin, np.arange(len(rows)), "right")
    left, right = np.flatnonzero(asks), np.flatnonzero(told)
    first, end = (np.searchsorted(group[right], group[left], side) for side in ("left", "right"))
    upto = np.append(0, np.cumsum(end - first))
    lo = 0
    while lo < len(left):
        hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] + PAIRS, "right")) - 1)
        a, b = np.repeat(left[lo:hi], end[lo:hi] - first[lo:hi]), right[ragged(first[lo:hi], end[lo:hi] - first[lo:hi])]
        common = np.minimum(n[a] - lone[a], n[b] - lone[b])  # at most
        near = np.flatnonzero((part[a] != part[b]) & (100 * common >= percent * (n[a] + n[b] - common)))
        a, b = a[near], b[near]
        differing = np.bitwise_count(sketch[a] ^ sketch[b]).sum(axis=1, dtype=np.int64)
        # a link allows at most so many differing shingles, so the bound drops no link
        near = np.flatnonzero(differing * (100 + percent) <= (n[a] + n[b]) * (100 - percent))
        a, b = node[a[near]], node[b[near]]
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["node", "other"])
        lo = hi


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (node, other) whose full shingle sets are similar enough."""
    a = sets.select(F.col("node").alias("a_node"), F.col("shingles").alias("a_set"))
    b = sets.select(F.col("node").alias("b_node"), F.col("shingles").alias("b_set"))
    both = (pairs.join(a, F.col("node") == F.col("a_node")).join(b, F.col("other") == F.col("b_node"))
            .withColumn("common", F.size(F.array_intersect("a_set", "b_set"))))
    union = F.size("a_set") + F.size("b_set") - F.col("common")
    return both.where(100 * F.col("common") >= percent * union).select("node", "other")
