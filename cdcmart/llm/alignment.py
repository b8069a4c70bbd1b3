"""Alignment of the tokens of two tokenizers over the same bytes.

``align`` cuts two token sequences into groups at the byte offsets where both
have a token end, by diagonal run skipping: from the current pair of places it
probes 1, 2, 4, ... entries of both end arrays at the current index shift, so
a stretch of one-to-one groups is jumped over in a few comparisons; where the
arrays part, the irregular group is resolved step by step, and the shift
between the two places is what it then is.

``Aligner`` encodes and aligns texts. Both vocabularies have tokens that span
a blank only at their start, so a text is cut before single blanks between
plain characters, and neither tokenizer sees across such a cut (the places are
checked on the vocabularies; without that a text is one unit). Every distinct
unit is encoded once, and the new units of a batch are aligned as one sequence.

``align_corpus`` does it for a table: groups per row, and how often each pair
of ids is linked in the whole corpus.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ragged, scratch_table

#: characters beside which a single blank may be a cut: none is white space in any Unicode version
_PLAIN = "[\x21-\x7e¡-և]"
CUT = re.compile(f"(?<={_PLAIN}) (?={_PLAIN})")
#: units a worker remembers before it starts again
UNITS_KEPT = 500_000
#: a pair of ids with this share of all links is looked up in a broadcast table, so that table has at most so many rows
FREQUENT = 100_000
BLANK = "▁"


def align(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int]]:
    """Ends of the groups as counts of tokens of a and b; both sequences end
    at the same offset and every token has at least one byte."""
    cuts_a: list[int] = []
    cuts_b: list[int] = []
    i = j = 0
    n, m = len(ends_a), len(ends_b)
    while i < n and j < m:
        a, b = ends_a[i], ends_b[j]
        if a == b:
            run, width = 1, 1
            while i + run < n and j + run < m and ends_a[i + run] == ends_b[j + run]:
                p, q = i + run, j + run
                width = min(2 * width, n - p, m - q)
                while width > 1 and ends_a[p:p + width] != ends_b[q:q + width]:
                    width //= 2  # the first difference lies in this stretch
                run += width
            cuts_a.extend(range(i + 1, i + run + 1))
            cuts_b.extend(range(j + 1, j + run + 1))
            i, j = i + run, j + run
            continue
        while a != b:
            if a < b:
                i += 1
                a = ends_a[i]
            else:
                j += 1
                b = ends_b[j]
        i, j = i + 1, j + 1
        cuts_a.append(i)
        cuts_b.append(j)
    return cuts_a, cuts_b


def _group_texts(ids_a: np.ndarray, ids_b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray) -> tuple[bytes, np.ndarray]:
    """``a1,a2|b1;a3|b2;`` in decimal digits, and where each group's text ends."""
    in_a = np.diff(cuts_a, prepend=0)
    in_b = np.diff(cuts_b, prepend=0)
    # tokens in the order of the text: a token follows all tokens of the groups before, those of b also their group's of a
    place_a = np.arange(len(ids_a)) + np.repeat(cuts_b - in_b, in_a)
    place_b = np.arange(len(ids_b)) + np.repeat(cuts_a, in_b)
    ids, marks = np.empty(len(ids_a) + len(ids_b), np.int64), np.full(len(ids_a) + len(ids_b), ord(","), np.uint8)
    ids[place_a], ids[place_b] = ids_a, ids_b
    marks[place_a[cuts_a - 1]], marks[place_b[cuts_b - 1]] = ord("|"), ord(";")
    digits = len(str(int(ids.max(initial=0))))
    shown = np.empty((len(ids), digits + 1), np.uint8)
    used = np.ones((len(ids), digits + 1), bool)
    shown[:, digits] = marks
    rest = ids.astype(np.int32)
    for k in range(digits - 1, -1, -1):
        rest, shown[:, k] = rest // 10, rest % 10 + ord("0")
        if k:
            used[:, k - 1] = rest > 0
    ends = np.cumsum(used.sum(axis=1))
    return shown[used].tobytes(), ends[place_b[cuts_b - 1]]


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    bytes for themselves, the others in turn from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Aligner:
    """Tokens of a byte-level tokenizer (a) and a SentencePiece model (b) over
    blank + text, aligned; units are remembered between texts."""

    def __init__(self, byte_path: str, piece_path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=piece_path)
        letters = _byte_letters()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = {i: bytes(letters[c] for c in token) for token, i in vocabulary.items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = {i: bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode()
                        for i, p in enumerate(pieces)}
        self.size_a, self.size_b = (np.array([len(spell.get(i, b"")) for i in range(max(spell) + 1)], np.int64)
                                    for spell in (self.bytes_a, self.bytes_b))
        spec = json.loads(self.a.to_str())
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(self.b.serialized_model_proto())
        plain = model.normalizer_spec
        self.cuts = (spec["normalizer"] is None and (spec["pre_tokenizer"] or {}).get("type") == "ByteLevel"
                     and spec["pre_tokenizer"].get("use_regex") and not spec["pre_tokenizer"].get("add_prefix_space")
                     and plain.name == "identity" and not plain.precompiled_charsmap and plain.add_dummy_prefix
                     and not plain.remove_extra_whitespaces and not any(BLANK in p.lstrip(BLANK) for p in pieces))
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.words: list[bytes | None] = []  # the groups of a unit as text, none where its bytes differ
        self.sizes = np.zeros((0, 3), np.int64)  # tokens of a, of b, groups
        self.first = np.zeros(0, np.int64)
        self.links = np.zeros(0, np.int64)

    def _learn(self, units: list[str]) -> None:
        ids_a = [e.ids for e in self.a.encode_batch_fast([" " + u for u in units], add_special_tokens=False)]
        ids_b = self.b.encode(units, num_threads=1)
        held = np.ones(len(units), bool)
        raw = [b" " + u.encode() for u in units]
        for ids, spell, sizes in ((ids_a, self.bytes_a, self.size_a), (ids_b, self.bytes_b, self.size_b)):
            flat = list(itertools.chain.from_iterable(ids))
            if b"".join(map(spell.__getitem__, flat)) == b"".join(raw):
                ends = np.cumsum(sizes[np.fromiter(flat, np.int64, len(flat))])[np.cumsum(list(map(len, ids))) - 1]
                held &= ends == np.cumsum(list(map(len, raw)))
            else:
                held &= [b"".join(map(spell.__getitem__, x)) == r for x, r in zip(ids, raw)]
        kept = held.tolist()
        flat_a = list(itertools.chain.from_iterable(itertools.compress(ids_a, kept)))
        flat_b = list(itertools.chain.from_iterable(itertools.compress(ids_b, kept)))
        last_a, last_b = np.fromiter(flat_a, np.int64, len(flat_a)), np.fromiter(flat_b, np.int64, len(flat_b))
        cuts_a, cuts_b = align(np.cumsum(self.size_a[last_a]).tolist(), np.cumsum(self.size_b[last_b]).tolist())
        upto_a, upto_b = np.array(cuts_a, np.int64), np.array(cuts_b, np.int64)
        links = (last_a[upto_a - 1] << 32) | last_b[upto_b - 1]
        # a unit's last tokens end together, so its groups end with a cut at its end
        size_a, size_b = (np.array(list(map(len, ids)), np.int64) * held for ids in (ids_a, ids_b))
        upto = np.searchsorted(upto_a, np.cumsum(size_a), "right")
        n_groups = np.diff(upto, prepend=0)
        text, ends = _group_texts(last_a, last_b, upto_a, upto_b)
        ends = np.concatenate([[0], ends])[np.concatenate([[0], upto])].tolist()
        self.number.update(zip(units, range(len(self.words), len(self.words) + len(units))))
        # without the mark after its last group
        self.words += [text[lo:hi - 1] if s else None for lo, hi, s in zip(ends, ends[1:], kept)]
        self.first = np.concatenate([self.first, len(self.links) + upto - n_groups])
        self.sizes = np.concatenate([self.sizes, np.stack([size_a, size_b, n_groups], 1)])
        self.links = np.concatenate([self.links, links])

    def batch(self, texts: list[str]) -> list[tuple[int, int, int, bytes, np.ndarray]]:
        """Per text: tokens of a, of b, groups, the groups as text, and one
        number (id of a times 2 ** 32 plus id of b) per link."""
        cut = [(CUT.split(t) if self.cuts else [t]) if t else [] for t in texts]
        new = list(dict.fromkeys(u for units in cut for u in units if u not in self.number))
        if new and len(self.number) + len(new) > UNITS_KEPT:
            self._forget()
            new = list(dict.fromkeys(u for units in cut for u in units))
        if new:
            self._learn(new)
        nothing = (0, 0, 0, b"", np.zeros(0, np.int64))
        out = []
        for text, units in zip(texts, cut):
            found = list(map(self.number.__getitem__, units))
            words = list(map(self.words.__getitem__, found))
            if not found:
                out.append(nothing)
            elif None in words:  # decided on the whole text, in a unit of its own
                if len(units) == 1:
                    out.append(nothing)
                else:
                    whole = Aligner.__new__(Aligner)
                    whole.__dict__.update(self.__dict__, cuts=False)
                    whole._forget()
                    out += whole.batch([text])
            else:
                at = np.fromiter(found, np.int64, len(found))
                sizes = self.sizes[at]
                n_a, n_b, n_groups = sizes.sum(axis=0).tolist()
                out.append((n_a, n_b, n_groups, b";".join(words), self.links[ragged(self.first[at], sizes[:, 2])]))
        return out


@functools.lru_cache(maxsize=2)
def _aligner(byte_path: str, piece_path: str) -> Aligner:
    return Aligner(byte_path, piece_path)


_ROW = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<bigint>, times array<bigint>"
_FIELDS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))


def _encode(byte_path: str, piece_path: str, rows: int = 256):
    """Per row its numbers and distinct pairs; after every slice of rows one
    more row, without a row number, with the pairs of the slice."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(byte_path, piece_path)
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                part = batch.slice(lo, rows)
                found = aligner.batch(part.column("text").to_pylist())
                pairs = [np.unique(links, return_counts=True) for *_, links in found]
                every, place = np.unique(np.concatenate([p for p, _ in pairs]), return_inverse=True)
                summed = np.zeros(len(every), np.int64)
                np.add.at(summed, place, np.concatenate([c for _, c in pairs]))
                numbers = [[*column, None] for column in zip(*[f[:3] for f in found])]
                digests = [hashlib.sha256(f[3]).hexdigest() if f[0] else "" for f in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*part.column("row").to_pylist(), None], pa.int64()),
                     pa.array([*part.column("doc_id").to_pylist(), None], pa.int64()),
                     *[pa.array(c, pa.int64()) for c in numbers],
                     pa.array([*[len(f[4]) for f in found], None], pa.int64()), pa.array([*digests, None], pa.string()),
                     _lists([*[p for p, _ in pairs], every]), _lists([*[c for _, c in pairs], summed])],
                    ["row", *_FIELDS, "pairs", "times"])
    return encode


def _look_up(pairs: np.ndarray, counts: np.ndarray, best: np.ndarray):
    """Adds up what the table of frequent pairs answers; passes on the rest."""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, times = (batch.column(c) for c in ("pairs", "times"))
            row = np.repeat(np.arange(batch.num_rows), np.diff(held.offsets.to_numpy()))
            flat, often = (c.flatten().to_numpy(zero_copy_only=False) for c in (held, times))
            place = np.minimum(np.searchsorted(pairs, flat), max(0, len(pairs) - 1))
            known = pairs[place] == flat if len(pairs) else np.zeros(len(flat), bool)
            n_best, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(n_best, row[known], often[known] * best[place[known]])
            np.add.at(total, row[known], often[known] * counts[place[known]])
            left = np.concatenate([[0], np.cumsum(np.bincount(row[~known], minlength=batch.num_rows))])
            rest = [pa.ListArray.from_arrays(pa.array(left, pa.int32()), pa.array(x[~known], pa.int64())) for x in (flat, often)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *[batch.column(c) for c in _FIELDS], pa.array(n_best), pa.array(total), *rest],
                ["row", *_FIELDS, "n_best", "count_sum", "pairs", "times"])
    return look


def align_corpus(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, pairs). ``rows``: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256 per row of ``docs``; ``pairs``: pair (id of a
    times 2 ** 32 plus id of b), n (links that hold it in the whole corpus),
    best (no pair with the same id of b has more).

    The counts are added up in each slice of rows before the shuffle. Pairs
    that hold a 1 / FREQUENT share of all links (so there are at most FREQUENT
    of them) are looked up in the task that has the row; only the others, none
    of which is frequent, are shuffled to their counts.

    A null or empty text has no tokens: zeros and ''. So has a text whose
    tokens do not spell it. Repeated rows are answered and counted each; a
    null doc_id is kept; an empty table gives an empty result; other columns
    are ignored. A text is encoded whole, however long.
    """
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(docs[text_col], F.lit("")).alias("text"))
    found = scratch_table(rows.mapInArrow(_encode(byte_path, piece_path), _ROW), "aligned")
    counted = scratch_table(
        found.where("row IS NULL").select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
        .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("n")), "pair-counts")
    of_b = F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b")
    most = counted.groupBy(of_b).agg(F.max("n").alias("most"))
    pairs = scratch_table(counted.withColumn("b", of_b).join(most, "b")
                          .select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")
    total = pairs.agg(F.sum(F.col("n").cast("decimal(38,0)"))).first()[0] or 0
    often = F.col("n").cast("decimal(38,0)") * FREQUENT >= F.lit(int(total)).cast("decimal(38,0)")
    frequent = pairs.where(often).orderBy("pair").toArrow()
    pair, count, best = (frequent.column(c).to_numpy() for c in ("pair", "n", "best"))
    looked = found.where("row IS NOT NULL").mapInArrow(
        _look_up(pair, count, best.astype(np.int64)),
        _ROW.replace("pairs array", "n_best long, count_sum long, pairs array"))
    looked = scratch_table(looked, "looked-up")
    rest = (looked.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
            .select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times")))
    late = rest.join(pairs.where(~often), "pair").select(
        "row", *[F.lit(None).cast("string" if c == "groups_sha256" else "long").alias(c) for c in _FIELDS],
        F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum"))
    out = (looked.drop("pairs", "times").unionByName(late).groupBy("row")
           .agg(*[F.max(c).alias(c) for c in _FIELDS], F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
           .drop("row"))
    return out, pairs
