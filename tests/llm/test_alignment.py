"""The token alignment against a brute-force version."""

import hashlib
import random
from collections import Counter

import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from cdcmart.llm import alignment
from cdcmart.llm.queries import BYTE_BPE, PIECES

SCHEMA = "doc_id long, text string, `row` string, pairs string, n_a int"


def texts():
    rng = random.Random(7)
    words = ["alpha", "Beta", "don't", "naïve", "x1y2", "42", "a,b", "—", "日本語", "привет", "🙂", "<|endoftext|>", "<s>", "</s>",
             "<0x0A>", "_", "é", "i'll", "...", " "]
    gaps = [" ", " ", " ", "  ", "\n", "\n\n", "\t", " \n ", ""]
    out = ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(1, 60))) for _ in range(40)]
    out += [out[3], out[3], None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "▁", "a ▁b ▁ c d", "\0", "a \0 b", "x" * 3000, "ab " * 2000,
            "\r\n a\r\n", "  a", " a b", "é a", "﻿ a"]
    return out


def spell(byte_path, piece_path):
    a, b = Tokenizer.from_file(byte_path), SentencePieceProcessor(model_file=piece_path)
    a.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter, extra = {}, 0
    for byte in range(256):
        if byte in shown:
            letter[chr(byte)] = byte
        else:
            letter[chr(256 + extra)] = byte
            extra += 1

    def tokens(text):
        e = a.encode(" " + text, add_special_tokens=False)
        first = [(i, bytes(letter[c] for c in t)) for i, t in zip(e.ids, e.tokens)]
        second = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
                  for i in b.encode(text)]
        return first, second
    return tokens


def brute(rows):
    tokens = spell(BYTE_BPE, PIECES)
    docs, counts = [], Counter()
    for doc_id, text in rows:
        first, second = tokens(text) if text else ([], [])
        raw = (" " + (text or "")).encode()
        if b"".join(x for _, x in first) != raw or b"".join(x for _, x in second) != raw:
            first, second = [], []
        ends = [[sum(len(x) for _, x in side[:k + 1]) for k in range(len(side))] for side in (first, second)]
        common, groups, links, before = sorted(set(ends[0]) & set(ends[1])), [], [], 0
        for end in common:
            mine = [[i for (i, _), e in zip(side, at) if before < e <= end] for side, at in zip((first, second), ends)]
            groups.append(",".join(map(str, mine[0])) + "|" + ",".join(map(str, mine[1])))
            links.append((mine[0][-1], mine[1][-1]))
            before = end
        counts.update(links)
        docs.append((doc_id, len(first), len(second), len(groups), links,
                     hashlib.sha256(";".join(groups).encode()).hexdigest() if first else ""))
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    return [(d, a, b, g, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), sha)
            for d, a, b, g, links, sha in docs]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("kept, frequent", [(300_000, 100_000), (20, 30)])
def test_equals_brute_force(spark, monkeypatch, kept, frequent):
    monkeypatch.setattr(alignment, "FREQUENT", frequent)
    rows = list(enumerate(texts())) + [(7, "again"), (7, "again"), (None, "no id"), (None, None)]
    table = spark.createDataFrame([(*r, "r", "p", 1) for r in rows], SCHEMA)
    found, pairs = alignment.align_corpus(table, BYTE_BPE, PIECES)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    got = [tuple(r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))
           for r in found.collect()]
    want = brute(rows)
    assert order(got) == order(want)
    assert pairs.agg({"n": "sum"}).first()[0] == sum(r[4] for r in want)
    aligner = alignment.Aligner(BYTE_BPE, PIECES)
    monkeypatch.setattr(alignment, "UNITS_KEPT", kept)
    assert [f[:3] for t in texts() for f in aligner.batch([t or ""])] == [r[1:4] for r in want[:len(texts())]]


def test_empty(spark):
    found, pairs = alignment.align_corpus(spark.createDataFrame([], SCHEMA), BYTE_BPE, PIECES)
    assert found.count() == 0 and pairs.count() == 0


def test_align_brute_force():
    rng = random.Random(2)
    for _ in range(500):
        n = rng.randint(1, 120)
        cut = rng.choice([0.02, 0.3, 0.9])
        shared = {x for x in range(1, n) if rng.random() < 0.9}
        a, b = ([*sorted(x for x in range(1, n) if x in shared or rng.random() < cut), n] for _ in range(2))
        common = sorted(set(a) & set(b))
        got = alignment.align(a, b)
        assert got == ([a.index(x) + 1 for x in common], [b.index(x) + 1 for x in common])
