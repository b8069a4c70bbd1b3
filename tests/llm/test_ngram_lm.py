"""The n-gram scores against a brute-force model."""

import math
import os
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cdcmart.llm import ngram_lm
from cdcmart.llm.elias_fano import EliasFano, Trie, trie_arrays
from cdcmart.session import shared_dir

SCHEMA = "doc_id long, text string, learn boolean, block long, words string, `train` string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "w", "t") for r in rows], SCHEMA)


def tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + [None]


def brute(rows, order=3):
    """(doc_id, n_tokens, n_known, N, base, score) without any rounding."""
    count, learned = Counter(), 0
    for _, text, learn in rows:
        if learn:
            seq = [0] * (order - 1) + tokens(text)
            count.update(tuple(seq[i:i + n]) for n in range(1, order + 1) for i in range(order - n, len(seq) - n + 1)
                         if i + n > order - 1)
            learned += 1
    n_tokens = sum(c for g, c in count.items() if len(g) == 1)
    n_words = sum(len(g) == 1 for g in count)

    def total(context):
        return learned if all(w == 0 for w in context) else count[context]

    def prob(gram):
        if len(gram) == 1:
            return (count[gram] + 1) / (n_tokens + n_words + 1)
        weight = ngram_lm.WEIGHT[len(gram)]
        return (count[gram] + weight * prob(gram[1:])) / (total(gram[:-1]) + weight)

    out = []
    for doc_id, text, _ in rows:
        seq = [0] * (order - 1) + tokens(text)
        ends = range(order - 1, len(seq))
        out.append((doc_id, len(ends), sum(count[(seq[i],)] > 0 for i in ends), n_tokens,
                    sum(math.log10(prob((seq[i],))) for i in ends),
                    sum(math.log10(prob(tuple(seq[i - order + 1:i + 1]))) for i in ends)))
    return out


def odd_rows():
    rng = random.Random(11)
    words = [f"w{k}" for k in range(40)] + ["The", "the", "Été", "日本", "a b", "🙂"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 60))), i % 4 != 1) for i in range(80)]
    rows += [(90, rows[2][1], False), (90, rows[2][1], False), (91, None, True), (92, "", False), (93, " \t\n\x0b\x0c\r ", True),
             (None, "the the the", True), (94, "unknown everywhere here", False), (95, "the unknown the w1 w2", None),
             (96, "the " * 5000, True), (97, rows[3][1] + " " + rows[4][1], False)]
    return rows


def close(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1:4])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert g[:4] == w[:4]
        assert g[4] == pytest.approx(w[4], rel=1e-9, abs=1e-9)
        assert abs(g[5] - w[5]) <= 1.5 / 1024 * w[1] + 1e-3, (g, w)  # a token is rounded once an order


@pytest.mark.parametrize("order", [2, 3])
def test_equals_brute_force(spark, order):
    rows = odd_rows()
    table = frame(spark, rows).repartition(3)
    scored = ngram_lm.score_corpus(table, F.col("learn"), order, shard_bytes=5000)
    got = [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in scored.collect()]
    close(got, brute(rows, order))


def test_nothing_learned_and_empty(spark):
    scored = ngram_lm.score_corpus(frame(spark, [(1, "a b", False), (2, None, None)]), F.col("learn")).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in scored) == \
        [(1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)]
    assert ngram_lm.score_corpus(frame(spark, []), F.col("learn")).count() == 0


def test_sequences_and_tries(tmp_path):
    rng = np.random.default_rng(3)
    for n, bound in [(1, 1), (1, 10 ** 12), (7, 3), (1000, 900), (5000, 10 ** 10)]:
        values = np.sort(rng.integers(0, bound, n))
        held = EliasFano(EliasFano.arrays(values, bound))
        at = rng.integers(0, n, 3 * n)
        assert (held[at] == values[at]).all() and (held.read(n) == values).all()
    for order in (1, 2, 3):
        grams = np.unique(rng.integers(0, 30, (400, order)), axis=0)
        learned = rng.random(len(grams)) < 0.6
        mine = [grams[learned, k] for k in range(order)]
        log_prob, counts = -rng.random(learned.sum()) * 9, rng.integers(1, 50, learned.sum())
        trie = Trie.mapped(trie_arrays(mine, log_prob, counts), order, str(tmp_path))
        leaf = trie.find([grams[:, k] for k in range(order)])
        assert ((leaf >= 0) == learned).all()
        assert (trie.count(leaf[learned]) == counts).all()
        assert (trie.find([grams[:5, k] for k in range(order)]) == leaf[:5]).all()  # few: without reading whole levels
        assert np.abs(trie.log_prob(leaf[learned]) - log_prob).max() <= 0.5 / 1024


def test_differences_are_read_back():
    rng = np.random.default_rng(8)
    for order in (1, 2, 3):
        for n in (0, 1, 500):
            grams = np.unique(rng.integers(0, 9, (n, order)), axis=0).reshape(-1, order)
            columns = [grams[:, k] for k in range(order)]
            back = ngram_lm._from_differences([d.astype(np.uint64).astype(np.int64) for d in ngram_lm._differences(columns)])
            assert all((a == b).all() for a, b in zip(columns, back, strict=True))


def asked_block(words=300, texts=400, shards=8, learn=1.0, lane=ngram_lm.LANE_PLACES):
    """A block of Zipf-like texts that has taken up its trigrams; no n-gram is the block's alone."""
    rng = np.random.default_rng(4)
    index = np.minimum(rng.zipf(1.3, texts * 60) - 1, words - 1)
    used = np.bincount(index, minlength=words)
    state = ngram_lm.pack({"index": index.astype(np.uint32), "sizes": np.full(texts, 60, np.uint32), "alone": np.zeros(words, np.uint8),
                           "ids": np.ones(words, np.uint64) * 2, "counts": np.maximum(used, 1).astype(np.uint64)})
    corpus = ngram_lm._Corpus(len(index), words, texts, ngram_lm.WEIGHT, lane)
    block = ngram_lm._Block(state, [True] * texts, corpus, 3, shards)
    block.step()
    block.absorb([{"shard": s, "others": np.zeros(n, np.uint64), "alone": np.zeros(n, np.uint8)}
                  for s, n in enumerate(np.diff(block.cuts))])
    block.step()
    return block


def test_only_ngrams_and_their_counts_travel():
    block = asked_block()
    parts = [b.to_pylist()[0] for b in ngram_lm._asked(7, block)]
    assert all(set(ngram_lm.unpack(p["asked"])) == {"g0", "g1", "g2", "times"} for p in parts)
    assert sum(len(p["asked"]) for p in parts) < 5 * len(block.asks)
    answers = ngram_lm._answer_grams(3)((pa.scalar(0),), pa.Table.from_pylist([{k: parts[0][k] for k in ("block", "asked")}]))
    assert set(ngram_lm.unpack(answers["answer"][0].as_py())) == {"others", "alone"}


def test_frequent_contexts_are_spread():
    for lane in (1, 50):
        block = asked_block(words=40, lane=lane, shards=16)
        size = np.diff(block.cuts)
        assert size.max() < 2 * size.mean()
        context = block.grams(block.asks)[:2]
        shard = np.repeat(np.arange(16), size)
        rare = {}
        count = block.context[block.first[block.asks]]
        for place, s in zip(block.by_shard.tolist(), shard.tolist()):
            if count[place] < lane:
                rare.setdefault((context[0][place], context[1][place]), set()).add(s)
        assert all(len(shards) == 1 for shards in rare.values())


def test_tables_of_the_rounds_are_gone(spark):
    before = set(os.listdir(shared_dir(spark).removeprefix("file:"))), {t.name for t in spark.catalog.listTables()}
    scored = ngram_lm.score_corpus(frame(spark, odd_rows()), F.col("learn"), shard_bytes=5000)
    assert scored.count() == len(odd_rows())
    left = set(os.listdir(shared_dir(spark).removeprefix("file:"))) - before[0]
    assert [name.startswith("llm-scored") for name in left] == [True]
    assert {t.name for t in spark.catalog.listTables()} == before[1]


def test_sequences_of_many_numbers():
    rng = np.random.default_rng(5)
    for bound in (3, 10 ** 9):
        values = np.sort(rng.integers(0, bound, (1 << 17) + 13))
        held = EliasFano(EliasFano.arrays(values, bound))
        assert (held.read(len(values)) == values).all() and (held[np.arange(0, len(values), 7)] == values[::7]).all()
