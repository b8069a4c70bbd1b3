"""Open buckets of near-duplicate search: blocks, bounds and nothing lost."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cdcmart.llm import minhash


def shingles(text):
    words = text.split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def components(rows, percent):
    sets = {d: shingles(t) for d, t in rows}
    least = {d: d for d in sets}
    links = [(a, b) for a, b in itertools.combinations(sorted(sets), 2)
             if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    return sorted((d, len(s), least[d], least[d] == d) for d, s in sets.items())


def edited(rng, words, share):
    return " ".join(f"own{rng.randrange(10 ** 9)}" if rng.random() < share else w for w in words)


def spied(monkeypatch):
    """What goes to the comparison: pairs that meet, and in the largest cell."""
    seen, blocks = [], minhash._blocks
    monkeypatch.setattr(minhash, "_blocks", lambda *a: seen.append(blocks(*a)) or seen[-1])
    def counts():
        cells = seen[0].groupBy("key", "cell").agg(F.sum(F.expr("int(asks)")).alias("a"), F.sum(F.expr("int(told)")).alias("t"))
        return tuple(x or 0 for x in cells.agg(F.sum(F.expr("a * t")), F.max(F.greatest("a", "t"))).first())
    return counts


@pytest.mark.parametrize("percent", [85, 80])
def test_families_cut_into_blocks_lose_no_link(spark, monkeypatch, percent):
    rng, rows = random.Random(percent), []
    for family in range(3):
        base = [f"w{rng.randrange(4000)}" for _ in range(150)]
        rows += [(1000 * family + i, edited(rng, base, rng.choice([0, 0.01, 0.02, 0.03, 0.06]))) for i in range(60)]
    monkeypatch.setattr(minhash, "BLOCK", 8)
    monkeypatch.setattr(minhash, "WIDE", 6)
    counts = spied(monkeypatch)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent).collect()
    want = components(rows, percent)
    assert sorted(map(tuple, got)) == want
    assert 3 < len({w[2] for w in want}) < len(rows)
    assert 0 < counts()[1] <= 24  # a bucket of 60 nodes has 8 blocks of about 8


def test_texts_around_a_template_are_not_paired(spark, monkeypatch):
    """Fails where all nodes of different components of a bucket meet, however many shingles each has alone."""
    rng = random.Random(1)
    template = " ".join(f"t{i}" for i in range(250))
    rows = [(i, template + " " + " ".join(f"own{rng.randrange(10 ** 9)}" for _ in range(80))) for i in range(300)]
    monkeypatch.setattr(minhash, "WIDE", 6)
    counts = spied(monkeypatch)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.kept and r.component_id == r.doc_id for r in got) and len(got) == 300
    assert counts()[0] < 300


def test_groups_over_batches_give_all_pairs_once_compared():
    rng = np.random.default_rng(4)
    size = [1, 2, 40, 1, 3, 90, 5]
    key = np.repeat(np.arange(len(size)), size)
    base = rng.integers(0, 1 << 62, (len(size), 200)).astype(np.uint64)
    sets = [np.unique(np.where(rng.random(200) < rng.choice([0, .05, .3]), rng.integers(0, 1 << 62, 200).astype(np.uint64), base[k])) for k in key]
    n, sketch = np.array([len(s) for s in sets]), np.stack([minhash.odd_sketch(s) for s in sets])
    part, asks, told = rng.integers(0, 4, len(key)), rng.random(len(key)) < .5, rng.random(len(key)) < .9
    rows = pa.table({"key": key, "cell": np.zeros(len(key), np.int64), "node": np.arange(len(key)), "n": n,
                     "lone": np.zeros(len(key), np.int64), "part": part,
                     "sketch": pa.array(sketch.view(np.int64).tolist(), pa.list_(pa.int64())), "asks": asks, "told": told})
    want = {(min(a, b), max(a, b)) for a in range(len(key)) for b in range(len(key))
            if key[a] == key[b] and part[a] != part[b] and asks[a] and told[b]
            and 100 * min(n[a], n[b]) >= 85 * max(n[a], n[b])
            and int(np.bitwise_count(sketch[a] ^ sketch[b]).sum()) * 185 <= (n[a] + n[b]) * 15}
    assert want
    for batch in (1, 7, 1000):
        found = [p for b in minhash._near_pairs(85)(iter(rows.to_batches(batch))) for p in zip(*(c.to_pylist() for c in b.columns))]
        assert set(found) == want
    assert list(minhash._near_pairs(85)(iter([]))) == []


def test_many_pairs_of_one_bucket_take_little_time_each():
    """Fails where a pair takes as long as in the join of before: 224.8 s of 8 cores for 71.5 million."""
    import time
    rng, count = np.random.default_rng(5), 1500
    rows = pa.RecordBatch.from_pydict({
        "key": np.zeros(count, np.int64), "cell": np.zeros(count, np.int64), "node": np.arange(count), "n": np.full(count, 300),
        "lone": np.zeros(count, np.int64), "part": np.arange(count),
        "sketch": pa.array(rng.integers(0, 1 << 62, (count, minhash.SKETCH_LONGS)).tolist(), pa.list_(pa.int64())),
        "asks": np.ones(count, bool), "told": np.ones(count, bool)})
    began = time.process_time()
    assert list(minhash._near_pairs(85)(iter([rows]))) == []
    assert (time.process_time() - began) / count ** 2 < 2e-6
