"""The conversation trie against a brute-force version."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cdcmart.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth string, conv int, top int, `size` int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "n", "d", 1, 2, 3) for r in rows], SCHEMA)


def digest(turn):
    role, text = turn
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def brute(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, digest((role or "", text or "")), (role or "", text or "")))
    own = {c: [x[3] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        built[c] = own.get(base, [])[:h] + turns[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, w in sorted(built.items()):
        for d in range(len(w) + 1):
            members[tuple(w[:d])].append(c)
        ends[tuple(w)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for k in members:
        if k:
            children[k[:-1]] += 1
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in children
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1]) if k else 0
    return sorted((m[0], len(k), members[k[:-1]][0] if k else None, len(m), children[k], leaves[k], saved[k],
                   hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()) for k, m in members.items())


def run(spark, rows, most=50_000):
    conv = F.col("conv")
    out = prefix_trie.conversation_trie(frame(spark, rows), conv - conv % 100, (F.crc32(conv.cast("string")) % 6).cast("int"), most)
    return sorted((tuple(r) for r in out.collect()), key=lambda r: (r[0], r[1]))


def odd_rows():
    rng = random.Random(5)
    rows = []
    for c in [*range(0, 12), 100, 101, 103, 250, 251, -5, -100, -101]:
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["", "a", "bé\U0001F600", None])))
    rows += [(3, None, "user", "first"), (3, None, "user", "first"), (4, 1, "user", "tie"), (4, 1, "user", "tie")]
    rows += [(None, 0, "user", "lost"), (600, 0, None, None)]
    rows += [(c, t, "user", "same") for c in range(300, 340) for t in range(8)]  # a group of copies
    rows += [(700, t, "user", f"turn {t}") for t in range(60)]  # a long one
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("most", [50_000, 3])
def test_equals_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(prefix_trie, "CHAINED", 4)
    monkeypatch.setattr(prefix_trie, "ID_RANGE", 16)
    rows = odd_rows()
    assert run(spark, rows, most) == brute(rows)


def test_empty_and_turnless(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "user", "x")]) == []
    lone = next(c for c in range(201, 300) if zlib.crc32(str(c).encode()) % 6 > 1)  # its one turn is among its first
    assert run(spark, [(lone, 0, "user", "x")]) == brute([(lone, 0, "user", "x")])
    assert brute([(lone, 0, "user", "x")])[0][1:3] == (0, None)


def test_centroid_sums_brute_force():
    rng = np.random.default_rng(1)
    for n in [1, 2, 3, 40, 300]:
        for shape in range(3):
            parent = np.array([-1 if i == 0 or rng.random() < 0.05 else
                               (i - 1 if shape == 0 else int(rng.integers(0, i)) if shape == 1 else 0) for i in range(n)])
            values = rng.integers(0, 9, (n, 2))
            want = values.copy()
            for i in range(n - 1, 0, -1):
                if parent[i] >= 0:
                    want[parent[i]] += want[i]
            assert (prefix_trie.centroid_sums(parent, values) == want).all()
