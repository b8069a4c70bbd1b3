"""Long texts, many languages and large shards in bounded memory."""

import tracemalloc

import numpy as np

from cdcmart.llm import common, langid, suffix_dedup


def model(languages, seed=5):
    rng = np.random.default_rng(seed)
    return langid.LanguageModel([f"l{i}" for i in range(languages)], rng.normal(size=(langid.BUCKETS, languages)).astype(np.float32),
                                rng.normal(size=languages).astype(np.float32), 1.0, 0.0)


def plain_scores(m, rows):
    out = []
    for row in rows:
        codes = [c for c in langid.subwords(np.frombuffer(row, np.uint8)) if len(c)]
        every = np.concatenate(codes) if codes else np.zeros(0, np.int64)
        out.append(m.logits[every].sum(axis=0, dtype=np.float64) / max(1, len(every)) + m.bias)
    return langid.softmax(np.array(out) / m.temperature)


def test_runs_give_the_scores_of_whole_rows(monkeypatch):
    rng = np.random.default_rng(2)
    rows = [bytes(rng.integers(32, 123, n, dtype=np.uint8)) for n in (0, 1, 2, 3, 4, 5, 9000, 4096, 4097, 0, 8192, 12291, 17, 40000, 0)]
    data = np.frombuffer(b"".join(rows), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    for cells in (1, 1 << 21):
        monkeypatch.setattr(langid, "SCORE_CELLS", cells)
        m = model(7)
        np.testing.assert_allclose(m.scores(data, offsets), plain_scores(m, rows), rtol=1e-6)


def peak(work):
    tracemalloc.start()
    work()
    top = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return top


def test_long_text_and_many_languages_stay_small():
    data = np.random.default_rng(1).integers(97, 123, 4 << 20, dtype=np.uint8)
    assert peak(lambda: model(4).scores(data, np.array([0, len(data)]))) < 100 << 20
    many = model(200)
    assert peak(lambda: many.scores(data[:1 << 20], np.array([0, 1 << 20]))) < 100 << 20


def test_powers_of_a_long_text_are_not_kept():
    long = common.powers((1 << 21) + 5)
    assert len(long) >= (1 << 21) + 5 and len(common.powers(10)) <= 1 << 21
    assert int(long[3]) == pow(int(common.BASE), 3, 1 << 64)


def test_anchor_runs_keep_anchors_together():
    anchor = np.repeat(np.arange(50, dtype=np.uint64), np.random.default_rng(4).integers(1, 9, 50))
    size = np.random.default_rng(3).integers(50, 300, len(anchor))
    runs = suffix_dedup.anchor_runs(anchor, size, np.arange(len(anchor)), 2000)
    assert np.array_equal(np.concatenate(runs), np.arange(len(anchor))) and len(runs) > 3
    assert all(anchor[a[-1]] != anchor[b[0]] for a, b in zip(runs, runs[1:]))
    assert suffix_dedup.anchor_runs(anchor[:0], size[:0], np.arange(0)) == []
    hot = suffix_dedup.anchor_runs(np.zeros(9, np.uint64), np.full(9, 900), np.arange(9), 2000)
    assert len(hot) == 1


def test_a_shard_is_sorted_in_parts(monkeypatch):
    rng = np.random.default_rng(8)
    shared = [bytes(rng.integers(97, 123, 90, dtype=np.uint8)) for _ in range(60)]
    import pyarrow as pa
    texts = [b" ".join(shared[j] for j in rng.integers(0, 60, 12)).decode() for _ in range(40)]
    table = pa.table({"doc_id": pa.array(range(40), pa.int64()), "text": texts})

    def run(most):
        monkeypatch.setattr(suffix_dedup.anchor_runs, "__defaults__", (most,))
        step, key = suffix_dedup._Deduper(50, 1, 1 << 20), (pa.scalar(0),)
        shared_notes = step.close_census(key, step.take_census(key, table))
        firsts = step.sort_shard(key, step.send_pieces(key, table, shared_notes))
        return step.cut(key, table, pa.concat_tables([shared_notes, firsts])).to_pydict()

    whole, parts = run(1 << 20), run(500)
    assert whole == parts and sum(whole["n_removed"]) > 20000
