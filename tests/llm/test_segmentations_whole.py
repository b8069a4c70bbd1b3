"""What op2 returns: the segmentations themselves, decoded, with scores that do not vanish."""

import hashlib

import numpy as np
import pytest

from cdcmart.llm import queries, sampling

TEXTS = ["", "the cat sat on the mat", "Unbelievable, 漢字 and 🎉\0!", "a  b ", " lead", "zq" * 60, "it was the best of times, " * 3000]


@pytest.fixture(scope="module")
def pieces():
    return sampling.Pieces(queries.PIECES, 1.0)


def test_query_returns_eight_segmentations_and_decodes_them(spark, pieces, tmp_path):
    rows = [*enumerate(TEXTS), (7, None), (7, "the"), (None, "the dog")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {}
    for r in queries.queries()["op2_sampled_segmentations"](spark, str(tmp_path)).collect():
        found.setdefault(r.doc_id, []).append(r)
    for d, text in enumerate(TEXTS[:7]):
        own = sorted(found[d], key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, len(own) + 1)) and len(own) == {0: 1, 3: 6, 5: 2}.get(d, 8)  # all, where there are fewer
        assert len({tuple(r.ids) for r in own}) == len(own)
        for r in own:
            assert pieces.model.decode(r.ids) == pieces.model.decode(pieces.model.encode(text)) and r.round_trip
            assert r.decoded_sha256 == hashlib.sha256(pieces.model.decode(r.ids).encode()).hexdigest()
            assert r.n_tokens == len(r.ids)
            assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, np.int32).tobytes()).hexdigest()
            if len(own) == 8:
                assert r.threshold < own[-1].perturbed
                assert r.log_inclusion == pytest.approx(np.log(-np.expm1(-np.exp(r.log_prob - r.threshold)))
                                                        if r.log_prob - r.threshold > -30 else r.log_prob - r.threshold)
    assert all(r.threshold is None and r.inclusion == 1 and r.log_inclusion == 0 for r in found[0] + found[3] + found[5])
    assert len(found[None]) == 8 and len(found[7]) == 9
    # long texts: the score is too small for a double, its logarithm is not
    assert all(r.inclusion == 0 and -1e6 < r.log_inclusion < -745 for r in found[6])


def test_texts_are_decoded_as_the_library_does(pieces):
    rng, size = np.random.default_rng(8), pieces.model.get_piece_size()
    blank, the = pieces.model.piece_to_id("▁"), pieces.model.piece_to_id("▁the")
    rows = [[], [blank], [blank, blank, the], [int(pieces.byte_ids[0xE2])], [int(pieces.byte_ids[0xE2]), the], pieces.byte_ids[[0xE2, 0x96, 0x81]].tolist(),
            [0, 1, 2], [1, the], [int(pieces.byte_ids[0x20]), the], pieces.byte_ids[[0xED, 0xA0, 0x80]].tolist(), [], [the], []]
    rows += [rng.integers(3, size, rng.integers(0, 30)).tolist() for _ in range(200)]
    rows += [rng.choice(pieces.byte_ids, rng.integers(1, 6)).tolist() for _ in range(200)]
    cuts = np.cumsum([0, *map(len, rows)])
    want = [pieces.model.decode(r) for r in rows]
    assert sampling.decoded_texts(pieces, np.array(sum(rows, []), np.int32), cuts) == want
    assert sampling.decoded_texts(pieces, np.zeros(0, np.int32), np.zeros(3, np.int64)) == ["", ""]
    pieces.drops_one, before = False, pieces.drops_one
    assert before and sampling.decoded_texts(pieces, np.array(sum(rows[:60], []), np.int32), cuts[:61]) == want[:60]
    pieces.drops_one = before


def test_decode_ids_of_nulls_and_many_rows(spark, pieces):
    rows = [(pieces.model.encode(f"row {i}"),) if i % 5 else (None,) for i in range(600)] + [([],)]
    got = [r.decoded for r in sampling.decode_ids(spark.createDataFrame(rows, "ids array<int>").coalesce(1), queries.PIECES).collect()]
    assert sorted(map(str, got)) == sorted(str(None if r[0] is None else pieces.model.decode(r[0])) for r in rows)
