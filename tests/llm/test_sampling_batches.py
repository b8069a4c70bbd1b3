"""Sampled segmentations, all texts of a batch at once."""
import hashlib
import sys

import numpy as np
import pyarrow as pa
import pytest

from cdcmart.llm import queries, sampling

ODD = ["", "▁", "▁▁", "one▁▁two▁", "▁lead", "plain", "▁漢字▁🎉\0", "▁tail▁▁▁", "\0", "▁é▁ß"]


@pytest.fixture(scope="module")
def pieces():
    return sampling.Pieces(queries.PIECES, 1.0)


def units(pieces, text):
    return sampling._UNITS.findall(pieces.model.normalize(text))


def calls_of(work) -> int:
    """Calls of Python and built-in functions that some work makes."""
    seen = [0]
    def count(frame, event, arg):
        seen[0] += event in ("call", "c_call")
    sys.setprofile(count)
    try:
        work()
    finally:
        sys.setprofile(None)
    return seen[0]


def test_the_search_is_not_made_of_calls_for_each_text(pieces):
    """Fails where each text is branched and joined on its own: 943 CPU seconds a GB by the check tool."""
    lat = sampling.Lattices(pieces)
    def work(n):
        texts = [units(pieces, f"the cat sat on mat number {i % 50}, said the dog") for i in range(n)]
        lat.numbers(pa.array([u for t in texts for u in t]))
        return calls_of(lambda: sampling.sample_rows(lat, texts, list(range(n)), 2, 0))
    assert (work(1200) - work(200)) / 1000 < 120  # 178 then


def test_units_are_split_as_the_pattern_says():
    for texts in (ODD, ODD[::-1], [], ["", ""], ["▁", "▁"]):
        found, counts = sampling.split_units([t.encode() for t in texts])
        want = [sampling._UNITS.findall(t) for t in texts]
        assert found.to_pylist() == [u for t in want for u in t] and counts.tolist() == [len(t) for t in want]


def test_samples_are_those_of_one_text_alone(pieces):
    texts = ["", "the cat\n", "Two words", "漢字 🎉\0 é", "zq" * 300, "a  b ", "unbelievable segmentations, twice"]
    lat = sampling.Lattices(pieces)
    together = sampling.sample_rows(lat, [units(pieces, t) for t in texts], [3, 1, None, 3, 9, 7, 8], 4, 5)
    for text, key, row in zip(texts, [3, 1, None, 3, 9, 7, 8], together):
        alone = sampling.sample_rows(sampling.Lattices(pieces), [units(pieces, text)], [key], 4, 5)[0]
        assert [s[2:] for s in row.samples] == [s[2:] for s in alone.samples]
        assert [o[0] for o in row.open[:1]] == [o[0] for o in alone.open[:1]]
        tokens = [sampling.token_ids(lat, s[0]) for s in row.samples]
        cuts = np.cumsum([0, *(len(s[0]) for s in row.samples)])
        every, at = sampling.path_tokens(lat, np.concatenate([s[0] for s in row.samples]), cuts)
        assert [t.tolist() for t in tokens] == [every[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
        for own in tokens:
            data, starts = sampling.decode(pieces, own)
            assert data.to_pybytes()[:starts[-1]].decode() == pieces.model.normalize(text)


def test_a_workers_first_texts_may_all_be_empty(pieces):
    rows = sampling.sample_rows(sampling.Lattices(pieces), [[], []], [1, None], 2, 0)
    assert [[(len(s[0]), s[2]) for s in row.samples] for row in rows] == [[(0, 0.0)]] * 2 and not any(row.open for row in rows)


def test_samples_are_those_drawn_before_texts_went_together(pieces):
    """Digests of the ids and rounded scores as the code gave them that searched text by text."""
    lat = sampling.Lattices(pieces)
    texts = ["the cat sat on the mat", "Unbelievable, 漢字 and 🎉\0!", "zq" * 60, "a  b "]
    found = sampling.sample_rows(lat, [units(pieces, t) for t in texts], [1, 2, 3, None], 6, 7)
    said = [[[sampling.token_ids(lat, s[0]).tolist(), round(s[2], 6), round(s[3], 6)] for s in row.samples]
            + [round(row.open[0][0], 6) if row.open else None] for row in found]
    assert hashlib.sha256(repr(said).encode()).hexdigest() == DRAWN


DRAWN = "14f153871f9201174d08c1f4cd78f9dfbf17242c2597ec1538f712e6ddc09a68"
