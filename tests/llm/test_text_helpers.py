import hypothesis.strategies as st
import numpy as np
import pyarrow as pa
from hypothesis import given, settings

from lakevault.llm.blocks import expand, squeeze
from lakevault.llm.common import slices, window_hashes, word_hashes, word_spans
from tests.llm.helpers import words

TEXT = st.text(st.sampled_from("ab é \u0085 \t\n\x0b\x0c\r\x1c "), max_size=30)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | TEXT, max_size=8), st.integers(1, 40))
def test_words_of_every_row(texts, limit):
    seen = [[] for _ in texts]
    for lo, hi, data, offsets in slices(pa.array(texts, pa.string()), limit):
        assert hi > lo
        raw = data.tobytes()
        for a, b, row in zip(*word_spans(data, offsets), strict=True):
            seen[lo + row].append(raw[a:b].decode())
    assert seen == [words(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(TEXT, max_size=6), st.integers(1, 4))
def test_window_hashes_tell_windows_apart(texts, size):
    for _, _, data, offsets in slices(pa.array(texts, pa.string())):
        starts, ends, rows = word_spans(data, offsets)
        raw = data.tobytes()
        plain = [raw[a:b] for a, b in zip(starts, ends, strict=True)]
        at, h = window_hashes(word_hashes(data, starts, ends), rows, size)
        want = [k for k in range(len(plain) - size + 1) if rows[k] == rows[k + size - 1]]
        assert at.tolist() == want
        windows = [tuple(plain[k : k + size]) for k in want]
        assert len(set(windows)) == len(set(h.tolist())) == len(set(zip(windows, h.tolist(), strict=True)))


def test_messages_round_trip():
    arrays = [np.arange(5, dtype=np.uint64), np.empty(0, np.int32), np.array([True, False]), np.array([1.5, -2])]
    back = expand(squeeze(*arrays))
    assert all(a.dtype == b.dtype and (a == b).all() for a, b in zip(arrays, back, strict=True))
