"""What keeps op2 within its processor time gives the plain results, and is at work."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from lakevault.llm import attention as A
from lakevault.llm import lm_score


def _batch(seed, n):
    dice = np.random.default_rng(seed)
    c, y = (dice.integers(0, A.CLASSES, (n, A.CONTEXT)).astype(np.uint8) for _ in range(2))
    weights = A.fresh(np.log(np.full(A.CLASSES, 1 / A.CLASSES)))
    return weights + dice.normal(0, 0.1, len(weights)).astype(np.float32), c, y, dice.random((n, A.CONTEXT)) < 0.9


def test_gradients_in_reused_memory_are_those_in_fresh_memory():
    space = A.Space()
    for seed, n in ((1, 64), (2, 9), (3, 200), (4, 64)):
        flat, c, y, valid = _batch(seed, n)
        assert (A._gradient(A.unflatten(flat), c, y, valid, space) == A._gradient(A.unflatten(flat), c, y, valid)).all()


def test_a_later_batch_takes_little_new_memory():
    flat, c, y, valid = _batch(5, 256)
    space = A.Space()
    A._gradient(A.unflatten(flat), c, y, valid, space)
    tracemalloc.start()
    A._gradient(A.unflatten(flat), c, y, valid, space)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3e6  # its arrays take 9 MB together


def test_a_large_part_of_the_class_alone_is_not_steep(monkeypatch):
    flat, *_ = _batch(6, 1)
    w = A.unflatten(flat)
    w["pair"] -= np.linspace(0, 80, A.CLASSES, dtype=np.float32)[:, None]  # changes no probability
    seen, steep = [], A._steep
    monkeypatch.setattr(A, "_steep", lambda *a: seen.append(steep(*a)) or seen[-1])
    classes = A.make_classes(np.random.default_rng(7).random(500) * 50, 3, np.arange(500))
    ids = np.random.default_rng(8).integers(0, 500, 300)
    got = A.Scorer(flat, classes).log10(ids, np.array([300]), 3)
    w["pair"] += np.linspace(0, 80, A.CLASSES, dtype=np.float32)[:, None]
    assert np.allclose(got, A.Scorer(flat, classes).log10(ids, np.array([300]), 3), atol=1e-4)
    assert not any(seen)


def test_steep_weights_give_finite_probabilities():
    flat, c, y, valid = _batch(9, 8)
    w = A.unflatten(flat)
    w["out"] *= 4000
    assert np.isfinite(A._gradient(w, c, y, valid)).all()
    classes = A.make_classes(np.ones(500), 3, np.arange(500))
    found = A.Scorer(flat, classes).log10(np.arange(500), np.array([200, 0, 300]), 3)
    assert np.isfinite(found).all() and (found <= 0).all()


def test_words_are_numbered_by_what_they_are():
    dice = np.random.default_rng(10)
    texts = [" ".join(f"W{i}" for i in dice.integers(0, 40, n)) for n in (0, 3, 50, 1, 200)]
    words = lm_score.Words(pa.array([*texts, None]))
    assert [words.distinct[k].decode() for k in words.number] == [w.lower() for t in texts for w in t.split()]
    assert len(set(words.distinct)) == len(words.distinct) == len(words.hash) and (np.diff(words.hash.astype(float)) > 0).all()


@pytest.mark.parametrize("share", [0.5, 0.8, 0.999])
def test_interpolation_is_the_mean_of_the_probabilities(share):
    model, unigram = np.array([-1.0, -30.0, -400.0, 0.0]), np.array([-2.0, -3.0, -7.5, -9.0])
    (got,) = lm_score._interpolated(model, unigram, (share,))
    want = np.logaddexp(np.log(share) + unigram * np.log(10), np.log1p(-share) + model * np.log(10)) / np.log(10)
    assert np.allclose(got, want, rtol=1e-12)


def test_counts_of_a_range_are_added_up_per_word():
    asked = {7: ([b"a", b"bc", b""], [1, 0, 3]), 9: ([b"bc", b"\xff\xfe"], [0, 4]), 2: ([b""], [2]), 5: ([b"a"], [6])}
    messages = [(block, lm_score.squeeze(np.frombuffer(b"\n".join(w), np.uint8), np.array(n, np.int64))) for block, (w, n) in asked.items()]
    got = {block: lm_score.expand(data)[0].tolist() for block, data in lm_score._add_up(0, messages)}
    assert got == {7: [7, 0, 5], 9: [0, 4], 2: [5], 5: [7], lm_score.TOTALS: [16, 3]}
