"""Repeated bytes against every window, and maximal repeats against every occurrence."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakevault.llm import repeats
from tests.llm.helpers import SF, awkward, empty

RESULT = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]


def plain(texts: list, size: int) -> list[tuple]:
    """Per text its bytes, those in a window that starts elsewhere too, their runs, and the hash of the others."""
    times = defaultdict(int)
    data = [(t or "").encode() for t in texts]
    for b in data:
        for i in range(len(b) - size + 1):
            times[b[i : i + size]] += 1
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if times[b[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        runs = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(b)))
        out.append((len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return out


def tangled(seed: int, count: int = 60) -> list[str]:
    """Texts of few letters that share passages cut, edited, doubled and placed anywhere."""
    dice = random.Random(seed)
    pool = ["".join(dice.choice("abé \n") for _ in range(dice.randint(10, 60))) for _ in range(8)] + ["ab" * 40, "a" * 50]
    out = []
    for _ in range(count):
        text = ""
        for _ in range(dice.randint(0, 5)):
            p = dice.choice(pool)
            text += p[dice.randint(0, 9) : dice.randint(5, len(p))] + "".join(dice.choice("abcdefgh") for _ in range(dice.randint(0, 12)))
        out.append(text)
    return [*out, "", None, out[0], out[0]]


@pytest.mark.parametrize(("size", "max_group"), [(20, 1 << 15), (20, 2), (33, 3), (64, 1 << 15)])
def test_removed_bytes_equal_every_window(spark, size, max_group):
    texts = tangled(size + max_group)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = repeats.remove_repeated_bytes(docs, size=size, max_group=max_group).select("doc_id", *RESULT).collect()
    assert sorted(tuple(r) for r in got) == [(k, *w) for k, w in enumerate(plain(texts, size))]


def test_op11_on_a_whole_table_and_awkward_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in repeats.op11_repeats(docs).collect())
    assert got == sorted((r.doc_id, *w) for r, w in zip(rows, plain([r.text for r in rows], 400), strict=True))
    odd = awkward(spark).withColumns({c: F.lit(1) for c in ("rid", "g", "h", "spans", "kept_sha256", "kept")})
    rows = odd.select("doc_id", "text").collect()
    got = [tuple(r) for r in repeats.op11_repeats(odd).collect()]
    assert sorted(got, key=str) == sorted(((r.doc_id, *w) for r, w in zip(rows, plain([r.text for r in rows], 400), strict=True)), key=str)
    assert repeats.op11_repeats(empty(spark)).count() == 0


def test_a_long_text_is_read_in_pieces(spark):
    dice = random.Random(9)
    body = "".join(chr(dice.randint(97, 122)) for _ in range(1_500_000))
    passage = body[700_000:700_900]
    texts = [body * 2 + "".join(chr(dice.randint(65, 90)) for _ in range(1000)), "Q" * 10 + passage]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in repeats.op11_repeats(docs).collect()}
    assert (got[0].n_removed, got[0].n_spans) == (3_000_000, 1)
    assert (got[1].n_removed, got[1].kept_sha256) == (900, hashlib.sha256(b"Q" * 10).hexdigest())


@pytest.mark.parametrize("max_group", [1 << 15, 2])
def test_maximal_repeats_list_every_occurrence(spark, max_group):
    texts = tangled(4, 25)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    groups, strings = defaultdict(set), {}
    for r in repeats.maximal_repeats(docs, size=20, max_group=max_group).collect():
        string = (texts[r.doc_id] or "").encode()[r.start : r.start + r.n_bytes]
        assert len(string) == r.n_bytes >= 20 and strings.setdefault(r.repeat, string) == string
        groups[r.repeat].add((r.doc_id, r.start))
    for name, string in strings.items():
        data = [(t or "").encode() for t in texts]
        assert groups[name] == {(k, i) for k, b in enumerate(data) for i in range(len(b)) if b[i : i + len(string)] == string}
    covered = sum(w[1] for w in plain(texts, 20))
    gone = {(d, i) for name, places in groups.items() for d, s in places for i in range(s, s + len(strings[name]))}
    assert len(gone) == covered


def test_sliding_least():
    dice = np.random.default_rng(2)
    for n, width in ((5, 5), (17, 4), (100, 7), (6, 1)):
        key = dice.integers(0, 50, n).astype(np.uint64)
        assert repeats.sliding_least(key, width).tolist() == [min(key[i : i + width]) for i in range(n - width + 1)]


def test_intervals_of_an_array():
    assert sorted(repeats.intervals([3, 5, 5, 2], 3)) == [(3, 0, 3), (5, 1, 3)]
    assert list(repeats.intervals([], 1)) == []
