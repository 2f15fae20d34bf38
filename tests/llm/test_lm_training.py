"""The language model learns from every token of the training rows, and from no other."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lakevault.llm import lm_score
from lakevault.llm.attention import CONTEXT
from lakevault.llm.blocks import expand


def test_later_texts_are_learned_from(spark):
    first = " ".join(f"w{i}" for i in range(40))
    rows = [(0, first), *((k, "one two three four five six seven") for k in range(1, 5))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    plain, learned = (sum(r.score for r in lm_score.score_texts(docs, rounds=n).where("doc_id > 0").collect()) for n in (0, 2))
    assert learned > plain + 1


@pytest.mark.parametrize("turns", [1, 2, 3])
def test_windows_hold_each_training_token_once(turns):
    dice = np.random.default_rng(5)
    texts = [" ".join(f"w{i}" for i in dice.integers(0, 60, n)) for n in (0, 1, 5, 31, 32, 33, 64, 200, 900, 7)]
    train = [k % 4 != 1 for k in range(len(texts))]
    words = lm_score.Words(pa.array(texts))
    subwords = lm_score.Subwords(lm_score.tokenizer_path("byte_bpe_50k"))
    ids, lengths = subwords(words)
    n_words = np.bincount(words.rows, minlength=len(texts))
    held = lm_score.squeeze(words.number.astype(np.int32), ids, lengths.astype(np.int32))
    rows = pa.table({"train": pa.array(train), "n_words": pa.array(n_words)}).replace_schema_metadata({lm_score.BLOCK: held})
    of = np.arange(lm_score.VOCABULARY) % 128
    found, want = Counter(), Counter()
    for turn in range(turns):
        for part in lm_score._windows(of, rows, turn, turns):
            assert part.shape[1] == CONTEXT + 1
            for w in part.tolist():
                found.update((w[k], w[k + 1]) for k in range(CONTEXT) if w[k + 1] != lm_score.NONE)
    for text, t in zip(texts, train, strict=True):
        if t:
            tokens = [i for w in text.split() for i in subwords.bpe.fast.encode_ordinary(" " + w)]
            every = [int(of[i]) for i in [lm_score.END, *tokens, lm_score.END]]
            want.update(zip(every, every[1:], strict=False))
    assert found == want


def test_kept_subwords_are_those_of_the_word(monkeypatch):
    monkeypatch.setattr(lm_score, "KNOWN_WORDS", 30)
    subwords = lm_score.Subwords(lm_score.tokenizer_path("byte_bpe_50k"))
    dice = np.random.default_rng(6)
    for _ in range(8):
        words = lm_score.Words(pa.array([" ".join(f"word{i}é" for i in dice.integers(0, 90, 25)), None, "12a-b"]))
        ids, lengths = subwords(words)
        alone = [subwords.bpe.fast.encode_ordinary(" " + w.decode()) for w in words.distinct]
        assert lengths.tolist() == [len(a) for a in alone] and ids.tolist() == [i for a in alone for i in a]


def test_a_block_is_written_as_asked(spark, tmp_path):
    from lakevault.llm.blocks import TEXT, unpack, write_blocks

    docs = spark.createDataFrame([(1, "a b"), (2, None)], "id long, text string").coalesce(1)
    other = lambda _block, rows: ([], rows.select(["id"]).replace_schema_metadata({b"k": lm_score.squeeze(np.arange(3))}))
    (row,) = write_blocks(docs, "text", "asked", other).where(f"kind = {TEXT}").collect()
    table = unpack(bytes(row.data))
    assert table.column_names == ["id"] and table.column("id").to_pylist() == [1, 2]
    assert expand(table.schema.metadata[b"k"])[0].tolist() == [0, 1, 2]
