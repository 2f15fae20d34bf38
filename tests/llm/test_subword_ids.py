"""Words encoded together get the ids they get alone."""

import duckdb
import numpy as np

from lakevault.llm.lm_score import _ids
from lakevault.llm.tokens import ByteBpe, tokenizer_path
from tests.llm.helpers import SF, words


def test_words_together_have_the_ids_they_have_alone():
    bpe = ByteBpe(tokenizer_path("byte_bpe_50k"))
    texts = duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet' WHERE text IS NOT NULL").fetchall()
    found = sorted({w for (t,) in texts for w in words(t)})
    odd = ["'s", "don't", "a b", " ", "\u0085x", "x ", "\x1c", "12a-b", "…", "�", "<|endoftext|>", "''ll", "é́", "　字"]
    for chosen in (found, odd, [*odd, *found[:50], *odd], []):
        chosen = [w.encode() for w in chosen]
        alone = [bpe.fast.encode_ordinary(" " + w.decode()) for w in chosen]
        ids, lengths = _ids(bpe, chosen)
        assert lengths.tolist() == [len(a) for a in alone]
        assert ids.tolist() == [i for a in alone for i in a] and ids.dtype == np.int64
