"""Public tokenizer vocabularies, by path; nothing is trained or copied here."""

from __future__ import annotations

import base64
import os

import numpy as np

END_ID = 0
SPECIAL = "<|endoftext|>"


def tokenizer_path(name: str = "byte_bpe_50k") -> str:
    """Path of a vocabulary without its suffix (``.json`` and ``.tiktoken`` hold the same one)."""
    import public_tokenizers

    return os.path.splitext(public_tokenizers.path(f"{name}.json"))[0]


class ByteBpe:
    """Ids of the byte-level BPE in ``<path>.json``.

    The same vocabulary and split pattern run as ranks (``<path>.tiktoken``), four
    times as fast; a test holds the ids of both equal. A text that spells a
    special token, which the JSON tokenizer reads as that token, takes the slow way.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(f"{path}.tiktoken", "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.path, self.slow = path, None

    def encode(self, text: str) -> np.ndarray:
        if SPECIAL in text:
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_file(f"{self.path}.json")
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.fast.encode_ordinary(text), np.uint32)

    def text_order(self) -> np.ndarray:
        """Each id's place in the order of the vocabulary's texts, word beginnings apart from the rest."""
        texts = [self.fast.decode_single_token_bytes(i) for i in range(self.fast.n_vocab)]
        order = sorted(range(len(texts)), key=lambda i: (texts[i][:1] == b" ", texts[i]))
        place = np.empty(len(order) + 1, np.int64)
        place[order] = np.arange(len(order))
        place[-1] = -1  # the special token
        return place
