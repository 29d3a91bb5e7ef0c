"""Token ids of texts by a public byte-level BPE vocabulary.

A space that a visible character follows always starts a new pretoken, so the stretches between
such spaces are encoded on their own and remembered per worker. The ids are those of the vocabulary's
own tokenizer (held against it in the tests), at a quarter of its time.
"""

from __future__ import annotations

import base64
import re
from functools import cache

import numpy as np
import public_tokenizers
import tiktoken

VOCABULARY = "byte_bpe_50k"
#: Fixed value: the text that the vocabulary's own tokenizer reads as its closing id, wherever it stands.
END_TEXT = "<|endoftext|>"
#: Stretches that a worker remembers before it starts over.
REMEMBERED = 400_000
_LOOSE = re.compile(r" (?=\s|\Z)")


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes.

    ``END_TEXT`` in a text is its id if ``added`` is set, as the tokenizer has it, and text like any other if not.
    """

    def __init__(self, ranks_file: str, added: bool = False):
        with open(ranks_file, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.end, self.added = len(ranks), added
        encode = self._raw

        class Known(dict):
            def __missing__(self, stretch: str) -> bytes:
                if len(self) >= REMEMBERED:
                    self.clear()
                found = self[stretch] = encode(" " + stretch)
                return found

        self.known = Known()

    def _raw(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), dtype="<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.added and END_TEXT in text:
            end = np.array([self.end], dtype="<u4").tobytes()
            return end.join(map(self._encode, text.split(END_TEXT)))
        return self._encode(text)

    def _encode(self, text: str) -> bytes:
        if not text:
            return b""
        if _LOOSE.search(text):
            return self._raw(text)
        first, *rest = text.split(" ")
        return self._raw(first) + b"".join(map(self.known.__getitem__, rest))


@cache
def encoder(ranks_file: str | None = None, added: bool = False) -> Encoder:
    """The worker's encoder; by default of the vocabulary named above, where the package has it."""
    return Encoder(ranks_file or public_tokenizers.path(f"{VOCABULARY}.tiktoken"), added)
