"""Token ids of whole texts, and cutting of overlong documents."""

from __future__ import annotations

import json
from functools import cache, cached_property

import numpy as np

# Fixed value: the public byte-level split, in its possessive form (no backtracking).
PIECES = (
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@cache
def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    return Encoder(path)


class Encoder:
    """Byte-level BPE of a `tokenizers` file, with the ids that library gives.

    The merges of such a file rank as its ids do, so the faster `tiktoken` gives the same ids;
    a text that holds the string of a special token goes through `tokenizers` itself.
    """

    def __init__(self, path: str):
        import tiktoken

        self._path = path
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self._special = [t["content"] for t in described["added_tokens"]]
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(visible)]
        byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {
            bytes(byte_of[c] for c in token): i
            for token, i in described["model"]["vocab"].items()
            if token not in self._special
        }
        self._bpe = tiktoken.Encoding(
            "ranks", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={}
        )

    @cached_property
    def _whole(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self._path)

    def encode(self, text: str) -> np.ndarray:
        if any(s in text for s in self._special):
            return np.array(self._whole.encode(text, add_special_tokens=False).ids, np.uint32)
        return self._bpe.encode_to_numpy(text, disallowed_special=())


def cuts(n: int, width: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: only the first may be shorter than the width."""
    first = (n - 1) % width + 1
    return [(0, first)] + [(s, width) for s in range(first, n, width)]
