"""Byte-level BPE ids of whole texts.

Reads a tokenizer file and gives the ids that the tokenizers library gives for it (a test
holds them together), by the faster of two public encoders for the same vocabulary.
"""

from __future__ import annotations

import json
from functools import cache, cached_property

import numpy as np


def _byte_of() -> dict[str, int]:
    """Fixed by the file format: printable characters stand for their own byte, the other
    bytes for the characters from code point 256 on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Ids of texts by a byte-level BPE tokenizer file, without special tokens added.

    Special tokens that stand in a text are taken as such, as the tokenizers library does.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        byte = _byte_of()
        self.ranks = {
            bytes(byte[c] for c in token): rank
            for token, rank in content["model"]["vocab"].items()
            if token not in self.special
        }
        self.tokenizer = tiktoken.Encoding(
            path,
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks=self.ranks,
            special_tokens=self.special,
        )

    def ids(self, text: str) -> np.ndarray:
        found = self.tokenizer.encode(text, allowed_special="all")
        return np.fromiter(found, "<u4", len(found))

    @cached_property
    def byte_lengths(self) -> np.ndarray:
        """Length in UTF-8 bytes of the text of each id."""
        sizes = {**{v: len(k) for k, v in self.ranks.items()}}
        sizes |= {v: len(k.encode()) for k, v in self.special.items()}
        table = np.zeros(max(sizes) + 1, np.int64)
        table[list(sizes)] = list(sizes.values())
        return table


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)
