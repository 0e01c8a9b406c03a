"""Ids of a public byte-level BPE, from its vocabulary file.

The file's entries, read as bytes, are the ranks of the merges, so the ids are those that the library of
the file's own format gives (the tests hold the two together); this coder needs a quarter of its time.
"""

from __future__ import annotations

import json

import numpy as np
import public_tokenizers
import regex
import tiktoken

#: The splitting pattern of the vocabulary (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same for another library, whose own white space has four control characters more.
PARTS = regex.compile(PATTERN.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_names() -> dict[str, int]:
    """The character that stands for each byte in the file: printable ones themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


#: The fast coder's regular expressions give up on white space of some 700,000 characters; runs from this length on go apart.
LONG = 1 << 16
_SPACES = regex.compile(r"\p{White_Space}{2,}+")


class Encoder:
    """Text to ids, special tokens' names being ordinary text; ids as one int32 array. Texts and runs of one character may have any length."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        names, special = _byte_names(), {t["content"] for t in said.get("added_tokens", [])}
        ranks = {bytes(names[c] for c in word): n for word, n in said["model"]["vocab"].items() if word not in special}
        self._ranks, self._one = ranks, None
        self._coder = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def array(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        return np.array(self.ids(text), np.int32)

    def ids(self, text: str | None) -> list[int]:
        if not text:
            return []
        return self._coder.encode_ordinary(text) if len(text) < LONG else self._long(text)

    def count(self, part: str) -> int:
        return len(self.ids(part))

    def _long(self, text: str) -> list[int]:
        """Long runs of white space as the parts that they are by the pattern: all of one but its last character, or all at the text's end."""
        out, at = [], 0
        for m in _SPACES.finditer(text):
            if m.end() - m.start() >= LONG:
                end = m.end() if m.end() == len(text) else m.end() - 1
                if self._one is None:
                    self._one = tiktoken.Encoding("part", pat_str="(?s:.+)", mergeable_ranks=self._ranks, special_tokens={})
                out += self._coder.encode_ordinary(text[at : m.start()]) + self._one.encode_ordinary(text[m.start() : end])
                at = end
        return out + self._coder.encode_ordinary(text[at:])
