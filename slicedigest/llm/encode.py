"""Byte-level BPE ids of whole texts, for the operators that count or pack tokens."""

from __future__ import annotations

import base64
import json
import os
import re
from array import array
from functools import lru_cache

import numpy as np

MEMO_ENTRIES = 200_000
"""Words whose ids a worker keeps; a full table is emptied."""
MEMO_CHARS = 64
"""Longest word that is kept."""


def default_ranks() -> str:
    """The rank form of the 50k byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def added_tokens(ranks_path: str) -> tuple[tuple[str, int], ...]:
    """The added tokens and their ids of the JSON form that lies beside the rank form; none if it is not there."""
    path = os.path.splitext(ranks_path)[0] + ".json"
    if not os.path.exists(path):
        return ()
    with open(path, encoding="utf-8") as file:
        found = json.load(file).get("added_tokens") or []
    if any(t[flag] for t in found for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"{path}: added tokens that match by more than their text are not supported")
    return tuple((t["content"], t["id"]) for t in found)


class _Memo(dict):
    """Ids of a word as little-endian 32-bit bytes, made when first asked for."""

    def __init__(self, encode, lead: str):
        super().__init__()
        self.encode, self.lead = encode, lead

    def __missing__(self, word: str) -> bytes:
        ids = array("I", self.encode(self.lead + word)).tobytes()
        if len(word) <= MEMO_CHARS:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    """Encodes texts word by word where the pattern allows it.

    The vocabulary's pattern attaches one space to the word behind it and makes a lone line feed a piece of its own, so a
    text whose white space is single spaces and line feeds splits into words that encode apart from each other, and a word
    need be encoded once. Any other text is encoded as it is. Texts are split at ``added`` tokens first, the longest where
    several start, and the parts between encode apart; without them, strings that look like special tokens are ordinary text.
    """

    def __init__(self, ranks_path: str, added: tuple[tuple[str, int], ...] = ()):
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._bpe = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._plain, self._spaced = _Memo(self._bpe.encode_ordinary, ""), _Memo(self._bpe.encode_ordinary, " ")
        self._feed = self._plain["\n"]
        self.byte_lengths = np.zeros(max([*ranks.values(), *dict(added).values()]) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self.byte_lengths[rank] = len(token)
        for token, rank in added:
            self.byte_lengths[rank] = len(token.encode())
        longest_first = "|".join(re.escape(t) for t, _ in sorted(added, key=lambda t: -len(t[0])))
        self._split = re.compile(f"({longest_first})").split if added else None
        self._added = {token: array("I", [rank]).tobytes() for token, rank in added}

    @property
    def plain(self):
        """The vocabulary itself, without added tokens."""
        return self._bpe

    def ids(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        if self._split and any(token in text for token in self._added):
            return b"".join(self._added.get(part) or self._ordinary(part) for part in self._split(text) if part)
        return self._ordinary(text)

    def _ordinary(self, text: str) -> bytes:
        if " ".join(text.split()) != text.replace("\n", " "):
            return array("I", self._bpe.encode_ordinary(text)).tobytes()
        spaced, lines = self._spaced.__getitem__, []
        for line in text.split("\n"):
            words = line.split(" ")
            lines.append(self._plain[words[0]] + b"".join(map(spaced, words[1:])))
        return self._feed.join(lines)


@lru_cache(maxsize=2)
def encoder(ranks_path: str, added: tuple[tuple[str, int], ...] = ()) -> Encoder:
    """One encoder per worker and vocabulary."""
    return Encoder(ranks_path, added)
