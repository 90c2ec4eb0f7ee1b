"""Vocabulary files of byte-level BPE tokenizers and context-free pieces of text."""

from __future__ import annotations

import json
from collections.abc import Callable

import regex

VOCABULARY = "byte_bpe_50k.json"
#: How text is split before merges (fixed value of the public vocabulary).
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
CACHED_PIECES = 400_000


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary:
    printable Latin-1 bytes stand for themselves, the rest follow from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens as bytes, merges as pairs of ids, and special tokens of one file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letter = byte_letters()
        as_bytes = lambda s: bytes(letter[c] for c in s)
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = {as_bytes(t): i for t, i in vocab.items() if t not in self.special}
        self.merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])]
        self.labels = {i: t for t, i in self.ids.items()} | {i: t.encode() for t, i in self.special.items()}


class PieceEncoder:
    """Encodes texts piece by piece with a bounded memory of recent pieces.

    No token reaches across a single space between two other characters (the space
    opens the next token), so the parts between such spaces are encoded on their own;
    a text with other runs of white space next to a space is encoded as one piece.
    ``encode`` turns one piece into its ids as little-endian 32-bit integers.
    """

    def __init__(self, encode: Callable[[str], bytes], special: dict[str, int], cached: int = CACHED_PIECES) -> None:
        self.encode, self.special, self.cached = encode, special, cached
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def __call__(self, text: str) -> bytes:
        for token, i in self.special.items():
            if token in text:
                return i.to_bytes(4, "little").join([self(part) for part in text.split(token)])
        if not text:
            return b""
        parts = text.split(" ")
        out = list(map(self.recent.get, parts))
        out[0] = self.encode(parts[0]) if parts[0] else None
        if out[0] is None:
            return self.encode(text)
        if None in out:
            for i, part in enumerate(parts):
                if out[i] is None:
                    found = self._missing(part)
                    if found is None:
                        return self.encode(text)
                    out[i] = found
        elif parts[0][-1].isspace():
            return self.encode(text)
        return b"".join(out) if not parts[0][-1].isspace() else self.encode(text)

    def _missing(self, part: str) -> bytes | None:
        """Ids of a space and ``part``; None where it is no piece of its own."""
        if not part or part[0].isspace() or part[-1].isspace():
            return None
        found = self.recent.get(part) or self.older.get(part) or self.encode(" " + part)
        if len(self.recent) >= self.cached:
            self.older, self.recent = self.recent, {}
        self.recent[part] = found
        return found
