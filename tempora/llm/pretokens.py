"""Pre-tokens of the public byte-pair vocabularies and the pieces that one pre-token is encoded to.

The library for the .json files needs some 30 microseconds for a word it meets first; the ranked byte-pair encoder of
tiktoken gives the same pieces in about 2, so pre-tokens are encoded by that one.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata

import regex
import tiktoken

#: Unicode White_Space, as the patterns' \s has it (Python's has four control characters more).
SPACE = "\t-\r \x85\xa0  -     　"
#: Texts below this code point are cut by Python's re with spelt-out classes, others by regex.
LATIN_END = 0x250
#: Never part of UTF-8: marks the end of a word for vocabularies with word-end pieces.
WORD_END = b"\xff"

_not_latin = re.compile(f"[^\\x00-{chr(LATIN_END - 1)}]").search


def _latin(kind: str) -> str:
    return "".join(map(re.escape, (chr(c) for c in range(LATIN_END) if unicodedata.category(chr(c))[0] == kind)))


class Splitter:
    """Pre-tokens of a text by a pattern with the slots {L}, {N} and {S} for letters, numbers and space inside classes."""

    def __init__(self, pattern: str) -> None:
        self.latin = re.compile(pattern.format(L=_latin("L"), N=_latin("N"), S=SPACE)).findall
        self.every = regex.compile(pattern.format(L=r"\p{L}", N=r"\p{N}", S=SPACE)).findall

    def __call__(self, text: str) -> list[str]:
        return self.latin(text) if text.isascii() or not _not_latin(text) else self.every(text)


#: The two pre-token patterns as the vocabularies' files state them (fixed values).
BYTE_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
WORD_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[{L}]+|[{N}]|[^{S}{L}{N}]+"


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others, in order, from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or (b >= 161 and b != 173)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=4)
def load(path: str) -> tuple[tiktoken.Encoding, list[int], list[str], dict[str, int]]:
    """Encoder of single pre-tokens, the vocabulary's id of each of its ranks, special strings and the vocabulary's end mark."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, suffix = spec["model"]["vocab"], spec["model"].get("end_of_word_suffix") or ""
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    byte = _byte_of_char()

    def raw(piece: str) -> bytes:
        ends = bool(suffix) and piece.endswith(suffix)
        return bytes(byte[c] for c in (piece[: -len(suffix)] if ends else piece)) + (WORD_END if ends else b"")

    pieces = [c for c, _ in sorted(byte.items(), key=lambda x: x[1])]
    if suffix:
        pieces += [c + suffix for c in pieces[:-1]]
    pieces += ["".join(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
    ranks, ids = {}, []
    for piece in pieces:
        if (key := raw(piece)) not in ranks:
            ranks[key] = len(ids)
            ids.append(vocab.get(piece, -1))
    return tiktoken.Encoding(path, pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={}), ids, list(special), special


def special_splitter(special: list[str]) -> re.Pattern | None:
    """Splits a text at special strings, the longest first, keeping them."""
    return re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
