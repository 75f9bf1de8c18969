"""Tokenising whole texts: the ids of the tokenizers library, at a rate that a corpus needs.

The library's own encoder spends 10 to 20 microseconds on a word. A BPE vocabulary is fully described by its ranks,
which are read from the same tokenizer file here and merged by tiktoken, some four times faster:

- byte-level vocabularies: texts are split by the vocabulary's pattern, as both libraries do;
- word vocabularies (small letters, end-of-word tokens): texts of ASCII and Latin letters are split into words by the
  same rules; a word's end is written as a space, which no word holds.

Which way a text goes depends on the text alone, by rules that the tests prove sign by sign: texts that hold the
string of an added token, very long runs of white space, or (word vocabularies) other signs are encoded by the
library itself.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

#: Longer runs of white space go through the library: the pattern's look-ahead walks back over a run.
LONG_WHITE = 10_000
_LONG_WHITE = re.compile(r"\s{%d}" % LONG_WHITE)
#: Signs for which lower-casing and the split below are those of the library: ASCII and Latin letters.
_PLAIN_TEXT = re.compile("[ \t\n\r\x21-\x7e\xc0-\xd6\xd8-\xf6\xf8-įı-ňŊ-ſ]*").fullmatch
#: Letters, single digits, English endings behind an apostrophe, other signs: the order does not matter between kinds.
_PIECES = re.compile(r"[^\W\d_]+|\d|'(?:s|t|re|ve|m|ll|d)|(?:[^\s\w]|_)+").findall
#: Signs that stand behind words in plain prose, and what else such a text holds after lower-casing. There a space
#: before each sign is all that splits the words; a sign with something right behind it needs the rules above.
_STOPS = ",.;:|?!"
_PROSE = frozenset(" \t\n\rabcdefghijklmnopqrstuvwxyz" + "".join(map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0x100)])) + _STOPS)
_TIGHT = re.compile(r"[,.;:|?!](?=\S)").search
_ENCODERS: dict[tuple[str, str], ByteEncoder | WordEncoder] = {}


def _byte_of() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return out | {chr(256 + k): b for k, b in enumerate(rest)}


class _Encoder:
    """encode(texts) -> (ids uint32 of all texts in a row, ids per text)."""

    def __init__(self, path: str, end: str, pattern: str) -> None:
        import tiktoken

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"] for t in spec["added_tokens"]]
        byte_of = _byte_of()
        ranks: dict[bytes, int] = {}
        for token, number in spec["model"]["vocab"].items():
            if token not in self.added:
                last = bool(end) and token.endswith(end)
                ranks[bytes(byte_of[c] for c in (token[: -len(end)] if last else token)) + (b" " if last else b"")] = number
        self.ranks = ranks
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def library(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def is_fast(self, text: str) -> bool:
        return not any(a in text for a in self.added) and not (len(text) >= LONG_WHITE and _LONG_WHITE.search(text))

    def merged(self, text: str) -> list[int]:
        return self.fast.encode_ordinary(text)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        coded = [np.array(self.merged(t) if self.is_fast(t) else self.library(t), np.uint32) for t in texts]
        return np.concatenate([*coded, np.array([], np.uint32)]), np.fromiter(map(len, coded), np.int64, len(coded))


class ByteEncoder(_Encoder):
    """A byte-level vocabulary."""

    def __init__(self, path: str) -> None:
        import public_tokenizers

        super().__init__(path, "", public_tokenizers.PATTERN)

    def plain(self, text: str) -> list[int]:
        """Ids of a text in which the strings of added tokens are plain text; the tokenizer has encode_special_tokens set."""
        if len(text) >= LONG_WHITE and _LONG_WHITE.search(text):
            return self.library(text)
        return self.fast.encode_ordinary(text)

    def token_bytes(self) -> list[bytes]:
        """The bytes of each id; an added token has those of its string."""
        by_id = {number: token for token, number in self.ranks.items()} | {self.tokenizer.token_to_id(t): t.encode() for t in self.added}
        return [by_id[k] for k in range(max(by_id) + 1)]


class WordEncoder(_Encoder):
    """A vocabulary of small-letter words with end-of-word tokens."""

    def __init__(self, path: str) -> None:
        super().__init__(path, "</w>", r"[^ ]+ ")

    def is_fast(self, text: str) -> bool:
        return _PLAIN_TEXT(text) is not None and super().is_fast(text)

    def merged(self, text: str) -> list[int]:
        return self.fast.encode_ordinary(self._spaced(text.lower()))

    @staticmethod
    def _spaced(text: str) -> str:
        """The text with white space behind every piece; the pattern drops further spaces."""
        if not _PROSE.issuperset(text) or _TIGHT(text):
            return " ".join([*_PIECES(text), ""])
        for white in "\n\t\r":
            text = text.replace(white, " ")
        for stop in _STOPS:
            if stop in text:
                text = text.replace(stop, f" {stop}")
        return text + " "


def unit_encoder(path: str, kind: str) -> ByteEncoder | WordEncoder:
    """The encoder of a tokenizer file, one per worker; kind: byte or word."""
    if (path, kind) not in _ENCODERS:
        _ENCODERS[path, kind] = (ByteEncoder if kind == "byte" else WordEncoder)(path)
    return _ENCODERS[path, kind]
