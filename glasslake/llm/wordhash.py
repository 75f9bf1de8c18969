"""Words of whole Arrow string columns as numpy arrays: one pass over the bytes, no Python object per word."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

WHITE, DIGIT, LETTER, SIGN = 0, 1, 2, 3
KIND = np.full(256, LETTER, np.uint8)  # bytes of non-ASCII letters count as letters
KIND[:128] = SIGN
KIND[[9, 10, 11, 12, 13, 32]] = WHITE
KIND[ord("0") : ord("9") + 1] = DIGIT
for low, high in (("a", "z"), ("A", "Z")):
    KIND[ord(low) : ord(high) + 1] = LETTER
#: Value of a byte in a word's hash: capitals as small letters, signs do not count.
VALUE = np.arange(1, 257, dtype=np.uint64)
VALUE[ord("A") : ord("Z") + 1] += 32
VALUE[KIND == SIGN] = 0
STEP = np.uint64(0x9E3779B97F4A7C15)


def _plane() -> tuple[np.ndarray, np.ndarray]:
    """Small form (of the same length in UTF-8) and kind of each code point of the basic plane."""
    small, kind = np.arange(0x10000), np.full(0x10000, LETTER, np.uint8)
    for c in range(0x80, 0x10000):
        sign = chr(c)
        low = sign.lower()
        if len(low) == 1 and low != sign and (ord(low) < 0x800) == (c < 0x800) and ord(low) >= 0x80:
            small[c] = ord(low)
        if unicodedata.category(sign)[0] not in "LNM":
            kind[c] = WHITE if sign.isspace() else SIGN
    return small, kind


SMALL, PLANE_KIND = _plane()
#: Whether the code point of a two-byte character (Latin, Greek, Cyrillic, Armenian) is a capital.
UPPER = np.array([c >= 0x80 and chr(c).isupper() for c in range(0x800)])


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), STEP, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@dataclass
class Words:
    """Words with at least one letter or digit, in order over all texts."""

    hash: np.ndarray  # uint64 of the letters, marks and digits, small letters
    doc: np.ndarray  # number of the text
    start: np.ndarray  # first byte, from the start of the buffer
    end: np.ndarray
    number: np.ndarray  # holds a digit
    capital: np.ndarray  # begins with a capital of Latin, Greek or Cyrillic script
    closes: np.ndarray  # ends with . ! or ?, or ends its text
    data: np.ndarray  # the bytes


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, and the bounds of its texts in them."""
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    bounds = np.frombuffer(column.buffers()[1], width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None and bounds[-1] > bounds[0] else np.empty(0, np.uint8)
    return data, bounds - bounds[0]


def fold(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with small letters in place of capitals outside ASCII, and the kind of each byte."""
    kind = KIND[data]
    if not (data >= 0x80).any():
        return data, kind
    out = data.copy()
    two, three = np.flatnonzero((data >= 0xC2) & (data <= 0xDF)), np.flatnonzero((data >= 0xE0) & (data <= 0xEF))
    if len(two):
        c = (data[two].astype(np.int64) & 0x1F) << 6 | data[two + 1] & 0x3F
        kind[two] = kind[two + 1] = PLANE_KIND[c]
        c = SMALL[c]
        out[two], out[two + 1] = 0xC0 | c >> 6, 0x80 | c & 0x3F
    if len(three):
        c = (data[three].astype(np.int64) & 0x0F) << 12 | (data[three + 1].astype(np.int64) & 0x3F) << 6 | data[three + 2] & 0x3F
        kind[three] = kind[three + 1] = kind[three + 2] = PLANE_KIND[c]
        c = SMALL[c]
        out[three], out[three + 1], out[three + 2] = 0xE0 | c >> 12, 0x80 | c >> 6 & 0x3F, 0x80 | c & 0x3F
    return out, kind


def _unspaced(data: np.ndarray) -> np.ndarray:
    """First bytes of characters of scripts that set no spaces: kana and Han (lead bytes E3 to E9), Thai and Lao."""
    lead = (data >= 0xE3) & (data <= 0xE9)
    lead[:-1] |= (data[:-1] == 0xE0) & (data[1:] >= 0xB8) & (data[1:] <= 0xBB)
    return lead


def words(column: pa.Array, chars: bool = False) -> Words:
    """Words between white space; with chars each character of a script without spaces is a word of its own."""
    data, bounds = text_bytes(column)
    small, kind = fold(data)
    solid = kind != WHITE
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    heads = bounds[:-1][bounds[:-1] < bounds[1:]]
    begins[heads] = solid[heads]
    if chars and (lead := _unspaced(data)).any():
        begins |= lead
        begins[3:] |= lead[:-3] & solid[3:]  # these characters have three bytes
    start = np.flatnonzero(begins)
    if not len(start):
        none = np.empty(0, np.int64)
        return Words(none.astype(np.uint64), none, none, none, none.astype(bool), none.astype(bool), none.astype(bool), data)
    doc = np.searchsorted(bounds, start, side="right") - 1
    # a word ends before white space, the next word or its text's end
    white = np.append(np.flatnonzero(~solid), len(data))
    end = np.minimum(white[np.searchsorted(white, start)], np.minimum(np.append(start[1:], len(data)), bounds[doc + 1]))
    keeps = (kind == LETTER) | (kind == DIGIT)
    before = np.cumsum(keeps) - keeps
    word = np.cumsum(begins) - 1
    at = before - before[start][np.maximum(word, 0)]
    value = VALUE[small] * solid
    power = powers(int(at.max(initial=0)) + 1)
    h = np.add.reduceat(value * power[np.maximum(at, 0)] * keeps, start)
    number = np.maximum.reduceat(kind == DIGIT, start)
    full = np.add.reduceat(keeps.astype(np.int64), start) > 0
    first = data[start]
    last = data[end - 1]
    closes = (last == ord(".")) | (last == ord("!")) | (last == ord("?"))
    closes[:-1] |= doc[1:] != doc[:-1]
    closes[-1] = True
    capital = (first >= ord("A")) & (first <= ord("Z"))
    wide = np.flatnonzero((first >= 0xC3) & (first <= 0xD5))
    if len(wide):
        capital[wide] = UPPER[(first[wide].astype(np.int64) & 0x1F) << 6 | data[start[wide] + 1].astype(np.int64) & 0x3F]
    pick = np.flatnonzero(full)
    return Words(mix(h[pick]), doc[pick], start[pick], end[pick], number[pick], capital[pick], closes[pick], data)


def windows(values: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every window of n words inside one text."""
    m = len(values) - n + 1
    if m <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    power = powers(n)
    h = np.zeros(m, np.uint64)
    for k in range(n):
        h += values[k : k + m] * power[k]
    first = np.flatnonzero(doc[:m] == doc[n - 1 :])
    return first, mix(h[first])


def code_points(data: np.ndarray, base: int, at: np.ndarray) -> np.ndarray:
    """Code points between byte `base` and each of the bytes `at` (ascending not needed)."""
    lead = np.cumsum((data & 0xC0) != 0x80)
    lead = np.append(0, lead)
    return lead[at] - lead[base]
