"""Words of Arrow text columns as 64-bit hashes, computed on whole byte buffers.

No Python string is made for a word. Temporary memory is bounded by BLOCK_BYTES, whatever the
length of a text; what is kept for a text is some 30 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
#: Texts handled at once: as many as have so many bytes, and one at least.
GROUP_BYTES = 1 << 20

_ODD = 0x9E3779B97F4A7C15
_BASE = 0xD6E8FEB86659FD93
_U64 = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SEEDS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))
#: Multipliers for the places of a window of words.
PLACES = mix(np.arange(1000, 1064, dtype=np.uint64) * np.uint64(_ODD)) | np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base & _U64, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


@dataclass(frozen=True)
class Alphabet:
    """Which bytes belong to words, and the value of each in a hash."""

    is_word: np.ndarray
    value: np.ndarray


def _alphabet(is_word: np.ndarray, fold: bool = True) -> Alphabet:
    value = _SEEDS.copy()
    if fold:
        value[65:91] = value[97:123]
    return Alphabet(is_word, value)


def _not_blank() -> np.ndarray:
    is_word = np.ones(256, bool)
    is_word[[0x20, *range(0x09, 0x0E)]] = False
    return is_word


def _letters() -> np.ndarray:
    is_word = np.zeros(256, bool)
    is_word[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
    return is_word


#: Runs without ASCII white space, A-Z as a-z.
TOKENS = _alphabet(_not_blank())
#: The same, letters as they are.
EXACT = _alphabet(_not_blank(), fold=False)
#: Runs of letters and digits; every byte of a character beyond ASCII counts as a letter.
WORDS = _alphabet(_letters())


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its texts in them; NULL is empty."""
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def text_groups(at: np.ndarray, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts that together have at most `limit` bytes, or are one text."""
    first, n = 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def slices(column: pa.Array, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each group of texts: first, last, its bytes and offsets."""
    data, at = text_buffer(column)
    for first, last in text_groups(at, limit):
        yield first, last, data[at[first] : at[last]], at[first : last + 1] - at[first]


@dataclass
class Words:
    """The words of a group of texts, in order: hash, text, first and last byte."""

    hashes: np.ndarray
    texts: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def per_text(self, n: int) -> np.ndarray:
        """Offsets of each text's words."""
        return np.searchsorted(self.texts, np.arange(n + 1))


def _block_end(inside: np.ndarray, lo: int, end: int) -> int:
    """A place to cut, at a separator; after the next one where a word is longer than a block."""
    hi = lo + BLOCK_BYTES
    if hi >= end:
        return end
    gaps = np.flatnonzero(~inside[lo:hi])
    while not len(gaps) and hi < end:
        lo, hi = hi, min(hi + BLOCK_BYTES, end)
        gaps = np.flatnonzero(~inside[lo:hi])
    return lo + int(gaps[-1]) + 1 if len(gaps) else end


def words(data: np.ndarray, at: np.ndarray, alphabet: Alphabet, inside: np.ndarray | None = None, head: int = 0) -> Words:
    """The words of the texts; no word spans two texts. `inside` replaces the alphabet's bytes;
    with `head`, hashes are of the first so many bytes and the length of a word."""
    inside = alphabet.is_word[data] if inside is None else inside
    n, lo, parts = len(data), 0, []
    while lo < n:
        hi = _block_end(inside, lo, n)
        here = inside[lo:hi]
        edges = at[np.searchsorted(at, lo, side="left") : np.searchsorted(at, hi, side="left")] - lo
        before = np.empty_like(here)
        before[0] = False
        before[1:] = here[:-1]
        before[edges] = False
        after = np.empty_like(here)
        after[-1] = False
        after[:-1] = here[1:]
        after[edges[edges > 0] - 1] = False
        starts, ends = np.flatnonzero(here & ~before), np.flatnonzero(here & ~after) + 1
        up, down = _power_tables(hi - lo)
        total = np.empty(hi - lo + 1, np.uint64)
        total[0] = 0
        np.cumsum(alphabet.value[data[lo:hi]] * up, out=total[1:])
        upto = np.minimum(starts + head, ends) if head else ends
        hashes = (total[upto] - total[starts]) * down[starts]
        parts.append((mix(hashes ^ ((ends - starts).astype(np.uint64) * np.uint64(_ODD))), starts + lo, ends + lo))
        lo = hi
    if not parts:
        none = np.empty(0, np.int64)
        return Words(np.empty(0, np.uint64), none, none, none)
    hashes, starts, ends = (np.concatenate(x) for x in zip(*parts, strict=True))
    return Words(hashes, np.searchsorted(at, starts, side="right") - 1, starts, ends)


def letters_inside(data: np.ndarray) -> np.ndarray:
    """Bytes of words, where punctuation of U+0080-U+00BF and U+2000-U+203F ends a word too."""
    inside = WORDS.is_word[data]
    if len(data) > 2:
        wide = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x80))
        for k in range(3):
            inside[wide + k] = False
        narrow = np.flatnonzero(data[:-1] == 0xC2)
        inside[narrow] = False
        inside[narrow + 1] = False
    return inside


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every `size` neighbours in a row of hashes, across texts too."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, size, np.uint64)
    for k in range(size):
        total += hashes[k : k + n] * PLACES[k]
    return mix(total)
