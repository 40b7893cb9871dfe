"""Rolling hashes of byte and word sequences in numpy, one text at a time.

A text is a polynomial over 64-bit words modulo 2**64.  Prefix sums give the
hash of any stretch, so all stretches of one length cost one subtraction each.
Long texts are worked on in blocks; memory stays a small multiple of a block.
"""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 2**64)
BLOCK = 1 << 20
_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_NO_WORDS = np.zeros(0, np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words after which every bit depends on all input bits."""
    values = values ^ (values >> np.uint64(30))
    values = values * _MIX_A
    values = values ^ (values >> np.uint64(27))
    values = values * _MIX_B
    return values ^ (values >> np.uint64(31))


def _powers(base: int, count: int) -> np.ndarray:
    steps = np.full(count, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


BYTE_CODES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
_cache: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    have = _cache.get(base)
    if have is None or len(have) < count:
        have = _cache[base] = _powers(base, max(count, 1 << 14))
    return have[:count]


class Stretches:
    """Hashes of stretches of one code sequence (uint64 codes)."""

    def __init__(self, codes: np.ndarray):
        self.size = len(codes)
        self.sums = np.zeros(self.size + 1, np.uint64)
        np.cumsum(codes * powers(BASE, self.size), out=self.sums[1:])

    def all(self, length: int) -> np.ndarray:
        """The hash of the stretch of ``length`` codes at every start."""
        if self.size < length:
            return _NO_WORDS
        starts = self.size - length + 1
        return mixed((self.sums[length:] - self.sums[:starts]) * powers(BASE_INVERSE, starts))

    def at(self, starts: np.ndarray, length: int) -> np.ndarray:
        return mixed((self.sums[starts + length] - self.sums[starts]) * powers(BASE_INVERSE, self.size + 1)[starts])


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


#: ASCII characters other than letters and digits
MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def _block_words(data: np.ndarray, between: np.ndarray) -> np.ndarray:
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~between[data]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(starts):
        return _NO_WORDS
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODES[LOWER[data]] * powers(BASE, len(data)), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * powers(BASE_INVERSE, len(data))[starts])


def word_hashes(text: str | None, between: np.ndarray = SPACE) -> np.ndarray:
    """One hash per word, A-Z lower-cased; words are what ``between`` separates (ASCII space).  Null has no words."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    if len(data) <= BLOCK:
        return _block_words(data, between)
    parts, at = [], 0
    while at < len(data):
        end = min(len(data), at + BLOCK)
        while end < len(data):  # a block ends at a space
            spaces = np.flatnonzero(between[data[at:end]])
            if len(spaces):
                end = at + int(spaces[-1]) + 1
                break
            end = min(len(data), end + BLOCK)
        parts.append(_block_words(data[at:end], between))
        at = end
    return np.concatenate(parts)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of ``width`` words in a row; fewer words count as one shingle."""
    if not len(words):
        return _NO_WORDS
    if len(words) < width:
        return mixed(Stretches(words).sums[-1:] + np.uint64(len(words)))
    total = words[: len(words) - width + 1].copy()
    for step in range(1, width):
        total *= np.uint64(BASE)
        total += words[step : len(words) - width + 1 + step]
    return np.unique(mixed(total))
