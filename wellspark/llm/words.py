"""Words of many texts as byte ranges and 64-bit hashes, with NumPy over Arrow buffers.

A word is a maximal run of bytes of a class. The classes used here are code-point classes whose
members above U+007F are either all in or all out, so runs of UTF-8 bytes are the same runs.
Hashes are of 64 bits: two different words of a corpus share one with a chance of about
(distinct words) squared / 2**65.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
STEP = np.uint64(0xD1342543DE82EF95)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: Bytes of words between ASCII white space: [^\x20\x09-\x0D]
BETWEEN_SPACES = np.ones(256, dtype=bool)
BETWEEN_SPACES[[0x20, *range(0x09, 0x0E)]] = False

#: Bytes of words of letters and digits, after lower-casing: [^\x00-\x2F\x3A-\x60\x7B-\x7F]
LETTERS_DIGITS = np.zeros(256, dtype=bool)
LETTERS_DIGITS[0x30:0x3A] = True
LETTERS_DIGITS[0x61:0x7B] = True
LETTERS_DIGITS[0x80:] = True

NOT_NEWLINE = np.ones(256, dtype=bool)
NOT_NEWLINE[0x0A] = False


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array without nulls, and the borders of its texts."""
    wide = pa.types.is_large_string(texts.type)
    _, borders, data = texts.buffers()
    borders = np.frombuffer(borders, dtype=np.int64 if wide else np.int32)
    borders = borders[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[borders[0] : borders[-1]], borders - borders[0]


def runs(inside: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``inside`` within each text, and the first run per text."""
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = borders[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(inside))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, borders)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, BASE, dtype=np.uint64)
    down = np.full(n, INVERSE, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of uint64 values spread over the whole word; one to one."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A uint64 hash for each byte range; it depends on the range's bytes alone."""
    size = 1 << max(20, int(len(data)).bit_length())
    up, down = _powers(size)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[np.minimum(starts, size - 1)])


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash for each ``width`` consecutive words, whatever texts they belong to."""
    n = max(0, len(words) - width + 1)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(width):
        out *= STEP
        out += words[j : j + n]
    return mixed(out)


def row_of(first: np.ndarray) -> np.ndarray:
    """The text of each word, from the first word of each text."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def sums_by_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of word values over each text."""
    total = np.zeros(len(values) + 1, dtype=np.int64 if values.dtype != np.float64 else np.float64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in any of the ranges."""
    change = np.bincount(starts, minlength=n + 1)[: n + 1] - np.bincount(ends, minlength=n + 1)[: n + 1]
    return np.cumsum(change)[:n] > 0


def repeated(values: np.ndarray) -> np.ndarray:
    """Which values occur twice or more."""
    order = np.argsort(values)
    ranked = values[order]
    same = ranked[1:] == ranked[:-1]
    out = np.zeros(len(values), dtype=bool)
    out[order[1:]] = same
    out[order[:-1]] |= same
    return out


def range_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash for each range of words, at a cost that does not depend on the ranges' lengths."""
    size = 1 << max(20, int(len(words)).bit_length())
    up, down = _powers(size)
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[np.minimum(starts, size - 1)])
