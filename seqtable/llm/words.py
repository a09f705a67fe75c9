"""Words and runs of words as 64-bit numbers, for all texts of a slice at a time in numpy.

Works on UTF-8 bytes: in both kinds of words below a byte of a multi-byte
character is a word byte, so bytes and characters give the same words.
"""

import numpy as np
import pyarrow as pa

from seqtable.llm.tables import mixed
from seqtable.llm.texts import utf8

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: Letters a-z, digits and everything beyond ASCII.
ALPHANUMERIC = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])
#: Everything but blanks and the control characters 9 to 13.
SOLID = ~np.isin(np.arange(256), [32, *range(9, 14)])
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64))
_BASE = np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
_NEXT = np.uint64(0xC2B2AE3D27D4EB4F)


def words(texts: pa.Array, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words (A-Z as a-z) in order, and the bounds of the texts among them."""
    data, offsets = utf8(texts)
    inside = is_word[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(data)]
    begins[firsts] = inside[firsts]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    gap = np.diff(starts, append=len(data))
    power = np.ones(int(gap.max()) + 1, np.uint64)
    power[1:] = np.multiply.accumulate(np.full(len(power) - 1, _BASE))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, gap)
    values = _BYTES[_LOWER[data[starts[0] :]]]
    values *= power[place]
    values[~inside[starts[0] :]] = 0
    return mixed(np.add.reduceat(values, starts - starts[0])), np.searchsorted(starts, offsets)


def runs(numbers: np.ndarray, length: int) -> np.ndarray:
    """The number of each run of `length` neighbouring words, by its first word; shorter by length - 1."""
    n = len(numbers) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = numbers[:n].copy()
    for k in range(1, length):
        total *= _NEXT
        total += numbers[k : n + k]
    return mixed(total)
