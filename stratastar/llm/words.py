"""Words of whole texts as 64-bit hashes, computed over Arrow buffers without a Python object per word.

A word is a maximal run of bytes outside space and 0x09-0x0D. UTF-8 never holds those bytes
inside a longer character, so bytes and characters agree on where words are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is still handled whole.
CHUNK_BYTES = 1 << 19
CHUNK_ROWS = 2048

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of SplitMix64: every input bit reaches every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def stream(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit values."""
    with np.errstate(over="ignore"):
        return mix(_U(seed) + np.arange(1, n + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))


class Powers:
    """Powers of an odd base and of its inverse, modulo 2**64, as far as needed so far."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            m = len(self.up)
            self.up = np.concatenate([self.up, self.up * _U(pow(self.base, m, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * _U(pow(self.inverse, m, 1 << 64))])
        return self.up[:n], self.down[:n]

    def forget(self, most: int = 1 << 20) -> None:
        """Give back what one very long text needed."""
        if len(self.up) > most:
            self.up, self.down = self.up[:most].copy(), self.down[:most].copy()


_BYTES = Powers(0x9E3779B97F4A7C15 | 1)
GRAMS = Powers(0xD6E8FEB86659FD93 | 1)
GRAMS_2 = Powers(0xA0761D6478BD642F | 1)
#: Makes a second, independent value of each word.
OTHER = _U(0x2545F4914F6CDD1D)
_CODE = stream(11, 256)
_CODE_LOWER = _CODE.copy()
_CODE_LOWER[65:91] = _CODE[97:123]


def sums_between(values: np.ndarray, powers: Powers, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial of values[start:end] for every pair, independent of where the run lies."""
    n = len(values)
    up, down = powers.upto(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up[:n], out=total[1:])
    return (total[end] - total[start]) * down[start]


@dataclass(frozen=True)
class Words:
    """Words of the texts of one chunk. `first[i]:first[i + 1]` are the words of text i."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """Text number of every word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def grams(self, k: int, second: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Start word and hash of every run of k words inside one text."""
        n = len(self.hashes)
        if n < k:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        owner = self.owner()
        at = np.flatnonzero(owner[: n - k + 1] == owner[k - 1 :])
        values = mix(self.hashes ^ OTHER) if second else self.hashes
        return at, mix(sums_between(values, GRAMS_2 if second else GRAMS, at, at + k) + _U(k))


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """Words of the texts data[offsets[i]:offsets[i + 1]]; `lower` maps A-Z only."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(len(offsets), np.int64), np.zeros(0, np.uint64))
    inside = ~_IS_SPACE[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    # A word ends with its text: at the first byte of a text one may open, at the last one may close.
    length = np.diff(offsets)
    heads, tails = offsets[:-1][length > 0], offsets[1:][length > 0] - 1
    opens[heads] = inside[heads]
    closes[tails] = inside[tails]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    hashes = mix(sums_between((_CODE_LOWER if lower else _CODE)[data], _BYTES, start, end) ^ (end - start).astype(np.uint64))
    _BYTES.forget()
    return Words(data, start, end, np.searchsorted(start, offsets), hashes)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls are empty. No copy of the text."""
    wide = pa.types.is_large_string(column.type)
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, size: int = CHUNK_BYTES, rows: int = CHUNK_ROWS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with about `size` bytes of text, `rows` at most."""
    data, offsets = utf8(column)
    row, n = 0, len(column)
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        end = min(end, row + rows)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's bigint."""
    return x.view(np.int64)
