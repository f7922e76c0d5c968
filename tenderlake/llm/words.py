"""Vectorised words and hashes of whole texts, used inside Arrow tasks.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D. These bytes are
never part of a longer UTF-8 character, so words of the encoded text are the
words of the text.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], np.uint64)
_U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 bits."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def constants(n: int, seed: int) -> np.ndarray:
    """n odd multipliers derived from a seed."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) + _U(seed)) | _U(1)


@dataclass
class Words:
    """Words of a run of texts: byte range, position of the text, and the bytes themselves."""

    data: np.ndarray  #: bytes of all texts, with 8 bytes of padding
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray  #: ordinal of the text that holds the word
    first: np.ndarray  #: ordinal of each text's first word, and at last the number of words
    begin: np.ndarray  #: byte at which each text begins, and at last their end

    def hashes(self) -> np.ndarray:
        view = np.ndarray((len(self.data) - 7,), "<u8", self.data, strides=(1,))
        left = self.ends - self.starts
        h = left.astype(np.uint64) * _U(0x9E3779B97F4A7C15)
        at, pos = np.arange(len(left)), self.starts
        while len(at):
            chunk = view[pos] & _MASKS[np.minimum(left, 8)]
            x = (h[at] ^ chunk) * _U(0xD6E8FEB86659FD93)
            h[at] = x ^ (x >> _U(32))
            keep = left > 8
            at, pos, left = at[keep], pos[keep] + 8, left[keep] - 8
        return mix(h)

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and their offsets; null counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool = False, separators: np.ndarray = SEPARATOR) -> Words:
    n = len(data)
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = LOWER[data] if lower else data
    inside = np.zeros(n + 1, bool)
    inside[:n] = ~separators[padded[:n]]
    fresh = np.zeros(n + 1, bool)  # a text begins here
    fresh[offsets] = True
    before = np.zeros(n + 1, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (fresh | ~before))
    ends = np.flatnonzero(before & (fresh | ~inside))
    doc = np.searchsorted(offsets, starts, "right") - 1
    first = np.searchsorted(starts, offsets)
    return Words(padded, starts, ends, doc, first, offsets)


def slices(offsets: np.ndarray, most: int = 4 << 20):
    """Ranges of texts of about ``most`` bytes, or one longer text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = j


def windows(h: np.ndarray, doc: np.ndarray, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the n words that start at each word, and whether all of them are of one text."""
    size = max(0, len(h) - n + 1)
    out = np.zeros(size, np.uint64)
    for j, c in enumerate(constants(n, seed)):
        out += h[j : j + size] * c
    return mix(out), doc[:size] == doc[n - 1 : n - 1 + size]
