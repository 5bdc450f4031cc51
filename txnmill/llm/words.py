"""Words of whole Arrow batches: positions and 64-bit hashes, computed with numpy on the UTF-8 buffer.

The tasks of several operators share these helpers. A batch is handled in chunks of about ``CHUNK`` bytes (a
longer text is a chunk of its own), so memory follows the longest text and not the batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 21
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def _odd(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed)) | U64(1)


STEP = _odd(64, 29)
BASE = U64(0x9E3779B97F4A7C15)
#: Words up to this many bytes are hashed piece by piece.
LONG = 128
#: Keeps the first 0 to 8 bytes of a little-endian piece.
PIECE = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)

#: Separators ``[\x20\x09-\x0D]``.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Separators of words of ``[0-9a-z]`` and all non-ASCII characters, after lower-casing A-Z.
MARKS = np.zeros(256, bool)
MARKS[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass
class Words:
    """``first[d]:first[d + 1]`` are the words of text ``d``; ``start`` and ``stop`` are byte positions in ``data``."""

    data: np.ndarray
    offsets: np.ndarray
    first: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    hash: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return ends, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, offsets from 0, bytes) of consecutive rows of about ``limit`` bytes."""
    if not len(column):
        return
    ends, data = buffers(column)
    row, n = 0, len(column)
    while row < n:
        to = min(n, max(row + 1, int(np.searchsorted(ends, ends[row] + limit, side="right")) - 1))
        yield row, to, ends[row : to + 1] - ends[row], data[ends[row] : ends[to]]
        row = to


def find(offsets: np.ndarray, data: np.ndarray, separators: np.ndarray = SPACES, lower: bool = False, hashes: bool = True) -> Words:
    """The words of the texts, in order. ``lower`` turns A-Z into a-z first."""
    if lower:
        data = LOWER[data]
    size = len(data)
    none = np.zeros(0, np.int64)
    if not size:
        return Words(data, offsets, np.zeros(len(offsets), np.int64), none, none, np.zeros(0, U64))
    inside = ~separators[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < size)]
    begins[edge] = inside[edge]
    ends[edge - 1] = inside[edge - 1]
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets)
    if not hashes or not len(start):
        return Words(data, offsets, first, start, stop, np.zeros(len(start), U64))
    return Words(data, offsets, first, start, stop, word_hashes(data, start, stop))


def word_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of each word from its eight-byte pieces; the few words over ``LONG`` bytes by a digest."""
    eight = np.ndarray((len(data) + 1,), "<u8", np.append(data, np.zeros(8, np.uint8)).tobytes(), strides=(1,))
    length = stop - start
    out = mix((eight[start] & PIECE[np.minimum(length, 8)]) + length.astype(U64) * BASE)
    left = np.flatnonzero((length > 8) & (length <= LONG))
    done = 8
    while len(left):
        piece = eight[start[left] + done] & PIECE[np.minimum(length[left] - done, 8)]
        out[left] = mix(out[left] * STEP[done // 8] + piece)
        done += 8
        left = left[length[left] > done]
    for i in np.flatnonzero(length > LONG).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[start[i] : stop[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """One hash for every ``n`` consecutive word hashes, whatever text they belong to."""
    if len(hashes) < n:
        return np.zeros(0, U64)
    out = np.full(len(hashes) - n + 1, n, U64)
    for k in range(n):
        out += hashes[k : len(hashes) - n + 1 + k] * STEP[k]
    return mix(out)


def windows(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``n``-word windows inside one text, and the first word of each."""
    every = rolling(words.hash, n)
    text = words.text
    within = np.flatnonzero(text[: len(every)] == text[n - 1 :]) if len(every) else np.zeros(0, np.int64)
    return every[within], within


def shingle_sets(words: Words, n: int) -> Iterator[np.ndarray]:
    """Per text, the sorted distinct hashes of its ``n``-word shingles; of fewer words, one hash of them all."""
    every = rolling(words.hash, n)
    for low, high in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if high - low >= n:
            found = np.sort(every[low : high - n + 1])
            yield found[np.append(True, found[1:] != found[:-1])]
        elif high > low:
            yield rolling(words.hash[low:high], high - low)
        else:
            yield np.zeros(0, U64)
