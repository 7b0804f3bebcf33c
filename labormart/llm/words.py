"""Vectorised word hashing over Arrow text batches.

Words are the maximal runs of ``[^\\x20\\x09-\\x0D]``. All texts of a slice are
handled at once as one byte array, so no Python object per word exists. Hashes
are 64 bit; every operator that uses them says what it relies on them for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; temporaries are about 40 times as large at most.
SLICE_BYTES = 2 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that all bits depend on all bits (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of the base, extended to the longest word seen."""

    def __init__(self) -> None:
        self.table = np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.table) < n:
            steps = np.full(max(n, 1024), _BASE, np.uint64)
            steps[0] = 1
            self.table = np.multiply.accumulate(steps)
        return self.table


_POWERS = _Powers()


def text_slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes each; a longer text makes a range of its own."""
    offsets = text_buffers(column)[1]
    start = 0
    while start < len(column):
        stop = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
        stop = min(max(stop, start + 1), len(column))
        yield start, stop
        start = stop


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n + 1 offsets; a null is empty."""
    wide = pa.types.is_large_string(column.type)
    if not wide and not pa.types.is_string(column.type):
        column, wide = column.cast(pa.large_string()), True
    if column.null_count:
        column = column.fill_null("")
    _, off, data = column.buffers()
    if len(column) == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    text = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return text, offsets.astype(np.int64)


def hash_words(text: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the documents ``text[offsets[i]:offsets[i+1]]``.

    Returns the hashes in order and, for each document, where its words start
    (n + 1 numbers). With ``lower``, A-Z count as a-z.
    """
    base, text = int(offsets[0]), text[offsets[0] : offsets[-1]]
    at = offsets - base
    n_docs = len(offsets) - 1
    if not len(text):
        return np.zeros(0, np.uint64), np.zeros(n_docs + 1, np.int64)
    inside = ~_SPACE[text]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = at[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(text))]
    first[cuts] = inside[cuts]  # a word never runs on into the next document
    starts = np.flatnonzero(first)
    bounds = np.searchsorted(starts, at)
    if not len(starts):
        return np.zeros(0, np.uint64), bounds
    stops = np.append(starts[1:], len(text))
    place = np.arange(len(text), dtype=np.int64)[starts[0] :] - np.repeat(starts, stops - starts)
    values = (_LOWER[text] if lower else text)[starts[0] :].astype(np.uint64) + np.uint64(1)
    values *= inside[starts[0] :]
    longest = int((stops - starts).max())
    values *= _POWERS.upto(longest)[place]
    return mix(np.add.reduceat(values, starts - starts[0])), bounds


def hash_windows(words: np.ndarray, width: int, salt: int = 0) -> np.ndarray:
    """Hash of every run of ``width`` consecutive word hashes (not aware of documents)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    factors = mix(np.arange(1, width + 1, dtype=np.uint64) + np.uint64(salt * 1000)) | np.uint64(1)
    out = words[:n] * factors[0]
    for i in range(1, width):
        out += words[i : i + n] * factors[i]
    return mix(out)
