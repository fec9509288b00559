"""Texts of an Arrow batch as one byte buffer, cut into words by numpy.

Shared by the operators that hash words or look pieces up: a batch is taken
in chunks of whole texts, each chunk is one ``uint8`` array, and every step
is a pass over that array instead of a loop over words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Arrays of a chunk take some hundred times its bytes in a worker.
CHUNK_BYTES = 1 << 18
_RADIX = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_BYTE_CODES = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def text_chunks(column, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of whole texts of about
    ``chunk_bytes``; a longer text is a chunk of its own."""
    buf, off = text_buffer(column)
    n, first = len(off) - 1, 0
    while first < n:
        last = int(np.searchsorted(off, off[first] + chunk_bytes, side="right")) - 1
        last = min(n, max(last, first + 1))
        yield first, buf[off[first]:off[last]], off[first:last + 1] - off[first]
        first = last


_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the radix and of its inverse modulo 2^64."""
    global _powers, _inverse
    if len(_powers) < n:
        size = max(n, CHUNK_BYTES + 1)
        step = np.full(size, _RADIX, np.uint64)
        step[0] = 1
        _powers = np.cumprod(step)
        step[1:] = np.uint64(pow(int(_RADIX), -1, 1 << 64))
        _inverse = np.cumprod(step)
    return _powers[:n], _inverse[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (bijective)."""
    h = h ^ (h >> np.uint64(33))
    h = h * _MIX
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(32)
    return h


def hasher(buf: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Function of (starts, ends) that hashes byte spans [start, end) of
    ``buf`` to 64 bits, equal bytes to equal hashes; the pass over the bytes is
    made once for all its calls."""
    powers, inverse = _power_tables(len(buf) + 1)
    prefix = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[buf] * powers[:len(buf)], out=prefix[1:])

    def hashes(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (prefix[ends] - prefix[starts]) * inverse[starts]
        return mix(h + (ends - starts).astype(np.uint64))
    return hashes


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every byte span [start, end), equal bytes equal hash."""
    return hasher(buf)(starts, ends) if len(starts) else np.zeros(0, np.uint64)


_WORD_SPACE = np.zeros(256, bool)
_WORD_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_spans(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words before each text) of words ``[^\\x20\\x09-\\x0D]+``;
    a word never crosses a text."""
    word = ~_WORD_SPACE[buf]
    if not word.any():
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    first = word.copy()
    first[1:] &= ~word[:-1]
    inner = off[1:-1]
    inner = inner[inner < len(buf)]
    first[inner] = word[inner]
    last = word.copy()
    last[:-1] &= ~word[1:]
    before = inner[inner > 0] - 1
    last[before] = word[before]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]
