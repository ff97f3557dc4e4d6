"""Vectorised word hashing over Arrow string arrays, shared by the operators that read whole texts inside tasks.

Texts are handled as UTF-8 bytes in pieces of bounded size, so memory follows the longest single text (about twelve
bytes per byte of it) and not the Arrow batch. Hashes are 64 bits wide and the same in every process.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 500_000  # bytes of texts handled together
CHUNK_BYTES = 1 << 16  # bytes hashed together, also inside a long text
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values(fold_case: bool) -> np.ndarray:
    codes = np.arange(256, dtype=np.uint64)
    if fold_case:
        codes[65:91] += np.uint64(32)
    return mix(codes + np.uint64(1))


_FOLDED, _EXACT = _byte_values(True), _byte_values(False)
def _powers(base: np.uint64) -> np.ndarray:
    steps = np.full(CHUNK_BYTES + 1, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


_POWER, _INVERSE = _powers(_BASE), _powers(_BASE_INVERSE)


def release() -> None:
    """Give memory that this task no longer needs back to the system; the worker process goes on to other tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc keeps freed memory for itself
        ctypes.CDLL(None).malloc_trim(0)


def as_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def pieces(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets) of runs of whole texts with about ``PIECE_BYTES`` bytes; null reads as empty."""
    column = as_array(column)
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + PIECE_BYTES, "right")) - 1)
        yield lo, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def _runs(inside: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of ``inside``; a run also begins wherever ``fresh`` is set."""
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    first = inside & (~before | fresh)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | fresh[1:]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Hashes of the stretches ``starts`` to ``ends``, ascending and apart, from sums over chunks of the bytes; a stretch
    that goes on in the next chunk carries its sum along."""
    out = np.zeros(len(starts), np.uint64)
    for lo in range(0, len(data), CHUNK_BYTES):
        piece = data[lo : lo + CHUNK_BYTES]
        a, b = np.searchsorted(ends, lo, "right"), np.searchsorted(starts, lo + len(piece))
        if a == b:
            continue
        total = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(values[piece] * _POWER[: len(piece)], out=total[1:])
        begin, end = np.maximum(starts[a:b] - lo, 0), np.minimum(ends[a:b] - lo, len(piece))
        part = (total[end] - total[begin]) * _INVERSE[begin]
        if starts[a] < lo:
            part[:1] *= np.array([pow(int(_BASE), lo - int(starts[a]), 1 << 64)], np.uint64)
        out[a:b] += part
    return mix(out + (ends - starts).astype(np.uint64) * _STEP)


def _row_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    fresh = np.zeros(len(data), bool)
    fresh[offsets[:-1][offsets[:-1] < len(data)]] = True
    return fresh


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the white-space separated words with A-Z lower-cased, and for each row the place of its first word."""
    starts, ends = _runs(~SPACE[data], _row_starts(data, offsets))
    return _hashes(data, starts, ends, _FOLDED), np.searchsorted(starts, offsets)


_KIND = np.full(256, 2, np.int8)  # 0 white space, 1 letters, digits and all non-ASCII bytes, 2 punctuation
_KIND[SPACE] = 0
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Like ``words`` for runs of letters and digits and runs of punctuation, upper case kept apart."""
    kind = _KIND[data]
    fresh = _row_starts(data, offsets)
    fresh[1:] |= kind[1:] != kind[:-1]
    starts, ends = _runs(kind > 0, fresh)
    return _hashes(data, starts, ends, _EXACT), np.searchsorted(starts, offsets)


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the runs of letters and digits with A-Z lower-cased, the place of each row's first, starts and ends."""
    starts, ends = _runs(_KIND[data] == 1, _row_starts(data, offsets))
    return _hashes(data, starts, ends, _FOLDED), np.searchsorted(starts, offsets), starts, ends


def shingle_sets(column: pa.Array | pa.ChunkedArray, width: int) -> Iterator[np.ndarray]:
    """For each text its ascending distinct ``width``-word shingle hashes.

    A text with fewer words has one shingle, its whole word sequence; a text without words or null has none.
    """
    for _, data, offsets in pieces(column):
        hashed, first = words(data, offsets)
        rolled = np.zeros(max(0, len(hashed) - width + 1), np.uint64)
        for k in range(width):
            rolled = rolled * _STEP + hashed[k : k + len(rolled)]
        rolled = mix(rolled)
        for a, b in zip(first[:-1], first[1:], strict=True):
            if b - a >= width:
                yield np.unique(rolled[a : b - width + 1])
            elif b > a:
                short = np.array([b - a], np.uint64)
                for value in hashed[a:b]:
                    short = mix(short * _STEP + value)
                yield short
            else:
                yield np.zeros(0, np.uint64)
