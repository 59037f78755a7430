"""Numpy helpers over the bytes of a batch of texts: fingerprints and minimizers.

A batch of texts is one byte array with offsets, as Arrow stores it, so all
work is vectorised over the batch rather than done text by text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_SHIFT = np.uint64(32)
# Position bits below the hash bits of a minimizer key; texts are cut into
# slices far shorter than this.
_POSITION_BITS = 32


def binary_slices(
    column: pa.Array | pa.ChunkedArray, budget: int = 1 << 18, overlap: int = 0, whole: bool = False
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive rows of a text column whose bytes stay near ``budget``.

    Yields the first row, the place of the bytes within it, the bytes and the
    rows' offsets (from 0). A row longer than 16 budgets comes alone, in pieces
    that share ``overlap`` bytes, so that memory does not follow the longest
    text, unless ``whole`` is set. NULL counts as empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    buffers, rows = column.buffers(), len(column)
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + rows + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    first = 0
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + budget, "right")) - 1
        last = min(max(first + 1, last), rows)
        piece = data[offsets[first] : offsets[last]]
        if last == first + 1 and len(piece) > 16 * budget and not whole:
            for at in range(0, max(1, len(piece) - overlap), 8 * budget):
                part = piece[at : at + 8 * budget + overlap]
                yield first, at, part, np.array([0, len(part)])
        else:
            yield first, 0, piece, offsets[first : last + 1] - offsets[first]
        first = last


def fingerprints(data: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """64-bit fingerprint of every ``length`` consecutive bytes, by doubling.

    Fingerprints of power-of-two lengths are combined from two halves; other
    lengths from two overlapping power-of-two pieces that cover them.
    """
    if len(data) < length:
        return np.empty(0, np.uint64)
    level = (data.astype(np.uint64) + np.uint64(seed + 1)) * _ODD
    level ^= level >> _SHIFT
    size = 1
    while size * 2 <= length:
        level = _combine(level[:-size], level[size:])
        size *= 2
    if size < length:
        level = _combine(level[: len(data) - length + 1], level[length - size :])
    return level


def _combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    out = left * _MIX
    out ^= out >> _SHIFT
    out += right
    out *= _ODD
    out ^= out >> _SHIFT
    return out


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, in two passes over blocks."""
    n = len(values)
    if n < width:
        return values[:0]
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])


def minimizers(grams: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest (leftmost when equal) of every ``width`` grams.

    Depends on the grams inside the window alone, so equal windows choose the
    same place, wherever they stand.
    """
    high = grams & np.uint64(~((1 << _POSITION_BITS) - 1) & (2**64 - 1))
    keys = high | np.arange(len(grams), dtype=np.uint64)
    return (sliding_minimum(keys, width) & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)
