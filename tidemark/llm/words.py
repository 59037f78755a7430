"""Words of a batch of texts as numpy arrays: places and 64-bit fingerprints."""

from __future__ import annotations

import numpy as np

_MULTIPLIER = 0x5851F42D4C957F2D
_INVERSE = pow(_MULTIPLIER, -1, 2**64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_SHIFT = np.uint64(32)
# Powers of the multiplier and its inverse for that many bytes; grown on demand.
_POWERS: dict[str, np.ndarray] = {}


def _byte_table(separators: bytes, lower: bool) -> np.ndarray:
    """A random value for each byte, 0 marking separators."""
    table = np.random.default_rng(20_240_607).integers(1, 2**63, 256, dtype=np.uint64)
    if lower:
        table[0x41:0x5B] = table[0x61:0x7B]
    table[list(separators)] = 0
    return table


# Words are what stands between white space, taken as it is ...
BLANK_SEPARATED = _byte_table(bytes([0x20, *range(0x09, 0x0E)]), lower=False)
BLANK_SEPARATED_LOWER = _byte_table(bytes([0x20, *range(0x09, 0x0E)]), lower=True)
# ... or runs of letters, digits and all bytes beyond ASCII, with A-Z lower-cased.
ALPHANUMERIC = _byte_table(
    bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]), lower=True
)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 19)
        for name, base in (("up", _MULTIPLIER), ("down", _INVERSE)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _POWERS[name] = np.multiply.accumulate(factors)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mixed(values: np.ndarray) -> np.ndarray:
    out = values ^ (values >> _SHIFT)
    out = out * _MIX
    out ^= out >> _SHIFT
    return out * _ODD


def words_of(
    data: np.ndarray, offsets: np.ndarray, table: np.ndarray = ALPHANUMERIC
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint, first byte, end byte of every word, and each text's word offsets.

    Words never cross the texts' offsets. Equal words have equal fingerprints.
    """
    n = len(data)
    values = table[data]
    inside = np.zeros(n + 1, bool)
    inside[:n] = values != 0
    bounds = np.zeros(n + 1, bool)
    bounds[offsets] = True
    before = np.append(False, inside[:-1])
    starts = np.flatnonzero(inside & (~before | bounds))
    ends = np.flatnonzero(before & (~inside | bounds))
    up, down = _powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up, out=sums[1:])
    marks = (sums[ends] - sums[starts]) * down[starts] if n else np.empty(0, np.uint64)
    return mixed(marks), starts, ends, np.searchsorted(starts, offsets)


def shingles(marks: np.ndarray, word_offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of ``size`` consecutive words with each text's offsets.

    A text of fewer words, but not none, has one shingle of all of them.
    """
    n = len(marks)
    out = marks[: max(0, n - size + 1)].copy()
    for j in range(1, size):
        out = mixed(out) + marks[j : j + len(out)]
    counts = np.diff(word_offsets)
    full = np.maximum(counts - size + 1, 0)
    at = np.repeat(word_offsets[:-1], full) + _within(full)
    out = out[at]
    owners = np.repeat(np.arange(len(counts)), full)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        single = np.empty(len(short), np.uint64)
        for i, row in enumerate(short):
            mark = marks[word_offsets[row] : word_offsets[row] + 1]
            for j in range(word_offsets[row] + 1, word_offsets[row + 1]):
                mark = mixed(mark) + marks[j : j + 1]
            single[i] = mixed(mark + np.uint64(counts[row]))[0]
        order = np.argsort(np.append(owners, short), kind="stable")
        out = np.append(out, single)[order]
        full[short] = 1
    return mixed(out), np.append(0, np.cumsum(full))


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... inside each group of the given sizes."""
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
