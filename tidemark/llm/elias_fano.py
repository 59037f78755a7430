"""Elias-Fano lists: rising whole numbers in near-minimal space, with a directory for select.

A list of ``n`` numbers up to ``u`` keeps the lowest ``log2(u / n)`` bits of each one as they are,
and the rest in unary: the bit ``high + k`` is set for the k-th number. That is about two bits
and the low ones per number. The place of every 256th set bit is kept too, in 32 bits, so that the
k-th number is found from the sample before it without reading the list.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
_HEADER = struct.Struct("<QBQQQ")  # numbers, low bits, then bytes of low bits, high bits and samples


class EliasFano:
    """A list read from bytes; nothing is unpacked before it is asked for."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        """A list of unsigned numbers that never fall; empty lists and repeated numbers are fine."""
        values = np.asarray(values, np.uint64)
        n = len(values)
        if n == 0:
            nothing = np.empty(0, np.uint8)
            return cls(0, 0, nothing, nothing, np.empty(0, np.uint32))
        if (values[1:] < values[:-1]).any():
            raise ValueError("the numbers have to rise")
        low_bits = max(0, (int(values[-1]) // n).bit_length() - 1)
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(
            ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little"
        )
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(places[-1]) + 1, np.uint8)
        bits[places] = 1
        if len(bits) > 2**32:
            raise ValueError("too long for places of 32 bits")
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"), places[::SAMPLE].astype(np.uint32))

    def to_bytes(self) -> bytes:
        parts = [np.ascontiguousarray(a).tobytes() for a in (self.low, self.high, self.samples)]
        return _HEADER.pack(self.n, self.low_bits, *map(len, parts)) + b"".join(parts)

    @classmethod
    def from_buffer(cls, data: memoryview, at: int) -> tuple[EliasFano, int]:
        """The list that begins at a place of the data, and where it ends."""
        n, low_bits, *lengths = _HEADER.unpack_from(data, at)
        at += _HEADER.size
        arrays = []
        for length, kind in zip(lengths, (np.uint8, np.uint8, np.dtype("<u4"))):
            arrays.append(np.frombuffer(data[at : at + length], kind))
            at += length
        return cls(n, low_bits, *arrays), at

    def select(self, ranks) -> np.ndarray:
        """The numbers of the given ranks (from 0), from the samples next to them."""
        ranks = np.asarray(ranks, np.int64)
        if len(ranks) == 0:
            return np.empty(0, np.uint64)
        if ranks.min() < 0 or ranks.max() >= self.n:
            raise IndexError("no such number in the list")
        blocks, which = np.unique(ranks // SAMPLE, return_inverse=True)
        places = np.empty(len(ranks), np.int64)
        order = np.argsort(which, kind="stable")
        ends = np.cumsum(np.bincount(which, minlength=len(blocks)))
        for i, block in enumerate(blocks.tolist()):
            mine = order[ends[i - 1] if i else 0 : ends[i]]
            first = int(self.samples[block])
            last = int(self.samples[block + 1]) if block + 1 < len(self.samples) else len(self.high) * 8
            bits = np.unpackbits(self.high[first // 8 : -(-last // 8)], bitorder="little")
            ones = np.flatnonzero(bits[first % 8 : first % 8 + last - first])
            places[mine] = first + ones[ranks[mine] - block * SAMPLE]
        high = (places - ranks).astype(np.uint64) << np.uint64(self.low_bits)
        return high | self._low(ranks)

    def _low(self, ranks: np.ndarray) -> np.ndarray:
        out = np.zeros(len(ranks), np.uint64)
        for bit in range(self.low_bits):
            at = ranks * self.low_bits + bit
            out |= ((self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.uint64) << np.uint64(bit)
        return out
