"""Elias-Fano coding of ascending integers: upper bits in unary, lower bits as they are.

With n values below u, the lower log2(u / n) bits of each are stored plainly (in whole bytes) and the upper ones as a bit
vector with a one per value and a zero per step: about 2 bits a value. The zeros find where an upper part begins without
decoding what is before it, so a successor is found by a short search among equal upper parts.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<QBQ")


def encode(values: np.ndarray) -> bytes:
    """Bytes of ascending unsigned 64-bit values."""
    values = np.asarray(values, dtype=np.uint64)
    n, top = len(values), int(values[-1]) if len(values) else 0
    low_bytes = min(8, -(-max(0, (top // max(n, 1)).bit_length()) // 8))
    upper = (values >> np.uint64(8 * low_bytes)) if low_bytes < 8 else np.zeros(n, dtype=np.uint64)
    bits = np.zeros(n + (int(upper[-1]) if n else 0) + 1, dtype=np.uint8)
    bits[upper.astype(np.int64) + np.arange(n)] = 1
    low = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :low_bytes]
    return _HEAD.pack(n, low_bytes, len(bits)) + np.packbits(bits).tobytes() + low.tobytes()


class Sequence:
    """Values coded by ``encode``, at a position of a buffer (bytes or a mapped file)."""

    def __init__(self, buffer, at: int = 0):
        self.n, self.low_bytes, n_bits = _HEAD.unpack_from(buffer, at)
        at += _HEAD.size
        packed = np.frombuffer(buffer, np.uint8, -(-n_bits // 8), at)
        at += len(packed)
        zeros = np.flatnonzero(np.unpackbits(packed, count=n_bits) == 0)
        #: How many values have a smaller upper part, for every upper part and one more.
        self.first = np.concatenate([[0], zeros - np.arange(len(zeros))])
        #: Lower parts, left where they are in the buffer.
        self.planes = np.frombuffer(buffer, np.uint8, self.n * self.low_bytes, at).reshape(self.n, self.low_bytes)
        self.end = at + self.planes.size

    def low(self, index: np.ndarray) -> np.ndarray:
        """The lower parts at positions."""
        wide = np.zeros((len(index), 8), dtype=np.uint8)
        wide[:, : self.low_bytes] = self.planes[index]
        return wide.view("<u8").ravel()

    def values(self, index: np.ndarray) -> np.ndarray:
        """The values at positions."""
        upper = np.searchsorted(self.first, index, side="right") - 1
        shift = 8 * self.low_bytes
        return (upper.astype(np.uint64) << np.uint64(shift) if shift < 64 else np.uint64(0)) | self.low(index)

    def successor(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position of the first value that is not smaller, whether it is equal), for each wanted value."""
        shift = 8 * self.low_bytes
        upper = wanted >> np.uint64(shift) if shift < 64 else np.zeros(len(wanted), dtype=np.uint64)
        beyond = upper >= np.uint64(len(self.first) - 1)
        upper = np.where(beyond, 0, upper).astype(np.int64)
        low = wanted & np.uint64((1 << shift) - 1)
        at, stop = self.first[upper], self.first[upper + 1]
        ends = stop.copy()
        open_ = np.flatnonzero(at < stop)
        while len(open_):
            middle = (at[open_] + stop[open_]) // 2
            less = self.low(middle) < low[open_]
            at[open_[less]] = middle[less] + 1
            stop[open_[~less]] = middle[~less]
            open_ = open_[at[open_] < stop[open_]]
        equal = ~beyond & (at < ends)
        equal[equal] = self.low(at[equal]) == low[equal]
        return np.where(beyond, self.n, at), equal
