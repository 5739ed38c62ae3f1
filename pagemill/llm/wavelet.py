"""Wavelet matrix: token ids as bit planes with counts, read without unpacking.

Plane by plane, from the highest bit of the ids' rank among the distinct ids, the
sequence is parted into zeros and ones, each in order. ``rank`` (how often an id occurs
before a position), ``select`` (where its k-th occurrence is) and access walk the planes.

Layout, little-endian: magic, number of ids, number of distinct ids and of planes; the
distinct ids; for each plane its number of zeros, its bits in 64-bit words (low bit
first) and the ones before each block of 8 words.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"WVM1"
BLOCK = 8  # words of a counted block
_HEAD = "<4sQIB"


def pack(ids: np.ndarray) -> bytes:
    """The file of a sequence of unsigned 32-bit ids."""
    names, ranks = _distinct(ids)
    kind = np.uint16 if len(names) <= 1 << 16 else np.uint32
    levels = max(1, int(len(names) - 1).bit_length()) if len(names) else 0
    parts = [struct.pack(_HEAD, MAGIC, len(ids), len(names), levels), names.astype("<u4").tobytes()]
    values = ranks.astype(kind)
    padded = -(-len(ids) // 64) * 64
    for level in range(levels - 1, -1, -1):
        ones = (values >> level & 1).astype(bool)
        bits = np.zeros(padded, bool)
        bits[:len(ids)] = ones
        plane = np.packbits(bits, bitorder="little")
        zero, one = np.flatnonzero(~ones), np.flatnonzero(ones)
        parts += [struct.pack("<Q", len(zero)), plane.tobytes(), _before(plane).tobytes()]
        values = np.concatenate((values[zero], values[one]))
    return b"".join(parts)


def _distinct(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct ids and the rank of each; ids are small, so a table finds it."""
    if not len(ids):
        return np.zeros(0, np.uint32), np.zeros(0, np.uint32)
    if int(ids.max()) >= 1 << 22:
        names, ranks = np.unique(ids, return_inverse=True)
        return names.astype(np.uint32), ranks
    seen = np.zeros(int(ids.max()) + 1, bool)
    seen[ids] = True
    names = np.flatnonzero(seen).astype(np.uint32)
    table = np.zeros(len(seen), np.uint32)
    table[names] = np.arange(len(names), dtype=np.uint32)
    return names, table[ids]


def _before(plane: np.ndarray) -> np.ndarray:
    counts = np.bitwise_count(plane.view("<u8"))
    sums = np.add.reduceat(counts, np.arange(0, len(counts), BLOCK), dtype=np.uint32) if len(counts) else counts
    return (np.cumsum(sums, dtype=np.uint32) - sums).astype("<u4")


class WaveletMatrix:
    """Reads a packed file; positions and ids are numpy arrays or single numbers."""

    def __init__(self, data: bytes):
        magic, self.n, distinct, levels = struct.unpack_from(_HEAD, data)
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix")
        at = struct.calcsize(_HEAD)
        def take(kind, count):
            nonlocal at
            array = np.frombuffer(data, kind, count, at)
            at += array.nbytes
            return array
        self.names = take("<u4", distinct)
        words = -(-self.n // 64)
        self.planes = []
        for _ in range(levels):
            zeros = int(take("<u8", 1)[0])
            self.planes.append((zeros, take("<u8", words), take("<u4", -(-words // BLOCK))))

    def __len__(self) -> int:
        return self.n

    @staticmethod
    def _ones(plane, before, positions):
        """Ones in front of each position."""
        word = positions >> 6
        block = word // BLOCK
        count = before[np.minimum(block, len(before) - 1)].astype(np.int64)
        full = np.minimum(block, len(before) - 1) * BLOCK
        for k in range(BLOCK):
            inside = full + k < word
            count += np.where(inside, np.bitwise_count(plane[np.minimum(full + k, len(plane) - 1)]), 0).astype(np.int64)
        rest = (positions & 63).astype(np.uint64)
        mask = (np.uint64(1) << rest) - np.uint64(1)
        last = plane[np.minimum(word, len(plane) - 1)] & mask
        return count + np.where(word < len(plane), np.bitwise_count(last), 0).astype(np.int64)

    def access(self, positions) -> np.ndarray:
        """The ids at the positions."""
        at = np.atleast_1d(np.asarray(positions, np.int64)).copy()
        value = np.zeros(len(at), np.int64)
        for zeros, plane, before in self.planes:
            bit = (plane[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(np.int64)
            ones = self._ones(plane, before, at)
            at = np.where(bit == 1, zeros + ones, at - ones)
            value = value << 1 | bit
        return self.names[value]

    def _symbol(self, token: int) -> int | None:
        i = int(np.searchsorted(self.names, token))
        return i if i < len(self.names) and self.names[i] == token else None

    def rank(self, token: int, positions) -> np.ndarray:
        """Occurrences of ``token`` in front of each position."""
        at = np.atleast_1d(np.asarray(positions, np.int64)).copy()
        symbol = self._symbol(token)
        if symbol is None:
            return np.zeros(len(at), np.int64)
        start = np.zeros(1, np.int64)
        for level, (zeros, plane, before) in enumerate(self.planes):
            here = self._ones(plane, before, at)
            first = self._ones(plane, before, start)
            if symbol >> (len(self.planes) - 1 - level) & 1:
                at, start = zeros + here, zeros + first
            else:
                at, start = at - here, start - first
        return at - start

    def count(self, token: int) -> int:
        return int(self.rank(token, self.n)[0])

    def select(self, token: int, ks) -> np.ndarray:
        """Positions of the given occurrences of ``token``, counted from 0."""
        ks = np.atleast_1d(np.asarray(ks, np.int64))
        if not len(ks):
            return ks
        symbol = self._symbol(token)
        if symbol is None or (ks >= self.count(token)).any() or (ks < 0).any():
            raise IndexError("no such occurrence")
        start = np.zeros(1, np.int64)
        path = []
        for level, (zeros, plane, before) in enumerate(self.planes):
            bit = symbol >> (len(self.planes) - 1 - level) & 1
            first = self._ones(plane, before, start)
            path.append((bit, zeros, plane))
            start = zeros + first if bit else start - first
        at = start + ks
        for bit, zeros, plane in reversed(path):
            spots = np.flatnonzero(np.unpackbits(plane.view(np.uint8), bitorder="little", count=self.n) == bit)
            at = spots[at - zeros if bit else at]
        return at

    def find(self, token: int) -> np.ndarray:
        """All positions of ``token``."""
        return self.select(token, np.arange(self.count(token)))

    def unpack(self) -> np.ndarray:
        """All ids in order: the planes are merged back from the last to the first."""
        values = np.zeros(self.n, np.uint16 if len(self.names) <= 1 << 16 else np.uint32)
        for level, (zeros, plane, _) in enumerate(reversed(self.planes)):
            ones = np.unpackbits(plane.view(np.uint8), bitorder="little", count=self.n).view(bool)
            merged = np.empty_like(values)
            merged[np.flatnonzero(~ones)] = values[:zeros]
            merged[np.flatnonzero(ones)] = values[zeros:] | (1 << level)
            values = merged
        return self.names[values] if self.n else np.zeros(0, np.uint32)
