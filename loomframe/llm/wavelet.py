"""Wavelet matrix over token ids: bit-planes with rank and select, and its bytes."""

from __future__ import annotations

import struct

import numpy as np
import zstandard

# Bits between two stored ranks.
RANK_STEP = 512
MAGIC = b"LFWM1\x00"


class WaveletMatrix:
    """Ids of one shard as bit-planes, the highest bit first.

    A plane holds one bit of every id; ids with a 0 are placed before those with a 1 in the next plane, their order
    kept. With ranks stored every RANK_STEP bits, access, rank and count read one word and one stored rank per plane.
    """

    def __init__(self, n: int, planes: list[np.ndarray]):
        self.n, self.planes = n, planes
        self.levels = len(planes)
        self.ranks, self.zeros = [], []
        for p in planes:
            ones = np.bitwise_count(np.concatenate([p, np.zeros(-len(p) % (RANK_STEP // 8), np.uint8)]).view(np.uint64))
            self.ranks.append(np.concatenate([[0], np.cumsum(ones.reshape(-1, RANK_STEP // 64).sum(axis=1, dtype=np.int64))]))
            self.zeros.append(n - int(self.ranks[-1][-1]))

    @classmethod
    def of(cls, ids: np.ndarray, levels: int | None = None) -> WaveletMatrix:
        if levels is None:
            levels = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        v = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        planes = []
        for shift in range(levels - 1, -1, -1):
            bit = (v & v.dtype.type(1 << shift)) != 0
            planes.append(np.packbits(bit, bitorder="little"))
            if shift:
                v = np.concatenate([np.compress(~bit, v), np.compress(bit, v)])  # a mask as an index takes eight times as long
        return cls(len(ids), planes)

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        block = i // RANK_STEP
        first, last = block * (RANK_STEP // 8), i // 8
        plane = self.planes[level]
        total = int(self.ranks[level][block]) + int(np.bitwise_count(plane[first:last]).sum())
        if i % 8:
            total += (int(plane[last]) & ((1 << (i % 8)) - 1)).bit_count()
        return total

    def access(self, i: int) -> int:
        """The id at position i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(self.levels):
            bit = (int(self.planes[level][i // 8]) >> (i % 8)) & 1
            ones = self._ones(level, i)
            i = self.zeros[level] + ones if bit else i - ones
            value = value * 2 + bit
        return value

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        """Where the occurrences of a token between two positions lie after the last plane."""
        for level in range(self.levels):
            a, b = self._ones(level, start), self._ones(level, end)
            if (token >> (self.levels - 1 - level)) & 1:
                start, end = self.zeros[level] + a, self.zeros[level] + b
            else:
                start, end = start - a, end - b
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of a token in positions start to end (end not included)."""
        if token < 0 or token >> self.levels:
            return 0
        a, b = self._range(token, start, self.n if end is None else end)
        return b - a

    def _nth(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) bit of that value in a plane."""
        stored = self.ranks[level] if bit else np.arange(len(self.ranks[level])) * RANK_STEP - self.ranks[level]
        block = int(np.searchsorted(stored, k, side="right")) - 1
        bits = np.unpackbits(self.planes[level][block * (RANK_STEP // 8):(block + 1) * (RANK_STEP // 8)], bitorder="little")
        bits = bits[: self.n - block * RANK_STEP]
        return block * RANK_STEP + int(np.flatnonzero(bits == bit)[k - int(stored[block])])

    def select(self, token: int, k: int) -> int:
        """Position of the k-th occurrence (from 0) of a token; -1 if there are fewer."""
        if k < 0 or k >= self.count(token):
            return -1
        at = self._range(token, 0, self.n)[0] + k
        for level in range(self.levels - 1, -1, -1):
            bit = (token >> (self.levels - 1 - level)) & 1
            at = self._nth(level, bit, at - self.zeros[level] if bit else at)
        return at

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def to_array(self) -> np.ndarray:
        """All ids in order: planes are undone from the last to the first."""
        kind = np.uint16 if self.levels <= 16 else np.uint32
        v = np.zeros(self.n, kind)
        for level in range(self.levels - 1, -1, -1):
            bit = np.unpackbits(self.planes[level], bitorder="little")[: self.n].view(bool)
            out, z = np.empty(self.n, kind), self.zeros[level]
            out[np.flatnonzero(~bit)] = v[:z]
            out[np.flatnonzero(bit)] = v[z:] | kind(1 << (self.levels - 1 - level))
            v = out
        return v

    def to_bytes(self) -> bytes:
        body = b"".join(p.tobytes() for p in self.planes)
        return MAGIC + struct.pack("<QB", self.n, self.levels) + zstandard.ZstdCompressor(level=1).compress(body)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        if data[: len(MAGIC)] != MAGIC:
            raise ValueError("not a token shard")
        n, levels = struct.unpack_from("<QB", data, len(MAGIC))
        body = zstandard.ZstdDecompressor().decompress(data[len(MAGIC) + 9:])
        step = (n + 7) // 8
        planes = [np.frombuffer(body, np.uint8, step, level * step) for level in range(levels)]
        return cls(n, planes)
