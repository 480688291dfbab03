"""A wavelet matrix over token ids: one bit-plane per id bit, highest first;
each plane holds that bit of the sequence as the planes above have reordered
it (zeros before ones, stable).  Rank on a plane is a directory lookup and a
popcount, so access, counting and finding the occurrences of a token take one
rank or select per plane and never unpack the sequence."""

from __future__ import annotations

import struct

import numpy as np

BLOCK = 512                      # bits per entry of the rank directory
MAGIC = b"TWWM"


class WaveletMatrix:
    def __init__(self, n: int, bits: int, planes: list[np.ndarray]):
        self.n, self.bits = n, bits
        self.planes = planes      # packed bits, highest id bit first, padded to whole blocks
        self._zeros: list[int] | None = None
        self._ranks: list[np.ndarray] = []

    # ------------------------------------------------------------- building
    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> "WaveletMatrix":
        x = ids.astype(np.uint16 if bits <= 16 else np.uint32, copy=True)
        one, planes = x.dtype.type(1), []
        for k in range(bits - 1, -1, -1):
            bit = (x >> x.dtype.type(k)) & one
            planes.append(cls._padded(np.packbits(bit.astype(np.uint8))))
            if k:
                mask = bit.astype(bool)
                x = np.concatenate((x.take(np.flatnonzero(~mask)), x.take(np.flatnonzero(mask))))
        return cls(len(ids), bits, planes)

    @staticmethod
    def _padded(packed: np.ndarray) -> np.ndarray:
        short = -len(packed) % (BLOCK // 8)
        return np.concatenate((packed, np.zeros(short, np.uint8))) if short else packed

    # -------------------------------------------------------------- the file
    def to_bytes(self) -> bytes:
        """Header, then each plane as a zstd frame."""
        import zstandard
        pack = zstandard.ZstdCompressor(level=1).compress
        frames = [pack(p.tobytes()) for p in self.planes]
        return b"".join([MAGIC, struct.pack("<QI", self.n, self.bits), struct.pack(f"<{self.bits}Q", *map(len, frames)), *frames])

    @classmethod
    def from_bytes(cls, data: bytes) -> "WaveletMatrix":
        import zstandard
        if data[:4] != MAGIC:
            raise ValueError("not a wavelet matrix file")
        n, bits = struct.unpack_from("<QI", data, 4)
        sizes = struct.unpack_from(f"<{bits}Q", data, 16)
        at, planes, unpack = 16 + 8 * bits, [], zstandard.ZstdDecompressor()
        for s in sizes:
            planes.append(np.frombuffer(unpack.decompress(data[at:at + s]), np.uint8))
            at += s
        return cls(n, bits, planes)

    def decode(self) -> np.ndarray:
        """The whole sequence, from the lowest plane up."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        v = np.zeros(self.n, kind)
        for k, plane in enumerate(reversed(self.planes)):
            bit = np.unpackbits(plane, count=self.n).view(bool)
            ones = np.flatnonzero(bit)
            z = self.n - len(ones)
            w = np.empty(self.n, kind)
            w[np.flatnonzero(~bit)] = v[:z]
            w[ones] = v[z:] | kind(1 << k)
            v = w
        return v

    # -------------------------------------------------------- rank and select
    def _directory(self) -> None:
        if self._zeros is None:
            for p in self.planes:
                per_block = np.bitwise_count(p).reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.int64)
                self._ranks.append(np.concatenate(([0], np.cumsum(per_block))))
            self._zeros = [self.n - int(r[-1]) for r in self._ranks]

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        b = i // BLOCK
        at, rest = b * (BLOCK // 8), i - b * BLOCK
        part = self.planes[level][at:at + (rest + 7) // 8]
        r = int(self._ranks[level][b])
        if rest:
            r += int(np.bitwise_count(part[:rest // 8]).sum())
            if rest % 8:
                r += int(part[rest // 8] >> (8 - rest % 8)).bit_count()
        return r

    def _select(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) one or zero of a plane."""
        ranks = self._ranks[level]
        if bit:
            b = int(np.searchsorted(ranks, k, side="right")) - 1
            k -= int(ranks[b])
        else:
            zeros = np.arange(len(ranks)) * BLOCK - ranks
            b = int(np.searchsorted(zeros, k, side="right")) - 1
            k -= int(zeros[b])
        at = b * (BLOCK // 8)
        block = np.unpackbits(self.planes[level][at:at + BLOCK // 8])
        return b * BLOCK + int(np.flatnonzero(block == bit)[k])

    def access(self, i: int) -> int:
        """The token at position i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        self._directory()
        value = 0
        for level, plane in enumerate(self.planes):
            bit = int(plane[i // 8] >> (7 - i % 8)) & 1
            ones = self._rank1(level, i)
            i = self._zeros[level] + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, begin: int, end: int) -> tuple[int, int]:
        self._directory()
        if token >> self.bits:
            return 0, 0
        for level in range(self.bits):
            lo, hi = self._rank1(level, begin), self._rank1(level, end)
            if token >> (self.bits - 1 - level) & 1:
                begin, end = self._zeros[level] + lo, self._zeros[level] + hi
            else:
                begin, end = begin - lo, end - hi
        return begin, end

    def rank(self, token: int, i: int) -> int:
        """Occurrences of a token among the first i positions."""
        a, b = self._range(token, 0, min(i, self.n))
        return b - a

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of a token."""
        a, b = self._range(token, 0, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        i = a + k
        for level in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - level) & 1
            i = self._select(level, bit, i - self._zeros[level] if bit else i)
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]
