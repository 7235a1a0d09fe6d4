"""Minimal perfect hashing of 64-bit keys: levels of bit vectors, vectorised.

At each level the keys that are left hash into a vector of ``LOAD`` bits per key; those that land alone are settled,
the others go on. A key's number is the rank of its bit, so n keys get the numbers 0 to n - 1.
"""

from __future__ import annotations

import numpy as np

from quadrille.llm.words import mix

LOAD = 2
_SEED = 0xA0761D6478BD642F


def fingerprints(keys: np.ndarray) -> np.ndarray:
    """32 bits of each key that no level uses for its place."""
    return (mix(keys.astype(np.int64).view(np.uint64) ^ np.uint64(0xE7037ED1A0B428DB)) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        ones = [np.bitwise_count(level).astype(np.int64) for level in levels]
        self.ranks, total = [], 0
        for count in ones:
            self.ranks.append(total + np.concatenate(([0], np.cumsum(count)[:-1])))
            total += int(count.sum())
        self.size = total

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """Of distinct keys."""
        left, levels = keys.astype(np.int64).view(np.uint64), []
        while len(left):
            bits = -(-LOAD * len(left) // 64) * 64
            place = cls._place(left, len(levels), bits)
            alone = np.bincount(place, minlength=bits)[place] == 1
            level = np.zeros(bits, np.uint8)
            level[place[alone]] = 1
            levels.append(np.packbits(level, bitorder="little").view("<u8"))
            left = left[~alone]
        return cls(levels)

    @staticmethod
    def _place(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
        seed = np.uint64(_SEED * (level + 1) & 0xFFFFFFFFFFFFFFFF)
        return (mix(keys ^ seed) % np.uint64(bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key; -1, or any number, for keys that were not built in."""
        keys = keys.astype(np.int64).view(np.uint64)
        out = np.full(len(keys), -1, np.int64)
        open_at = np.arange(len(keys))
        for n, level in enumerate(self.levels):
            place = self._place(keys[open_at], n, 64 * len(level))
            word, bit = level[place >> 6], (place & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            out[open_at[hit]] = self.ranks[n][place[hit] >> 6] + np.bitwise_count(below[hit])
            open_at = open_at[~hit]
        return out

    def to_bytes(self) -> bytes:
        head = np.array([len(self.levels), *map(len, self.levels)], "<i8")
        return head.tobytes() + b"".join(level.tobytes() for level in self.levels)

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        count = int(np.frombuffer(data, "<i8", 1)[0])
        sizes = np.frombuffer(data, "<i8", count, 8)
        at, levels = 8 * (count + 1), []
        for size in sizes:
            levels.append(np.frombuffer(data, "<u8", int(size), at))
            at += 8 * int(size)
        return cls(levels)
