"""A minimal perfect hash of 64-bit keys: n keys, each with its own number from 0 to n - 1, in about four bits a key.

Levels of bits: a key is hashed into the first level, and its bit is set if no other key falls there; the others go to the
next level, and so on. The number of a key is the count of bits set before its own, so a look-up reads a few words. A key
that was not among those hashed gets some number or none: compare what is stored under it.
"""

from __future__ import annotations

import struct

import numpy as np

ROOM = 2  # bits for each key left on a level
_STEP = 512  # bits for each count that is kept


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each key: the finisher of splitmix64."""
    x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    def __init__(self, levels: list[np.ndarray]) -> None:
        """`levels`: bits, eight to a byte, each level a multiple of `_STEP` bits."""
        self.levels = levels
        self._counts, before = [], 0
        for level in levels:
            counts = np.bitwise_count(level.view(np.uint64)).astype(np.int64).reshape(-1, _STEP // 64).sum(1)
            self._counts.append(before + np.concatenate([[0], np.cumsum(counts)]))
            before = int(self._counts[-1][-1])
        self.size = before

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        """For distinct keys (int64 or uint64)."""
        left, levels = keys.view(np.uint64), []
        while len(left):
            bits = -(-ROOM * len(left) // _STEP) * _STEP
            at = mixed(left, len(levels)) % np.uint64(bits)
            alone = np.bincount(at.astype(np.int64), minlength=bits) == 1
            levels.append(np.packbits(alone, bitorder="little"))
            left = left[~alone[at.astype(np.int64)]]
        return cls(levels)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where a key is certainly not among those hashed."""
        keys = keys.view(np.uint64)
        out, open_at = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for n, (level, counts) in enumerate(zip(self.levels, self._counts)):
            at = (mixed(keys[open_at], n) % np.uint64(len(level) * 8)).astype(np.int64)
            found = (level[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
            at_found = at[found]
            words, word = level.view(np.uint64), at_found >> 6
            number = counts[at_found // _STEP]
            for back in range(1, _STEP // 64):
                within = (word % (_STEP // 64)) >= back
                number = number + np.where(within, np.bitwise_count(words[np.maximum(word - back, 0)]), 0)
            below = words[word] & ((np.uint64(1) << (at_found & 63).astype(np.uint64)) - np.uint64(1))
            out[open_at[found]] = number + np.bitwise_count(below)
            open_at = open_at[~found]
        return out

    def to_bytes(self) -> bytes:
        sizes = [len(x) for x in self.levels]
        return struct.pack(f"<I{len(sizes)}Q", len(sizes), *sizes) + b"".join(x.tobytes() for x in self.levels)

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        (n,) = struct.unpack_from("<I", data)
        sizes, at, levels = struct.unpack_from(f"<{n}Q", data, 4), 4 + 8 * n, []
        for size in sizes:
            levels.append(np.frombuffer(data[at : at + size], np.uint8).copy())
            at += size
        return cls(levels)
