"""A minimal perfect hash over the keys of one bucket, with fingerprints.

Levels of bits: at each level the keys that are left are hashed into twice as many places,
those alone at their place set its bit, the others go on to the next level.  The slot of a
key is the rank of its bit over all levels, so n keys have the slots 0 .. n-1; a stored
fingerprint tells keys of the set from others.  A lookup tests two levels on average.
"""

from __future__ import annotations

import struct

import numpy as np

LEVELS = 48
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A bijective mix of 64-bit keys, another one for each seed."""
    x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (2 * seed + 1)) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 1_000) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = np.cumsum([0] + [int(b.sum()) for b in levels])
        self.ranks = [np.cumsum(b) - b for b in levels]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """Of distinct 64-bit keys."""
        levels, left = [], keys.astype(np.uint64)
        for level in range(LEVELS):
            if not len(left):
                break
            place = (mixed(left, level) % np.uint64(2 * len(left))).astype(np.int64)
            hits = np.bincount(place, minlength=2 * len(left))
            levels.append((hits == 1).astype(np.int64))
            left = left[hits[place] > 1]
        if len(left):
            raise ValueError("keys are not distinct")
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 for keys that certainly are not in the set."""
        keys = keys.astype(np.uint64)
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            place = (mixed(keys[left], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[place] == 1
            out[left[hit]] = self.before[level] + self.ranks[level][place[hit]]
            left = left[~hit]
        return out

    def to_bytes(self) -> bytes:
        head = struct.pack(f"<{1 + len(self.levels)}I", len(self.levels), *map(len, self.levels))
        return head + b"".join(np.packbits(b.astype(bool)).tobytes() for b in self.levels)

    @classmethod
    def from_bytes(cls, raw: bytes) -> PerfectHash:
        (n,) = struct.unpack_from("<I", raw)
        sizes = struct.unpack_from(f"<{n}I", raw, 4)
        levels, at = [], 4 + 4 * n
        for size in sizes:
            width = -(-size // 8)
            levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, width, at), count=size).astype(np.int64))
            at += width
        return cls(levels)
