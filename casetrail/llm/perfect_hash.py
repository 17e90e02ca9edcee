"""Minimal perfect hash over 32-byte digests, in numpy."""

from __future__ import annotations

import numpy as np

_WIDE = np.uint64(0xFFFFFFFFFFFFFFFF)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(words: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit hash of each digest's four words, another one on each level."""
    out = np.full(len(words), (level * 2 + 1) * int(_ODD) & int(_WIDE), dtype=np.uint64)
    for k in range(words.shape[1]):
        out = (out ^ words[:, k]) * np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(29)
    out *= np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(32))


class MinimalPerfectHash:
    """Gives each of n distinct digests a slot of its own in 0..n-1.

    On every level each remaining digest picks a bit; a bit picked once belongs to its digest, the others go on to
    the next level. A digest's slot is the number of owned bits before its own.
    """

    def __init__(self, digests: np.ndarray, room: float = 2.0) -> None:
        words = digests.view(np.uint64).reshape(len(digests), digests.shape[1] // 8)
        self.size = len(words)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        taken = 0
        while len(words):
            bits = max(64, int(room * len(words)))
            at = (_mixed(words, len(self.levels)) % np.uint64(bits)).astype(np.int64)
            own = np.bincount(at, minlength=bits) == 1
            self.levels.append((own, taken + np.cumsum(own, dtype=np.int64) - 1))
            taken += int(own.sum())
            words = words[~own[at]]

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """The slot of each digest; a digest that was never put in gets any slot, or -1."""
        words = digests.view(np.uint64).reshape(len(digests), digests.shape[1] // 8)
        out = np.full(len(words), -1, dtype=np.int64)
        open_ = np.arange(len(words))
        for level, (own, rank) in enumerate(self.levels):
            if not len(open_):
                break
            at = (_mixed(words[open_], level) % np.uint64(len(own))).astype(np.int64)
            hit = own[at]
            out[open_[hit]] = rank[at[hit]]
            open_ = open_[~hit]
        return out

    def bits(self) -> list[bytes]:
        """The levels' owned bits, one value a level; ``of_bits`` makes the same hash of them again."""
        return [len(own).to_bytes(8, "little") + np.packbits(own).tobytes() for own, _ in self.levels]

    @classmethod
    def of_bits(cls, bits: list[bytes]) -> MinimalPerfectHash:
        made = cls(np.empty((0, 8), dtype=np.uint8))
        for level in bits:
            own = np.unpackbits(np.frombuffer(level[8:], dtype=np.uint8), count=int.from_bytes(level[:8], "little")).astype(bool)
            made.levels.append((own, made.size + np.cumsum(own, dtype=np.int64) - 1))
            made.size += int(own.sum())
        return made
