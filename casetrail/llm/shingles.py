"""Word hashes, shingle sets and fast similarity sketches of single texts, in numpy."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFF51AFD7ED558CCD)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _A
    x = (x ^ (x >> np.uint64(29))) * _C
    return x ^ (x >> np.uint64(32))


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """One hash for each run of ``length`` consecutive words."""
    n = len(words) - length + 1
    out = mixed(words[:n])
    for k in range(1, length):
        out = mixed(out + words[k : n + k] * _B)
    return out


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the lower-cased text's shingles; a text of fewer words is one shingle."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = word_hashes(words)
    return np.unique(run_hashes(hashes, min(size, len(words))))


def set_key(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def sketch(hashes: np.ndarray, bins: int) -> np.ndarray:
    """Fast similarity sketch of a set that isn't empty: one value for each of ``bins`` coordinates.

    In round i < bins every element goes to a random bin; in round bins + j every element goes to bin j, so that every
    coordinate is filled after 2 * bins rounds at most, and mostly after ln(bins) * bins / n. A bin keeps its smallest
    (round, hash). Two sets agree in a coordinate with a probability equal to their similarity, and the coordinates'
    sum is concentrated as if they were independent. Rounds are done several at a time where the set is small; what
    rounds beyond the last needed one add never replaces a smaller value.
    """
    out = np.full(bins, _EMPTY)
    at_once = max(1, 2048 // len(hashes))
    done = 0
    while done < 2 * bins:
        rounds = np.arange(done, min(done + at_once, 2 * bins), dtype=np.uint64)[:, None]
        value = mixed(hashes[None, :] + rounds * _B)
        place = np.where(rounds < bins, (value >> np.uint64(40)) % np.uint64(bins), rounds - np.uint64(bins))
        value = (rounds << np.uint64(54)) | (mixed(value) >> np.uint64(10))
        np.minimum.at(out, place.ravel().astype(np.intp), value.ravel())
        done += at_once
        if not (out == _EMPTY).any():
            break
    return out


def bands(values: np.ndarray, rows: int) -> np.ndarray:
    """A hash for each run of ``rows`` coordinates, that also tells the band and the number of rows."""
    count = len(values) // rows
    grid = values[: count * rows].reshape(count, rows)
    placed = mixed(grid + np.arange(1, rows + 1, dtype=np.uint64) * _B).sum(axis=1, dtype=np.uint64)
    return mixed(placed + np.arange(count, dtype=np.uint64) * _C + np.uint64(rows))
