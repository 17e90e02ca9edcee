"""Prediction by partial matching over byte contexts of whole documents.

A document is its lower-cased bytes with a start mark before and an end mark behind them. A context is the ``ORDER``
symbols before a symbol, white space and the words before it included, not further than the start mark. Keys pack a
context and the symbol after it into 9 bits each, 0 for what would lie before the start mark.

Escape estimation: a context seen n times with q different symbols gives each of them (count - DISCOUNT) / n, and the
rest to the next shorter context. Symbols that the longer context has seen are excluded there. As each of them was seen
after the shorter context too, what is excluded can be summed up beforehand for each context.

Above the fixed orders stand whole beginnings of words, from ``STEM`` bytes on, however long. A unit is a word with
the white-space byte after it, or ``LAST`` at the end of the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

ORDER = 4
DISCOUNT = 0.25
#: Beginnings of words are contexts of their own from this many bytes on; all of a key's symbols are then in the word.
STEM = ORDER
START, END = 258, 257
#: Bytes and the end mark.
SYMBOLS = 257

BITS = 9
#: Bytes of text looked at together, but for longer documents.
CHUNK_BYTES = 1 << 20

LAST = b"\x00"
_UNIT = re.compile(rb"[^\t-\r ]+[\t-\r ]?")
_SPACE = np.isin(np.arange(256), (9, 10, 11, 12, 13, 32))
_SYMBOL = np.array([x + 1 + (32 if 65 <= x <= 90 else 0) for x in range(256)], dtype=np.int16)
_IN_WORD = np.ones(START + 1, dtype=bool)
_IN_WORD[[0, *(x + 1 for x in (9, 10, 11, 12, 13, 32)), START, END]] = False


def units(raw: bytes | None) -> list[bytes]:
    """The units of a text, in its order."""
    found = _UNIT.findall((raw or b"").lower() + LAST)
    if found[-1] == LAST and (not raw or not _IN_WORD[raw[-1] + 1]):
        found.pop()
    return found


def units_of(raw: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, pa.BinaryArray, np.ndarray]]:
    """(number of the first document, the units of some documents one after the other, the document of each unit, from
    0 for the first); each text's are those that ``units`` finds."""
    raw = raw.combine_chunks() if isinstance(raw, pa.ChunkedArray) else raw
    for a, b, sizes in _some(raw):
        text = np.frombuffer(b"".join([(x or b"") + LAST for x in raw.slice(a, b - a).to_pylist()]).lower(), dtype=np.uint8)
        space, ends = _SPACE[text], np.cumsum(sizes + 1)
        # Bytes before which no word is open: the first of each document, and those behind white space.
        fresh = np.concatenate([[True], space[:-1]])
        fresh[ends[:-1]] = True
        begins = fresh & ~space
        begins[ends - 1] = False
        kept = ~fresh | begins
        first = np.flatnonzero(begins)
        offsets = np.append(np.cumsum(kept)[first] - 1, kept.sum()).astype(np.int32)
        found = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(text[kept])])
        yield a, found, np.searchsorted(ends, first, side="right")


def _some(raw: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """Consecutive documents of about ``CHUNK_BYTES``: first, the one behind the last, and their sizes; null is empty."""
    sizes = pc.fill_null(pc.binary_length(raw), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    chunk = np.cumsum(sizes) // CHUNK_BYTES
    edges = [0, *(np.flatnonzero(np.diff(chunk)) + 1), len(sizes)]
    for a, b in zip(edges, edges[1:]):
        if a < b:
            yield a, b, sizes[a:b]


class Laid(NamedTuple):
    """Documents one after the other: their symbols, with ``ORDER`` zeros and the start mark before each; where each
    one starts; the predicted positions, and the document of each. There is one of each for every byte of text, so the
    types are the narrowest that do."""

    symbols: np.ndarray
    starts: np.ndarray
    at: np.ndarray
    document: np.ndarray

    def keys(self, at: np.ndarray) -> np.ndarray:
        out, width = self.symbols.astype(np.int64), 1
        while width <= ORDER:  # each step puts what is packed so far before itself
            more = min(width, ORDER + 1 - width)
            out[more:] |= out[:-more] << BITS * more
            width += more
        return out[at]

    def shallow(self) -> np.ndarray:
        """Which predicted positions have fewer than ``STEM`` bytes of a word before them."""
        inner = _IN_WORD[self.symbols]
        deep = np.ones(len(inner), dtype=bool)
        for back in range(1, STEM + 1):
            deep[back:] &= inner[:-back]
        return ~deep[self.at]


def laid_out(raw: pa.Array) -> Iterator[tuple[int, Laid]]:
    """(number of the first document, documents), some at a time; null texts are empty."""
    raw = raw.combine_chunks() if isinstance(raw, pa.ChunkedArray) else raw
    for a, b, own in _some(raw):
        ends = np.cumsum(own + ORDER + 2)
        starts = ends - own - 2
        text = bytes(ORDER + 1) + bytes(ORDER + 2).join([x or b"" for x in raw.slice(a, b - a).to_pylist()]) + bytes(1)
        symbols = _SYMBOL[np.frombuffer(text, dtype=np.uint8)]
        for back in range(1, ORDER + 1):
            symbols[starts - back] = 0
        symbols[starts], symbols[ends - 1] = START, END
        document = np.repeat(np.arange(b - a, dtype=np.int32), own + 1)
        at = np.arange(ORDER + 1, len(document) + ORDER + 1, dtype=np.int32 if ends[-1] < 1 << 31 else np.int64)
        at += document * (ORDER + 1)
        yield a, Laid(symbols, starts, at, document)


@lru_cache(maxsize=1)
def _mixed() -> np.ndarray:
    """A random 64-bit number for each symbol."""
    return _finished(np.arange(1, START + 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _finished(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0xD1342543DE82EF95
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n - 1, 0), base, dtype=np.uint64)])[:n], dtype=np.uint64)


def beginnings(symbols: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A hash of each symbol together with all from ``start`` (a position for each symbol) on, by one running sum."""
    sums = np.cumsum(_mixed()[symbols] * _powers(_BASE, len(symbols)), dtype=np.uint64)
    before = np.where(start > 0, sums[np.maximum(start - 1, 0)], np.uint64(0))
    return _finished((sums - before) * _powers(_BASE_INVERSE, len(symbols))[start])


class Begun(NamedTuple):
    """What whole beginnings say of units that begin alike: log10 by unit; the positions left to the fixed orders (unit,
    key, beginning, number of symbols seen after it, 0 where it was not seen); for those the beginnings' symbols, as
    keys."""

    log: np.ndarray
    unit: np.ndarray
    key: np.ndarray
    begun: np.ndarray
    kinds: np.ndarray
    excluded_of: np.ndarray
    excluded: np.ndarray


def coded_beginnings(words: list[bytes], counts: np.ndarray) -> Begun:
    """For all units that begin like these, with their counts."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes)
    symbols = np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int64) + 1
    last = ends - 1
    symbols[last] = np.where(symbols[last] == 1, END, symbols[last])
    unit, start = np.repeat(np.arange(len(words)), sizes), np.repeat(ends - sizes, sizes)
    place = np.arange(len(symbols)) - start
    found, number = np.unique(beginnings(symbols, start), return_inverse=True)
    times = np.bincount(number, counts[unit].astype(np.float64), minlength=len(found))
    at = np.flatnonzero(place >= STEM)
    key = np.zeros(len(at), dtype=np.int64)
    for back in range(ORDER, -1, -1):
        key = (key << BITS) | symbols[at - back]
    before, child = number[at - 1], number[at]
    # The distinct symbols that were seen after each beginning.
    once, first = np.unique(child, return_index=True)
    first = first[times[once] > 0]
    several = np.bincount(before[first], minlength=len(found)).astype(np.float64)
    hit, seen = times[child] > 0, times[before] > 0
    paid = np.zeros(len(at))
    paid[seen] = np.log10(np.where(hit, times[child] - DISCOUNT, DISCOUNT * several[before])[seen] / times[before][seen])
    wanted = np.zeros(len(found), dtype=bool)
    wanted[before[~hit & seen]] = True
    told = first[wanted[before[first]]]
    names = found.view(np.int64)
    return Begun(
        np.bincount(unit[at], paid, minlength=len(words)), unit[at][~hit], key[~hit], names[before[~hit]], several[before[~hit]],
        names[before[told]], key[told],
    )
