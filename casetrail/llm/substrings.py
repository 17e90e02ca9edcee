"""Substring dedup by level-wise doubling: only windows that repeat at one length are extended to twice that length.

For windows of 13 words the lengths are 7 and 13, for 50 words 7, 13, 25 and 50: each is at most twice the one before,
so a longer window starts and ends with a shorter one, and can repeat only where both do. At the first length a window
of the next length is represented by one of the windows inside it, the one with the smallest hash; equal texts choose
alike, so nothing is missed, and neighbours mostly choose the same one, which leaves a quarter of the positions.

Documents are dealt into blocks. Each block tells its distinct windows once, whatever number of its documents has
them, so a passage that a third of all documents share makes one row per block and level. Rows meet by hash, and what
repeats goes back to the blocks that have it. Windows are told apart by 64-bit hashes of their word sequences.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casetrail.llm.blocks import in_blocks, unpacked
from casetrail.llm.shingles import run_hashes, word_hashes

WINDOW = 13
#: The first length is at most this.
FIRST = 7
BLOCK_BYTES = 6 << 20

#: Stands for a null id, which is larger than any other.
NO_ID = np.iinfo(np.int64).max


def ladder(window: int, first: int = FIRST) -> list[int]:
    """Lengths up to ``window``, each at most twice the one before, the first at most ``first``."""
    out = [window]
    while out[0] > first:
        out.insert(0, -(-out[0] // 2))
    return out


class Texts:
    """A block's documents in the order of their ids, their words in one array."""

    def __init__(self, block: pa.Table) -> None:
        table = pa.concat_tables(unpacked(block["blob"]))
        ids = table["id"].to_numpy(zero_copy_only=False) if not table["id"].null_count else table["id"].fill_null(NO_ID).to_numpy()
        order = np.argsort(ids, kind="stable")
        raw = table["raw"].to_pylist()
        self.ids = ids[order]
        self.words = [(raw[i] or b"").split() for i in order]
        self.sizes = np.array([len(w) for w in self.words], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]]) if len(self.sizes) else np.empty(0, dtype=np.int64)
        self.hashes = np.concatenate([word_hashes(w) for w in self.words]) if self.words else np.empty(0, dtype=np.uint64)

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions, hashes) of all windows that lie in one document."""
        if len(self.hashes) < length:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
        left = np.repeat(self.starts + self.sizes, self.sizes) - np.arange(len(self.hashes))
        at = np.flatnonzero(left >= length)
        return at, run_hashes(self.hashes, length)[at]

    def chosen(self, length: int, inner: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions, hashes) of all windows, each represented by the smallest hash of the ``inner`` ones inside."""
        if len(self.hashes) < length:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
        runs = run_hashes(self.hashes, inner)
        least = runs[: len(self.hashes) - length + 1].copy()
        for k in range(1, length - inner + 1):
            np.minimum(least, runs[k : k + len(least)], out=least)
        left = np.repeat(self.starts + self.sizes, self.sizes) - np.arange(len(self.hashes))
        at = np.flatnonzero(left >= length)
        return at, least[at]

    def owner(self, positions: np.ndarray) -> np.ndarray:
        return np.repeat(self.ids, self.sizes)[positions]


def _member(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array ``known``."""
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def _told(block: int, hashes: np.ndarray, ids: np.ndarray) -> pa.Table:
    """Each distinct window once, with its smallest id and whether another document of the block has it."""
    order = np.argsort(hashes, kind="stable")
    hashes, ids = hashes[order], ids[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.empty(0, dtype=np.int64)
    last = np.concatenate([first[1:], [len(hashes)]]) - 1 if len(hashes) else first
    return pa.table({
        "h": hashes[first].view(np.int64),
        "block": pa.array(np.full(len(first), block, dtype=np.int32)),
        "least": ids[first],
        "twice": ids[first] != ids[last],
    })


_TOLD = "h long, block int, least long, twice boolean"


def _first_level(length: int, inner: int) -> Callable[[pa.Table], pa.Table]:
    def work(block: pa.Table) -> pa.Table:
        texts = Texts(block)
        at, hashes = texts.chosen(length, inner) if length > inner else texts.windows(length)
        return _told(block["block"][0].as_py(), hashes, texts.owner(at))

    return work


def _survivors(texts: Texts, known: pa.Table, level: int, lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the windows of this level whose parts repeated at the level before."""
    repeated = np.sort(known["h"].to_numpy().view(np.uint64))
    length, before = lengths[level], lengths[level - 1]
    at, hashes = texts.windows(length)
    if level == 1:
        open_ = _member(texts.chosen(length, before)[1], repeated)
    else:
        shorter, theirs = texts.windows(before)
        marked = np.zeros(len(texts.hashes), dtype=bool)
        marked[shorter] = _member(theirs, repeated)
        open_ = marked[at] & marked[at + length - before]
    return at[open_], hashes[open_]


def _next_level(level: int, lengths: list[int]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def work(block: pa.Table, known: pa.Table) -> pa.Table:
        if not block.num_rows or not known.num_rows:
            return _told(0, np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64))
        texts = Texts(block)
        at, hashes = _survivors(texts, known, level, lengths)
        return _told(block["block"][0].as_py(), hashes, texts.owner(at))

    return work


def _repeated(told: DataFrame) -> DataFrame:
    """``block``, ``h`` and the smallest id anywhere, of windows that two documents have."""
    same = Window.partitionBy("h")
    seen = told.withColumn("n", F.count("*").over(same)).withColumn("any", F.max("twice").over(same)).withColumn("least", F.min("least").over(same))
    return seen.filter("n > 1 OR any").select("block", "h", "least")


def _kept(window: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def work(block: pa.Table, known: pa.Table) -> pa.Table:
        texts = Texts(block)
        removed = np.zeros(len(texts.hashes) + 1, dtype=np.int64)
        if known.num_rows:
            at, hashes = texts.windows(window)
            order = np.argsort(known["h"].to_numpy().view(np.uint64))
            keys, least = known["h"].to_numpy().view(np.uint64)[order], known["least"].to_numpy()[order]
            found = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
            late = at[(keys[found] == hashes) & (least[found] < texts.owner(at))]
            np.add.at(removed, late, 1)
            np.add.at(removed, late + window, -1)
        gone = np.cumsum(removed)[:-1] > 0
        out = {name: [] for name in ("n_removed", "kept_text")}
        for words, start, size in zip(texts.words, texts.starts, texts.sizes):
            own = gone[start : start + size]
            out["n_removed"].append(int(own.sum()))
            out["kept_text"].append(b" ".join([w for w, g in zip(words, own.tolist()) if not g] if own.any() else words))
        kept = [hashlib.sha256(x).hexdigest() for x in out["kept_text"]]
        return pa.table({
            "id": pa.array(texts.ids, mask=texts.ids == NO_ID),
            "n_words": texts.sizes,
            "n_removed": pa.array(out["n_removed"], pa.int64()),
            "kept_sha256": kept,
            "kept_text": pa.array(out["kept_text"], pa.binary()).cast(pa.string()),
        })

    return work


def remove_repeats(documents: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """The id, ``n_words``, ``n_removed``, ``kept_sha256`` and ``kept_text`` (words joined by one space) of every row.

    A word goes when a window of ``window`` words around it also starts in a document with a smaller id. Words are what
    stands between ASCII white space, unchanged; null texts have none. Texts of fewer words than a window keep all.
    Null ids are larger than any other and not than one another; rows with the same id don't take words from each
    other. Repeats inside one document stay. Other columns are not looked at; an empty table gives no rows.
    """
    lengths = ladder(window)
    blocks = in_blocks(documents, id, text, BLOCK_BYTES)
    by_block = blocks.groupBy("block")
    following = lengths[1] if len(lengths) > 1 else lengths[0]
    known = _repeated(by_block.applyInArrow(_first_level(following, lengths[0]), _TOLD))
    for level in range(1, len(lengths)):
        told = by_block.cogroup(known.groupBy("block")).applyInArrow(_next_level(level, lengths), _TOLD)
        known = _repeated(told)
    schema = "id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    return by_block.cogroup(known.groupBy("block")).applyInArrow(_kept(window), schema).withColumnRenamed("id", id)
