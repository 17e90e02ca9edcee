"""Periodic runs of words: candidates on a harmonic grid, extended exactly on a run-length grammar.

A run of period q and length of four periods or more has every word of a stretch of at least 3 * q words equal to the
word q further on. So one place in each 3 * q is tried for each q: n / 3 + n / 6 + n / 9 ... of them. Where the two words
agree, extension queries on the grammar of the words say how far they go on doing so to both sides. Of several periods
with the same stretch the smallest is the run's.

Texts are judged one by one, by the tasks that scan them; some at a time share one grammar, kept apart by marks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casetrail.llm.blocks import by_bytes
from casetrail.llm.recompression import Grammar

#: Bytes of text that share one grammar, and candidates that are extended together.
PIECE_BYTES = 2 << 20
AT_ONCE = 1 << 20
LEAST_WORDS = 6
PERIODS = 4

_FOUND = "id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed_text binary"


def words_of(id: int | None, raw: bytes | None) -> list[bytes]:
    """The words of a text: what stands between ASCII white space."""
    return raw.split() if raw else []


def _grid(sizes: np.ndarray, least: int, periods: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Candidates, some at a time: the text, the place in it, and the period."""
    # Texts by size, so that those long enough for a period are a prefix; periods are dealt to chunks by their count.
    most = np.minimum(sizes // periods, sizes)
    most = np.where(sizes >= least, most, 0)
    text = np.repeat(np.arange(len(sizes)), most)
    period = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    step = np.maximum(least, periods * period) - period
    places = (sizes[text] - period + step - 1) // step
    begin, total = 0, np.cumsum(places)
    while begin < len(text):
        before = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, before + AT_ONCE, side="right")))
        of = np.repeat(np.arange(begin, end), places[begin:end])
        nth = np.arange(len(of)) - np.repeat(total[begin:end] - places[begin:end] - before, places[begin:end])
        yield text[of], nth * step[of], period[of]
        begin = end


def runs_of(sequences: list[np.ndarray], least: int = LEAST_WORDS, periods: int = PERIODS) -> tuple[np.ndarray, ...]:
    """All runs of several sequences: which one, start, length and period, ordered by these but for the length."""
    sizes = np.array([len(s) for s in sequences], dtype=np.int64)
    at = np.cumsum(sizes + 1) - sizes
    total = int(sizes.sum()) + len(sizes) + 1
    whole = np.zeros(total, dtype=np.int64)
    marks = np.append(0, np.cumsum(sizes + 1))
    alphabet = max((int(s.max(initial=-1)) for s in sequences), default=-1) + 1
    whole[marks] = alphabet + np.arange(len(marks))
    for s, a in zip(sequences, at):
        whole[a : a + len(s)] = s
    grammar, found = None, []
    for text, place, period in _grid(sizes, least, periods):
        x = at[text] + place
        same = np.flatnonzero(whole[x] == whole[x + period])
        if not len(same):
            continue
        grammar = grammar or Grammar(whole)
        text, x, period = text[same], x[same], period[same]
        right = grammar.extension(x, x + period)
        left = grammar.extension(x - 1, x + period - 1, -1)
        long = np.flatnonzero(left + right + period >= np.maximum(least, periods * period))
        found.append(np.stack([text, x - left - at[text], left + right + period, period])[:, long])
    if not found:
        return (np.empty(0, dtype=np.int64),) * 4
    text, start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, length, start, text))
    text, start, length, period = (c[order] for c in (text, start, length, period))
    # The same stretch again has a multiple of the period, or was met at another place of the grid.
    new = np.ones(len(text), dtype=bool)
    new[1:] = (np.diff(text) != 0) | (np.diff(start) != 0) | (np.diff(length) != 0)
    text, start, length, period = (c[new] for c in (text, start, length, period))
    order = np.lexsort((period, start, text))
    return tuple(c[order] for c in (text, start, length, period))


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return b" ".join([words[k] for k in np.flatnonzero(np.cumsum(edges[:-1]) == 0)])


def find_runs(
    documents: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    least_words: int = LEAST_WORDS,
    periods: int = PERIODS,
    read: Callable[[int | None, bytes | None], list[bytes]] = words_of,
) -> DataFrame:
    """One row per document: the id, ``n_words``, ``runs`` (start, length and period in words, by start and period)
    and ``collapsed_text``, the words that stand in no run after its first period, joined by one space.

    A run is a stretch of at least ``least_words`` words and ``periods`` (two or more) smallest periods that can't be
    made longer with that period. ``read`` makes words of an id and a text. Null and empty texts have no words. Rows
    are judged one by one, so repeated rows and repeated or null ids are no matter; other columns aren't looked at.
    Empty tables give no rows.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_bytes(batches, "raw", PIECE_BYTES):
            ids = part["id"].to_pylist()
            words = [read(i, raw) for i, raw in zip(ids, part["raw"].to_pylist())]
            number: dict[bytes, int] = {}
            sequences = [np.array([number.setdefault(w, len(number)) for w in of], dtype=np.int64) for of in words]
            which, start, length, period = runs_of(sequences, least_words, periods)
            bounds = np.searchsorted(which, np.arange(len(ids) + 1))
            triples = list(zip(start.tolist(), length.tolist(), period.tolist()))
            texts = [_collapsed(of, triples[a:b]) for of, a, b in zip(words, bounds, bounds[1:])]
            each = pa.StructArray.from_arrays([pa.array(c) for c in (start, length, period)], ["start", "length", "period"])
            runs = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), each)
            n_words = pa.array([len(of) for of in words], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), n_words, runs, pa.array(texts, pa.binary())], ["id", "n_words", "runs", "collapsed_text"])

    rows = documents.select(F.col(id).cast("long").alias("id"), F.col(text).cast("binary").alias("raw"))
    found = rows.mapInArrow(judge, _FOUND)
    return found.select(F.col("id").alias(id), "n_words", "runs", F.col("collapsed_text").cast("string").alias("collapsed_text"))
