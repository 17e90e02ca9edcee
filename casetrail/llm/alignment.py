"""Alignment of two tokenizers: byte offsets where tokens of both end, found by galloping intersection.

Each text has two lists of token ends, in bytes. The shorter list drives: each of its ends is looked for in the longer
list by steps that double, begun where an end before it was found, and by a binary search of the last step. Ends found
are common; they cut the tokens into groups. The ranks found for consecutive ends of the shorter list differ by the
tokens of the longer one that a token overlaps, so that they give all links without comparing any pair.

Texts are read once, by the tasks that scan them, and what later steps need of them is kept in blocks: every link as
a place in the block's list of distinct id pairs. Pair counts are sums over blocks, and go back to the blocks that
have the pair. A pair that all texts have is one row of each block.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casetrail.llm.blocks import block_numbers, by_bytes, packed, unpacked
from casetrail.llm.common import stored

#: Bytes of text that are encoded together, and that a block holds.
PIECE_BYTES = 1 << 20
BLOCK_BYTES = 16 << 20
#: The printable characters that stand for themselves in byte-level vocabularies; the other bytes, in
#: order, are the characters from 256 on.
PLAIN_BYTES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
MARK = "▁"
#: Fixed value: the pattern by which byte-level vocabularies of this kind split text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The quick encoder's pattern engine ends on white space of a million characters; texts with so much go to the other.
_LONG_SPACE = re.compile(r"\s{5000}")

_COUNTS = "id long, n_a long, n_b long, n_groups long, n_links long"
_BLOCKS = "block long, documents binary, links binary, pairs array<long>, n array<long>"


def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    others = [b for b in range(256) if b not in PLAIN_BYTES]
    return {chr(b): b for b in PLAIN_BYTES} | {chr(256 + k): b for k, b in enumerate(others)}


@dataclass
class Pair:
    """Two tokenizers by the content of their files, which travel to the tasks: A is byte-level, B has pieces."""

    a_file: str
    b_file: bytes

    @classmethod
    def read(cls, a_path: str, b_path: str) -> Pair:
        with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
            return cls(a.read(), b.read())

    def __getstate__(self):
        return self.a_file, self.b_file

    def __setstate__(self, state) -> None:
        self.a_file, self.b_file = state

    @cached_property
    def a(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        made = Tokenizer.from_str(self.a_file)
        made.encode_special_tokens = True
        return made

    @cached_property
    def quick(self):
        """An encoder by ranks with the same vocabulary, several times as fast; none where the file's merges don't
        number the tokens in their order, or where it splits or changes text in another way."""
        import tiktoken

        file = json.loads(self.a_file)
        model, split = file["model"], file.get("pre_tokenizer") or {}
        plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and not file.get("normalizer")
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        if not plain or model.get("ignore_merges") or [model["vocab"].get(m) for m in merged] != [256 + k for k in range(len(merged))]:
            return None
        of = byte_level()
        ranks = {bytes(of[c] for c in token): model["vocab"][token] for token in [*of, *merged]}
        return tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def a_ids(self, texts: list[str]) -> list[np.ndarray]:
        """A's ids of a space and each text."""
        slow = [k for k, t in enumerate(texts) if self.quick is None or _LONG_SPACE.search(t)]
        own = self.a.encode_batch_fast([" " + texts[k] for k in slow], add_special_tokens=False) if slow else []
        found = dict(zip(slow, (x.ids for x in own)))
        return [np.array(found[k] if k in found else self.quick.encode_ordinary(" " + t), dtype=np.int32) for k, t in enumerate(texts)]

    @cached_property
    def b(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=self.b_file)

    @cached_property
    def a_bytes(self) -> pa.Array:
        of = byte_level()
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        return pa.array([bytes(of[c] for c in x) if all(c in of for c in x) else b"" for x in names], pa.binary())

    @cached_property
    def b_bytes(self) -> pa.Array:
        reader = self.b
        names = [(i, reader.id_to_piece(i)) for i in range(reader.get_piece_size())]
        return pa.array([bytes([int(x[3:5], 16)]) if reader.is_byte(i) else x.replace(MARK, " ").encode() for i, x in names], pa.binary())

    @cached_property
    def b_size(self) -> int:
        return self.b.get_piece_size()

    @cached_property
    def spelled(self) -> pa.Array:
        """Every id with what follows it in a group's text: A's with "," and "|", then B's with "," and ";"."""
        return pa.array([f"{i}{c}" for size, marks in ((len(self.a_bytes), ",|"), (self.b_size, ",;")) for i in range(size) for c in marks])

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """A's ids of a space and the text, and B's of the text, which adds the space itself."""
        return self.a_ids(texts), [np.array(x, dtype=np.int32) for x in self.b.encode(texts, num_threads=1)]


def gallop(wanted: np.ndarray, rank: np.ndarray, low: np.ndarray, last: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each wanted end the place of the first one in ``ends`` that is no smaller, between ``low`` and ``last``.

    ``rank`` numbers the wanted ends of each text from 0; they grow with it. An end whose rank is an odd multiple of
    2 ** k begins where the one 2 ** k ranks before it was found, for large k first, so that many ends step at once.
    """
    out = low.copy()
    at = np.flatnonzero(rank == 0)
    out[at] = _stepped(wanted[at], low[at], last[at], ends)
    for k in reversed(range(int(rank.max(initial=0)).bit_length())):
        at = np.flatnonzero((rank & ((2 << k) - 1)) == (1 << k))
        out[at] = _stepped(wanted[at], out[at - (1 << k)], last[at], ends)
    return out


def _stepped(wanted: np.ndarray, begin: np.ndarray, last: np.ndarray, ends: np.ndarray) -> np.ndarray:
    below, found = begin - 1, begin.copy()
    open_, step = np.flatnonzero(ends[found] < wanted), 1
    while len(open_):
        below[open_] = found[open_]
        found[open_] = np.minimum(found[open_] + step, last[open_])
        open_, step = open_[ends[found[open_]] < wanted[open_]], step * 2
    open_ = np.flatnonzero(found - below > 1)
    while len(open_):
        middle = (below[open_] + found[open_]) >> 1
        smaller = ends[middle] < wanted[open_]
        below[open_[smaller]], found[open_[~smaller]] = middle[smaller], middle[~smaller]
        open_ = open_[found[open_] - below[open_] > 1]
    return found


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


def _same_bytes(ids: np.ndarray, sizes: np.ndarray, table: pa.Array, wanted: list[bytes]) -> np.ndarray:
    """Which texts' tokens have the wanted bytes."""
    joined = table.take(pa.array(ids))
    data = memoryview(joined.buffers()[2] or b"").cast("B")
    at = np.frombuffer(joined.buffers()[1], dtype=np.int32)[_starts(sizes)] if len(ids) else np.zeros(len(sizes) + 1, dtype=np.int32)
    return np.array([data[x:y] == w for x, y, w in zip(at, at[1:], wanted)], dtype=bool)


class Aligned:
    """The tokens of several texts, their groups and links. Texts that don't come back have no tokens."""

    def __init__(self, pair: Pair, texts: list[str | None]) -> None:
        self.pair = pair
        a, b = pair.encode([t or "" for t in texts])
        wanted = [(" " + t).encode() if t else b"" for t in texts]
        right = np.array([bool(t) for t in texts], dtype=bool)
        for tokens, table in ((a, pair.a_bytes), (b, pair.b_bytes)):
            right &= _same_bytes(_joined(tokens), np.array([len(x) for x in tokens], dtype=np.int64), table, wanted)
        none = np.empty(0, dtype=np.int32)
        a, b = ([x if r else none for x, r in zip(tokens, right)] for tokens in (a, b))
        self.a, self.b = _joined(a), _joined(b)
        self.n_a, self.n_b = (np.array([len(x) for x in tokens], dtype=np.int64) for tokens in (a, b))
        self._meet(a, b)

    def _meet(self, a: list[np.ndarray], b: list[np.ndarray]) -> None:
        a_sizes, b_sizes = (_lengths(t) for t in (self.pair.a_bytes, self.pair.b_bytes))
        a_ends, b_ends = np.cumsum(a_sizes[self.a]), np.cumsum(b_sizes[self.b])
        a_at, b_at = _starts(self.n_a), _starts(self.n_b)
        # The shorter list of each text, and the longer one; all are laid end to end.
        by_a = self.n_a <= self.n_b
        shorter = _joined([a_ends[a_at[k] : a_at[k + 1]] if s else b_ends[b_at[k] : b_at[k + 1]] for k, s in enumerate(by_a)], np.int64)
        longer = _joined([b_ends[b_at[k] : b_at[k + 1]] if s else a_ends[a_at[k] : a_at[k + 1]] for k, s in enumerate(by_a)], np.int64)
        n_short, n_long = np.minimum(self.n_a, self.n_b), np.maximum(self.n_a, self.n_b)
        short_at, long_at = _starts(n_short), _starts(n_long)
        text = np.repeat(np.arange(len(a)), n_short)
        rank = np.arange(len(shorter)) - short_at[text]
        place = gallop(shorter, rank, long_at[text], long_at[text + 1] - 1, longer)
        common = longer[place] == shorter if len(place) else np.empty(0, dtype=bool)
        self.n_groups = np.bincount(text[common], minlength=len(a)).astype(np.int64)

        # A token of the shorter list overlaps what lies from the rank after the one before it up to its own.
        first = long_at[text]
        first[1:] = np.where(rank[1:] == 0, first[1:], (place + common)[:-1])
        count = place - first + 1
        of_short = np.repeat(np.arange(len(shorter)), count)
        of_long = np.arange(len(of_short)) - np.repeat(_starts(count)[:-1] - first, count)
        self.n_links = np.bincount(text, weights=count, minlength=len(a)).astype(np.int64)
        linked, short_first = text[of_short], by_a[text[of_short]]
        in_short, in_long = of_short - short_at[linked], of_long - long_at[linked]
        self.link_a = self.a[a_at[linked] + np.where(short_first, in_short, in_long)]
        self.link_b = self.b[b_at[linked] + np.where(short_first, in_long, in_short)]

        # Where each group ends, in the lists of all of A's and all of B's tokens.
        ended, i, p = text[common], rank[common], place[common] - long_at[text[common]]
        self.a_last = a_at[ended] + np.where(by_a[ended], i, p)
        self.b_last = b_at[ended] + np.where(by_a[ended], p, i)

    def group_texts(self) -> Iterator[memoryview]:
        """Each text's groups as ``a1,a2|b1;a3|b2,b3``; empty where it has no tokens."""
        a_sizes, b_sizes = np.diff(self.a_last, prepend=-1), np.diff(self.b_last, prepend=-1)
        a_group, b_group = (np.repeat(np.arange(len(x)), x) for x in (a_sizes, b_sizes))
        a_ends_group, b_ends_group = np.zeros(len(self.a), dtype=bool), np.zeros(len(self.b), dtype=bool)
        a_ends_group[self.a_last] = True
        b_ends_group[self.b_last] = True
        order = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        order[np.arange(len(self.a)) + (self.b_last - b_sizes + 1)[a_group]] = self.a * 2 + a_ends_group
        order[np.arange(len(self.b)) + (self.a_last + 1)[b_group]] = 2 * len(self.pair.a_bytes) + self.b * 2 + b_ends_group
        joined = self.pair.spelled.take(pa.array(order))
        data = memoryview(joined.buffers()[2] or b"").cast("B")
        at = np.frombuffer(joined.buffers()[1], dtype=np.int32)[_starts(self.n_a + self.n_b)] if len(order) else np.zeros(len(self.n_a) + 1, dtype=np.int32)
        for x, y in zip(at, at[1:]):
            yield data[x : max(x, y - 1)]

    @property
    def counts(self) -> list[pa.Array]:
        return [pa.array(x) for x in (self.n_a, self.n_b, self.n_groups, self.n_links)]


def _joined(parts: list[np.ndarray], kind: type = np.int32) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, dtype=kind)


def _lengths(table: pa.Array) -> np.ndarray:
    return np.diff(np.frombuffer(table.buffers()[1], dtype=np.int32)[: len(table) + 1]).astype(np.int64)


def _rows(documents: DataFrame, id: str, text: str) -> DataFrame:
    return documents.select(F.col(id).cast("long").alias("id"), F.col(text).cast("binary").alias("raw"))


def _texts(part: pa.Table) -> list[str | None]:
    return [None if raw is None else raw.decode("utf-8", "replace") for raw in part["raw"].to_pylist()]


def align_texts(documents: DataFrame, pair: Pair, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the id, ``n_a``, ``n_b``, ``n_groups``, ``n_links`` and ``groups``, the tokens' ids in
    order as ``a1,a2|b1;a3|b2,b3``.

    Texts that are null or empty, or whose tokens of either kind don't have the bytes of a space and the text, have
    no tokens: four zeros and an empty text. Rows are judged one by one, so repeated rows and repeated or null ids are
    no matter, and other columns aren't looked at. Empty tables give no rows.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_bytes(batches, "raw", PIECE_BYTES):
            found = Aligned(pair, _texts(part))
            groups = pa.array([str(x, "ascii") for x in found.group_texts()], pa.string())
            yield pa.RecordBatch.from_arrays([part["id"].combine_chunks(), *found.counts, groups], [*_names(_COUNTS), "groups"])

    return _rows(documents, id, text).mapInArrow(read, f"{_COUNTS}, groups string").withColumnRenamed("id", id)


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def read_links(documents: DataFrame, pair: Pair, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents in blocks, written to the shared folder: counts and the groups' digest of each, the links as places
    among the block's distinct pairs, and how often the block has each pair (A's id times B's size plus B's id)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = block_numbers()
        for block in by_bytes(batches, "raw", BLOCK_BYTES):
            rows, codes = [], []
            for part in by_bytes(block.to_batches(), "raw", PIECE_BYTES):
                found = Aligned(pair, _texts(part))
                digests = [hashlib.sha256(x).hexdigest() if n else "" for x, n in zip(found.group_texts(), found.n_a)]
                columns = [part["id"].combine_chunks(), *found.counts, pa.array(digests, pa.string())]
                rows.append(pa.table(columns, [*_names(_COUNTS), "groups_sha256"]))
                codes.append(np.unique(found.link_a * np.int64(pair.b_size) + found.link_b, return_inverse=True, return_counts=True))
            pairs, place = np.unique(np.concatenate([c[0] for c in codes]), return_inverse=True)
            n = np.bincount(place, weights=np.concatenate([c[2] for c in codes]), minlength=len(pairs)).astype(np.int64)
            shifts = _starts(np.array([len(c[0]) for c in codes]))
            links = np.concatenate([place[s + c[1]] for s, c in zip(shifts, codes)]).astype(np.int32)
            values = [[next(numbers)], [packed(pa.concat_tables(rows))], [packed(pa.table({"link": links}))], [pairs], [n]]
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], _names(_BLOCKS))

    return stored(_rows(documents, id, text).mapInArrow(read, _BLOCKS), "linked-blocks")


def _pairs(blocks: DataFrame) -> DataFrame:
    each = F.posexplode(F.arrays_zip("pairs", "n")).alias("place", "both")
    return blocks.select("block", each).select("block", "place", "both.pairs", "both.n")


def link_counts(blocks: DataFrame, b_size: int) -> DataFrame:
    """``pairs`` (the code), ``a_id``, ``b_id``, ``n_links`` (over all documents) and ``highest``: whether no other
    id of A has more links with that id of B."""
    totals = _pairs(blocks).groupBy("pairs").agg(F.sum("n").alias("n_links"))
    totals = totals.select("pairs", F.floor(F.col("pairs") / b_size).alias("a_id"), (F.col("pairs") % b_size).alias("b_id"), "n_links")
    # One row for each id of B: the vocabulary is its bound.
    most = F.broadcast(totals.groupBy("b_id").agg(F.max("n_links").alias("most")))
    return totals.join(most, "b_id").select("pairs", "a_id", "b_id", "n_links", (F.col("n_links") == F.col("most")).alias("highest"))


def _score(blocks: pa.Table, counted: pa.Table) -> pa.Table:
    """One block's documents with the counts of their links."""
    place = counted["place"].to_numpy()
    count, best = np.zeros(len(place), dtype=np.int64), np.zeros(len(place), dtype=np.int64)
    count[place], best[place] = counted["n_links"].to_numpy(), counted["highest"].to_numpy()
    rows, links = next(unpacked(blocks["documents"])), next(unpacked(blocks["links"]))["link"].to_numpy()
    at = _starts(rows["n_links"].to_numpy())
    sums = [np.diff(_starts(x[links])[at]) for x in (best, count)]
    return pa.table([*rows.columns[:-1], pa.array(sums[0]), pa.array(sums[1]), rows.columns[-1]], [*rows.column_names[:-1], "n_best", "count_sum", "groups_sha256"])


def score_links(documents: DataFrame, pair: Pair, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: as ``align_texts``, with ``groups_sha256`` for the groups (empty without tokens),
    ``n_best`` (links whose pair no other id of A beats for its id of B) and ``count_sum`` (over links, how many links
    of all documents have the pair)."""
    blocks = read_links(documents, pair, id, text)
    counted = _pairs(blocks).select("block", "place", "pairs").join(link_counts(blocks, pair.b_size), "pairs")
    counted = counted.select(F.col("block").alias("of"), "place", "n_links", "highest")
    both = blocks.select("block", "documents", "links").groupBy("block").cogroup(counted.groupBy("of"))
    return both.applyInArrow(_score, f"{_COUNTS}, n_best long, count_sum long, groups_sha256 string").withColumnRenamed("id", id)
