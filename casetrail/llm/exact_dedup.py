"""Exact dedup against a history: a minimal perfect hash over the history's distinct digests.

Both sides' digests are dealt into shards of bounded size. Each shard gets a minimal perfect hash whose slots hold
the full digest and the winner's locator (its id). Distinct digests of the incoming rows look up their slot and are
compared byte by byte; those that are not there form groups of their own. Both sides are aggregated by digest before
anything else, so a group of copies is one row per task, however large it is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casetrail.llm.common import cut, keep_rows
from casetrail.llm.perfect_hash import MinimalPerfectHash

#: Digests of one shard, on average; its slots take about 50 bytes each.
SHARD_DIGESTS = 400_000

_GROUP = "shard int, digest binary, n long, winner long"


def with_digest(rows: DataFrame, text: str = "text", name: str = "digest") -> DataFrame:
    """Adds the SHA-256 of the text's UTF-8 bytes; null counts as empty."""
    return rows.withColumn(name, F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)))


def _groups(rows: DataFrame, id: str, text: str, shards: int) -> DataFrame:
    found = with_digest(rows.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))).groupBy("digest")
    return found.agg(F.count("*").alias("n"), F.max("id").alias("winner")).select(
        F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int").alias("shard"), "digest", "n", "winner"
    )


def _matrix(digests: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in digests), dtype=np.uint8).reshape(len(digests), 32)


def _probe(old: pa.Table, new: pa.Table) -> pa.Table:
    """One shard: the history's slots, updated by incoming groups that are there, then the other incoming groups."""
    digests, incoming = _matrix(old["digest"]), _matrix(new["digest"])
    index = MinimalPerfectHash(digests)
    place = index.slots(digests)
    held = np.empty_like(digests)
    held[place] = digests
    counts = np.zeros(index.size, dtype=np.int64)
    counts[place] = old["n"].to_numpy()
    # A group all of whose ids are null has no winner; Arrow keeps that apart from any number.
    lowest = np.iinfo(np.int64).min
    winners = np.full(index.size, lowest)
    winners[place] = old["winner"].fill_null(lowest).to_numpy()
    slot = index.slots(incoming)
    member = slot >= 0
    member[member] = (held[slot[member]] == incoming[member]).all(axis=1)
    n, winner = new["n"].to_numpy(), new["winner"].fill_null(lowest).to_numpy()
    counts[slot[member]] += n[member]
    winners[slot[member]] = np.maximum(winners[slot[member]], winner[member])
    keys, size = np.concatenate([held, incoming[~member]]), np.concatenate([counts, n[~member]])
    best, known = np.concatenate([winners, winner[~member]]), np.arange(len(keys)) < index.size
    return pa.table({
        "digest": pa.array([x.tobytes() for x in keys], pa.binary()),
        "group_size": pa.array(size, pa.int64()),
        "keep_id": pa.array(best, pa.int64(), mask=best == lowest),
        "in_history": pa.array(known, pa.bool_()),
    })


def digest_groups(history: DataFrame, incoming: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``digest``, ``group_size``, ``keep_id`` (largest id) and ``in_history`` of every distinct text of both sides."""
    shards = max(1, -(-(history.count() + incoming.count()) // SHARD_DIGESTS))
    old, new = (_groups(side, id, text, shards) for side in (history, incoming))
    schema = "digest binary, group_size long, keep_id long, in_history boolean"
    return old.groupBy("shard").cogroup(new.groupBy("shard")).applyInArrow(_probe, schema)


def find_repeats(history: DataFrame, incoming: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of both sides: the id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Of rows with the same text the one with the largest id stays. Null texts count as empty, and empty texts are
    equal. A null id is smaller than any other; a group that has none but null ids has a null ``keep_id`` and keeps
    all. Rows that share both id and text are one document: ``kept`` is the same for all of them. Other columns are
    not looked at. Empty tables give no rows.
    """
    both = with_digest(
        history.select(F.col(id).alias(id), F.col(text).alias("text")).unionAll(incoming.select(F.col(id).alias(id), F.col(text).alias("text")))
    ).select(F.col(id).alias("doc_id"), "digest")
    groups = digest_groups(history, incoming, id, text)
    return both.join(groups, "digest").select(
        F.col("doc_id").alias(id),
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "in_history",
    )


def older_half(rows: DataFrame, id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(history, incoming): rows whose id is at most the approximate median of the ids, and the others, null ids among
    them. The median is found among the ids' 53 leading bits."""
    middle = rows.agg(F.percentile_approx(F.col(id).cast("long"), 0.5)).first()[0]
    old = F.coalesce(F.col(id) <= F.lit(middle).cast("long"), F.lit(False))
    return rows.filter(old), rows.filter(~old)


def keep_last(rows: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns: one of each group of equal texts, also among rows that share an
    id or have none."""
    groups = digest_groups(*older_half(rows, id), id, text)
    own = with_digest(rows.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text")))
    # Null and empty texts are one group; all of its prints are those of the empty text.
    seen = own.select("doc_id", "digest", F.xxhash64(F.coalesce("text", F.lit(""))).alias("print"))
    marked = cut(seen.join(groups, "digest").select("doc_id", "print", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("stays")))
    return keep_rows(rows, marked, id, text)
