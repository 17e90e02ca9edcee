"""Documents in blocks of compressed text: what grows with the input is the number of blocks, not their size."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text that one block holds on average; a block is what one Python call works on.
BLOCK_BYTES = 24 << 20
ZSTD_LEVEL = 9


def pack_by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that a batch has of each ``block``, as one compressed value."""
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        block = table["block"].to_numpy()
        order = np.argsort(block, kind="stable")
        names, first = np.unique(block[order], return_index=True)
        table = table.drop(["block"]).take(pa.array(order))
        blobs = [packed(table.slice(a, b - a), ZSTD_LEVEL) for a, b in zip(first, [*first[1:], len(order)])]
        yield pa.RecordBatch.from_arrays([pa.array(names.astype(np.int32)), pa.array(blobs, pa.binary())], ["block", "blob"])


def unpacked(blobs: pa.ChunkedArray) -> Iterator[pa.Table]:
    for blob in blobs:
        with pa.ipc.open_stream(blob.as_py()) as read:
            yield read.read_all()


def unused_returned() -> None:
    """Gives the memory back that Arrow keeps for later; a worker that waits for its next task would go on holding it."""
    pa.default_memory_pool().release_unused()


def locator(id: str, text: str):
    """A number to find a row by: its id, or a hash of its text where it has none."""
    return F.coalesce(F.col(id).cast("long"), F.xxhash64(F.col(text)))


def block_count(rows: DataFrame, text: str, block_bytes: int = BLOCK_BYTES) -> int:
    """How many blocks of about ``block_bytes`` the texts fill."""
    total = rows.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(1, -(-total // block_bytes))


def in_blocks(rows: DataFrame, id: str, text: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``block`` and ``blob``: every row's ``id`` and ``raw`` (its text's bytes), dealt by a hash and packed."""
    blocks = block_count(rows, text, block_bytes)
    dealt = rows.select(
        F.pmod(F.xxhash64(locator(id, text), F.lit("block")), F.lit(blocks)).cast("int").alias("block"),
        F.col(id).cast("long").alias("id"),
        F.col(text).cast("binary").alias("raw"),
    )
    return dealt.mapInArrow(pack_by_block, "block int, blob binary")


def by_bytes(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.Table]:
    """The rows in pieces of consecutive rows with at most ``most`` bytes of ``column`` each; a longer row is a piece
    of its own. The column must be large or plain binary, not a list."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        ends = np.cumsum(pc.fill_null(pc.binary_length(table[column]), 0).to_numpy())
        begin = 0
        while begin < len(ends):
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield table.slice(begin, end - begin)
            begin = end


def block_numbers() -> Iterator[int]:
    """Numbers for blocks made in this task, not used in any other task of the same job. They hold once the blocks are
    written; a task that runs again writes its own ones anew."""
    return itertools.count(TaskContext.get().partitionId() << 32)


def packed(table: pa.Table, level: int = 3) -> bytes:
    """A table as one compressed value; ``unpacked`` reads it again."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", level))) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()
