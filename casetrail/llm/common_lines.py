"""Line dedup: a sharded minimal perfect hash over distinct line keys, which documents probe.

A line's key is the line without white space at its ends, A-Z in lower case. Keys long enough count, once for each
document that has them. One pass packs documents into blocks and gathers each block's distinct keys as 128-bit hashes
with a count and the largest id; a key that a third of all documents have is one entry of each block. Hashes are dealt
into shards of bounded size. A shard's index is a minimal perfect hash over its distinct hashes; the slots of its
arrays hold a fingerprint, the number of documents and the largest id. Blocks send each shard the packed hashes that
belong there, these are looked up in the arrays, and only frequent keys are sent back: no line is joined with a line.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casetrail.llm.blocks import block_numbers, by_bytes, packed, unpacked
from casetrail.llm.common import stored
from casetrail.llm.perfect_hash import MinimalPerfectHash

LEAST_CHARS = 40
LEAST_DOCUMENTS = 5
#: Bytes of text in a block, and line keys in a shard, at most on average.
BLOCK_BYTES = 8 << 20
SHARD_KEYS = 100_000

_SPACE = b" \t\n\x0b\x0c\r"
_BLOCKS = "block long, n_keys long, documents binary, keys binary"
_INDEX = "shard long, bits array<binary>, prints binary, n binary, winner binary, has_id binary"
_SENT = "shard long, block long, place binary, hash binary, n binary, winner binary, has_id binary"
_FOUND = "block long, place binary, winner binary, has_id binary"


def line_keys(raw: bytes, least: int) -> list[bytes | None]:
    """The key of each line; none where it has fewer than ``least`` code points."""
    keys = [line.strip(_SPACE) for line in raw.lower().split(b"\n")]
    return [k if len(k) >= least and (k.isascii() or len(k.decode("utf-8", "replace")) >= least) else None for k in keys]


def _read(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Blocks: the documents with the places of their lines' keys, and the distinct keys' hashes, counts and ids."""
    numbers = block_numbers()
    for part in by_bytes(batches, "raw", BLOCK_BYTES):
        places: dict[bytes, int] = {}
        n, winner, has_id, of_lines = [], [], [], []
        for id, raw in zip(part["id"].to_pylist(), part["raw"].to_pylist()):
            lines = [-1 if k is None else places.setdefault(k, len(places)) for k in line_keys(raw or b"", least)]
            of_lines.append(lines)
            more = len(places) - len(n)
            n += [0] * more
            winner += [0] * more
            has_id += [False] * more
            for k in set(lines) - {-1}:
                n[k] += 1
                if id is not None and not (has_id[k] and winner[k] >= id):
                    winner[k], has_id[k] = id, True
        hashes = b"".join(map(xxhash.xxh3_128_digest, places))
        keys = pa.table({
            "hash": pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(places), [None, pa.py_buffer(hashes)]),
            "n": pa.array(n, pa.int64()), "winner": pa.array(winner, pa.int64()), "has_id": pa.array(has_id, pa.bool_()),
        })
        rows = part.append_column("lines", pa.array(of_lines, pa.list_(pa.int32())))
        values = [[next(numbers)], [len(places)], [packed(rows)], [packed(keys)]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(values, (pa.int64(), pa.int64(), pa.binary(), pa.binary()))], ["block", "n_keys", "documents", "keys"]
        )


def read_blocks(documents: DataFrame, id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """Documents and line keys in blocks, written to the shared folder: each text is read once."""
    rows = documents.select(F.col(id).cast("long").alias("id"), F.col(text).cast("binary").alias("raw"))
    return stored(rows.mapInArrow(lambda batches: _read(batches, least_chars), _BLOCKS), "line-blocks")


def _deal(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """Each block's keys as one row for each shard that has any of them."""
    for batch in batches:
        for block, blob in zip(batch["block"].to_pylist(), batch["keys"]):
            table = next(unpacked([blob]))
            if not table.num_rows:
                continue
            table = table.combine_chunks()
            hashes = np.frombuffer(table["hash"].chunk(0).buffers()[1], dtype=np.uint64).reshape(-1, 2)
            shard = (hashes[:, 1] % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            names, first = np.unique(shard[order], return_index=True)
            parts = np.split(order, first[1:])
            n, winner, has_id = (table[c].to_numpy() for c in ("n", "winner", "has_id"))
            columns = [[x[p].tobytes() for p in parts] for x in (np.arange(len(order), dtype=np.int32), hashes, n, winner, has_id)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array([block] * len(names), pa.int64()), *[pa.array(c, pa.binary()) for c in columns]],
                ["shard", "block", "place", "hash", "n", "winner", "has_id"],
            )


def dealt_keys(blocks: DataFrame, shards: int) -> DataFrame:
    return blocks.select("block", "keys").mapInArrow(lambda batches: _deal(batches, shards), _SENT)


def shard_count(blocks: DataFrame) -> int:
    """Shards for all keys that blocks have, at ``SHARD_KEYS`` each."""
    return max(1, -(-(blocks.agg(F.sum("n_keys")).first()[0] or 0) // SHARD_KEYS))


def _joined(values: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(values.to_pylist()), dtype=kind)


def _index(key: tuple, sent: pa.Table) -> pa.Table:
    """One shard: counts are added and ids compared by distinct hash, and put into the slots of its perfect hash."""
    rows = pa.table({
        "a": _joined(sent["hash"], np.uint64)[0::2], "b": _joined(sent["hash"], np.uint64)[1::2],
        "n": _joined(sent["n"], np.int64), "winner": _joined(sent["winner"], np.int64), "has_id": _joined(sent["has_id"], np.bool_),
    })
    lowest = np.iinfo(np.int64).min
    rows = rows.set_column(3, "winner", pa.array(np.where(rows["has_id"].to_numpy(), rows["winner"].to_numpy(), lowest)))
    one = rows.group_by(["a", "b"]).aggregate([("n", "sum"), ("winner", "max"), ("has_id", "max")])
    hashes = np.stack([one["a"].to_numpy(), one["b"].to_numpy()], axis=1)
    index = MinimalPerfectHash(hashes.view(np.uint8))
    slots = np.argsort(index.slots(hashes.view(np.uint8)))
    arrays = [hashes[:, 0], one["n_sum"].to_numpy(), one["winner_max"].to_numpy(), one["has_id_max"].to_numpy()]
    columns = [[key[0].as_py()], [index.bits()], *[[x[slots].tobytes()] for x in arrays]]
    kinds = [pa.int64(), pa.list_(pa.binary()), *[pa.binary()] * 4]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["shard", "bits", "prints", "n", "winner", "has_id"])


def line_index(keys: DataFrame) -> DataFrame:
    """One row per shard: the bits of the minimal perfect hash, and the arrays of fingerprints, counts and ids."""
    return keys.groupBy("shard").applyInArrow(_index, _INDEX)


def _probe(index: pa.Table, sent: pa.Table, least: int) -> pa.Table:
    """Which of the blocks' keys at least ``least`` documents have, with the largest id of each."""
    blocks, columns = [], [[], [], []]
    if index.num_rows:
        shard = MinimalPerfectHash.of_bits(index["bits"][0].as_py())
        prints, n, winner, has_id = (_joined(index[c], t) for c, t in (("prints", np.uint64), ("n", np.int64), ("winner", np.int64), ("has_id", np.bool_)))
        for block, place, hashes in zip(sent["block"].to_pylist(), sent["place"].to_pylist(), sent["hash"].to_pylist()):
            hashes = np.frombuffer(hashes, dtype=np.uint64).reshape(-1, 2)
            slot = shard.slots(hashes.view(np.uint8))
            hit = np.flatnonzero(slot >= 0)
            hit = hit[(prints[slot[hit]] == hashes[hit, 0]) & (n[slot[hit]] >= least)]
            if len(hit):
                blocks.append(block)
                for c, x in zip(columns, (np.frombuffer(place, dtype=np.int32)[hit], winner[slot[hit]], has_id[slot[hit]])):
                    c.append(x.tobytes())
    return pa.table([pa.array(blocks, pa.int64()), *[pa.array(c, pa.binary()) for c in columns]], ["block", "place", "winner", "has_id"])


def probe(keys: DataFrame, index: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """The frequent keys of each block, by their place among the block's keys."""
    both = index.groupBy("shard").cogroup(keys.groupBy("shard"))
    return both.applyInArrow(lambda index, sent: _probe(index, sent, least_documents), _FOUND)


def _drop(blocks: pa.Table, found: pa.Table) -> pa.Table:
    """One block's documents without the lines whose key another document keeps."""
    winners = dict(zip(
        _joined(found["place"], np.int32).tolist(),
        ((w if h else None) for w, h in zip(_joined(found["winner"], np.int64).tolist(), _joined(found["has_id"], np.bool_).tolist())),
    ))
    ids, total, gone, texts = [], [], [], []
    for table in unpacked(blocks["documents"]):
        for id, raw, lines in zip(*(table[c].to_pylist() for c in ("id", "raw", "lines"))):
            stays = [k not in winners or winners[k] == id for k in lines]
            ids.append(id)
            total.append(len(lines))
            gone.append(len(lines) - sum(stays))
            texts.append(b"\n".join(x for x, s in zip(raw.split(b"\n"), stays) if s) if gone[-1] else raw or b"")
    columns = [pa.array(ids, pa.int64()), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.binary())]
    return pa.table(columns, ["id", "n_lines", "n_dropped", "raw"])


def drop_common_lines(
    documents: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    least_chars: int = LEAST_CHARS,
    least_documents: int = LEAST_DOCUMENTS,
) -> DataFrame:
    """One row per document: the id, ``n_lines`` (before), ``n_dropped`` and ``kept_text``.

    Lines whose key has at least ``least_chars`` code points and stands in at least ``least_documents`` documents go,
    except in the document with the largest id that has it, which keeps all of them. Null and empty texts are one empty
    line. Rows count one by one as documents, also where they share an id; all rows that have the largest id keep the
    line. A null id is smaller than any other, and where a key's documents have none but null ids all of them keep it.
    Other columns are not looked at. Empty tables give no rows. Keys are told apart by 128-bit hashes.
    """
    blocks = read_blocks(documents, id, text, least_chars)
    keys = dealt_keys(blocks, shard_count(blocks))
    index = stored(line_index(keys), "line-index")
    found = probe(keys, index, least_documents)
    both = blocks.select("block", "documents").groupBy("block").cogroup(found.groupBy("block"))
    kept = both.applyInArrow(_drop, "id long, n_lines long, n_dropped long, raw binary")
    return kept.select(F.col("id").alias(id), "n_lines", "n_dropped", F.col("raw").cast("string").alias("kept_text"))
