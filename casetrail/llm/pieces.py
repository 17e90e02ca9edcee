"""SentencePiece encoding and decoding over a relational lattice.

A text becomes its escaped form (a space mark in front and for every space) and is cut wherever no piece has the two
characters side by side; no piece can cross such a place, so that what lies between, a unit, is encoded for itself.
Distinct units are encoded once for the whole corpus: their substrings up to the longest piece are exploded, joined with
the piece table, grouped by unit and end, and folded by a higher-order aggregate that holds the best path to each of
the last ends. A character that is no piece becomes its UTF-8 bytes' pieces.

The path with the lowest cost wins, a piece costing ``piece_cost`` less its score in the model file; equal costs go to
the path whose ids come first. With a large ``piece_cost`` that is the path with the fewest pieces, and among these the
one with the best scores. Models of the merging kind have ranks as scores, and their own encoder merges pairs instead:
see the README for how often the two agree. Decoding gives the text back in any case.

Documents travel in blocks of compressed text; each block asks for its distinct units and gets their ids back.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casetrail.llm.blocks import block_count, by_bytes, in_blocks, pack_by_block, unpacked

MARK = "▁"
PIECE_COST = 1e6
#: What a character costs that has to be spelled in bytes; more than any path of pieces for it.
BYTES_COST = 1e8
#: Units of more characters are folded in Python, since a higher-order aggregate copies its state at every step.
LONG_UNIT = 200
BLOCK_BYTES = 18 << 20
_PLACES = 20
_IDS = pa.list_(pa.int32())
#: Numbers of 64 bits that say which substrings may be pieces; one in ten others passes with 32,000 pieces.
_WORDS = 1 << 12
#: Bytes of text, and characters, that are worked on at once.
_AT_ONCE = 1 << 19
#: Bytes of text whose units are held and looked up together.
_LOOKED_UP = 4 << 20


@dataclass
class Model:
    """Pieces with their ids and scores, ids of the 256 bytes, and every id's bytes for decoding."""

    pieces: dict[str, tuple[int, float]]
    byte_ids: list[int]
    spelled: list[bytes]

    @property
    def longest(self) -> int:
        return max(map(len, self.pieces), default=1)


def load_model(path: str) -> Model:
    """Reads a model file on the driver; its vocabulary is its size bound."""
    import sentencepiece

    reader = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, byte_ids, spelled = {}, [0] * 256, []
    for i in range(reader.get_piece_size()):
        piece = reader.id_to_piece(i)
        if reader.is_byte(i):
            byte_ids[int(piece[1:-1], 16)] = i
            spelled.append(bytes([int(piece[1:-1], 16)]))
        elif reader.is_control(i) or reader.is_unknown(i) or reader.is_unused(i):
            spelled.append(b"")
        else:
            pieces[piece] = (i, reader.get_score(i))
            spelled.append(piece.replace(MARK, " ").encode())
    return Model(pieces, byte_ids, spelled)


def escaped(text: str) -> str:
    return MARK + text.replace(" ", MARK) if text else ""


def neighbours(model: Model) -> np.ndarray:
    """A bit for each pair of characters that some piece has side by side; a few other pairs share a bit with one, which
    makes units longer, not wrong."""
    pairs = {(ord(a), ord(b)) for p in model.pieces for a, b in zip(p, p[1:])}
    bits = np.zeros(1 << _PLACES, dtype=bool)
    if pairs:
        a, b = np.array(sorted(pairs), dtype=np.uint64).T
        bits[_pair_places(a, b)] = True
    return bits


def _pair_places(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (((a << np.uint64(21)) | b) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _PLACES)


def units(text: str | None, joined: np.ndarray) -> list[str]:
    """The escaped text cut between characters that no piece joins."""
    if not text:
        return []
    whole = escaped(text)
    codes = np.frombuffer(whole.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    ends = (np.flatnonzero(~joined[_pair_places(codes[:-1], codes[1:])]) + 1).tolist()
    return [whole[a:b] for a, b in zip([0, *ends], [*ends, len(whole)])]


def units_of(raw: pa.ChunkedArray, joined: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The units of many texts (their bytes) one after the other, and how many there are before each text and in all;
    each text's are those that ``units`` finds. Null has none."""
    text = raw.cast(pa.string()).combine_chunks()
    marked = pc.replace_substring(pc.fill_null(text, ""), " ", MARK)
    marked = pc.if_else(pc.equal(marked, ""), "", pc.binary_join_element_wise(MARK, marked, ""))
    stops = np.concatenate([[0], np.cumsum(pc.binary_length(marked).to_numpy())])
    data = "".join(marked.to_pylist()).encode()
    plain = np.frombuffer(data, dtype=np.uint8)
    # A character begins at each byte that does not carry one on.
    begins = np.flatnonzero((plain & 0xC0) != 0x80)
    codes = np.frombuffer(data.decode().encode("utf-32-le"), dtype=np.uint32)
    apart = np.zeros(len(codes), dtype=bool)
    for a in range(0, len(codes) - 1, _AT_ONCE):
        some = codes[a : a + _AT_ONCE + 1].astype(np.uint64)
        apart[a + 1 : a + len(some)] = ~joined[_pair_places(some[:-1], some[1:])]
    at = np.searchsorted(begins, stops)
    apart[at[at < len(codes)]] = True
    cuts = np.append(begins[apart], len(data))
    found = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data))
    return found, np.searchsorted(cuts, stops)


def decoded(offsets: np.ndarray, ids: np.ndarray, spelled: list[bytes], none: pa.Array) -> pa.Array:
    """The texts of many sequences of ids, as ``decode`` gives them; null where ``none`` says so."""
    sizes = np.fromiter(map(len, spelled), dtype=np.int64, count=len(spelled))
    first, all_bytes = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(spelled), dtype=np.uint8)
    length = sizes[ids]
    ends = np.concatenate([[0], np.cumsum(length)])
    data = all_bytes[np.repeat(first[ids] - ends[:-1], length) + np.arange(ends[-1])].tobytes()
    stops = ends[offsets].tolist()
    texts = [data[a:b].decode("utf-8", "replace")[1:] for a, b in zip(stops, stops[1:])]
    return pc.if_else(none, pa.scalar(None, pa.string()), pa.array(texts, pa.string()))


def _ids_of(codes: pa.Array) -> pa.Array:
    """Lists of ids from their codes, none of them null, which lie one after the other."""
    _, offsets, data = codes.buffers()
    if not len(codes):
        return pa.array([], _IDS)
    ends = np.frombuffer(offsets, dtype=np.int32)[codes.offset : codes.offset + len(codes) + 1]
    ids = np.frombuffer(data, dtype=">i4", count=(ends[-1] - ends[0]) // 4, offset=ends[0]) if data else np.empty(0)
    return pa.ListArray.from_arrays(pa.array((ends - ends[0]) // 4), pa.array(ids.astype(np.int32)))


def _pieces_of(blobs: pa.ChunkedArray) -> Iterator[pa.Table]:
    """The documents of a block, some at a time."""
    for table in unpacked(blobs):
        yield from by_bytes(iter(table.to_batches()), "raw", _AT_ONCE)


def _together(tables: Iterator[pa.Table]) -> Iterator[list[pa.Table]]:
    """Some tables at a time, with ``_LOOKED_UP`` bytes of text together, or a few more."""
    some, size = [], 0
    for table in tables:
        some.append(table)
        size += table["raw"].nbytes
        if size >= _LOOKED_UP:
            yield some
            some, size = [], 0
    if some:
        yield some


def decode(ids: list[int] | np.ndarray, spelled: list[bytes]) -> str:
    """The text of a sequence of ids. Bytes that are no UTF-8 become replacement characters."""
    return b"".join([spelled[i] for i in ids]).decode("utf-8", "replace")[1:]


def fold_long(unit: str, model: Model, piece_cost: float) -> list[int]:
    """The same path as ``encode_units`` finds, for a unit of any length, in time linear in it."""
    longest = model.longest
    best: list[tuple[float, list[int]]] = [(0.0, [])]
    # Paths are compared from their start; what all open paths share is set aside now and then.
    settled: list[int] = []
    for end in range(1, len(unit) + 1):
        found = []
        for size in range(1, min(longest, end) + 1):
            piece = unit[end - size : end]
            if piece in model.pieces:
                i, score = model.pieces[piece]
                found.append((best[-size][0] + (piece_cost - score), best[-size][1] + [i]))
            elif size == 1:
                own = [model.byte_ids[x] for x in piece.encode()]
                found.append((best[-1][0] + BYTES_COST, best[-1][1] + own))
        best = [*best[-(longest - 1) :], min(found)] if longest > 1 else [min(found)]
        if end % 64 == 0:
            same = 0
            while all(same < len(p) and p[same] == best[0][1][same] for _, p in best):
                same += 1
            settled += best[0][1][:same]
            best = [(c, p[same:]) for c, p in best]
    return settled + best[-1][1]


def _word(hashed):
    return F.shiftrightunsigned(hashed, 6).bitwiseAND(_WORDS - 1)


def _bits(table: DataFrame):
    """An array of numbers whose bits are set for the hashes of the vocabulary's pieces."""
    words = np.zeros(_WORDS, dtype=np.uint64)
    for hashed, word in table.select(F.hash("piece").alias("h"), _word(F.hash("piece"))).collect():
        words[word] |= np.uint64(1) << np.uint64(hashed & 63)
    return F.lit(words.view(np.int64))


def _code(i: int) -> bytes:
    """An id in four bytes, which sort as the ids do."""
    return i.to_bytes(4, "big")


def encode_units(found: DataFrame, model: Model, piece_cost: float = PIECE_COST) -> DataFrame:
    """The rows of distinct units (column ``unit``, none of them empty, up to ``LONG_UNIT`` characters) with their
    ``code``: the ids, four bytes each, the first byte the highest. Rows that are partitioned by unit stay where they are."""
    spark, keys = found.sparkSession, found.columns
    longest = model.longest
    table = spark.createDataFrame(
        pa.table({
            "piece": pa.array(list(model.pieces), pa.string()),
            "code": pa.array([_code(i) for i, _ in model.pieces.values()], pa.binary()),
            "cost": pa.array([piece_cost - s for _, s in model.pieces.values()], pa.float64()),
        })
    )
    # Explode and join are generated code as long as nothing here needs a lambda.
    ends = found.select(*keys, F.explode(F.sequence(F.lit(1), F.length("unit"))).alias("end"))
    sized = ends.select(*keys, "end", F.explode(F.sequence(F.lit(1), F.least("end", F.lit(longest)))).alias("size"))
    substrings = sized.withColumn("piece", F.substring("unit", F.col("end") - F.col("size") + 1, F.col("size")))
    # Most substrings are no piece, and a bit for each hash of one tells so before the join.
    lattice = substrings.filter((F.col("size") == 1) | (F.getbit(F.get(_bits(table), _word(F.hash("piece"))), F.hash("piece").bitwiseAND(63)) == 1))
    hexed, codes = F.hex(F.encode("piece", "utf-8")), F.array(*[F.lit(_code(i)) for i in model.byte_ids])
    spelled = [F.get(codes, F.conv(F.substring(hexed, 2 * k + 1, 2), 16, 10).cast("int")) for k in range(4)]
    in_bytes = F.concat(*[F.coalesce(x, F.lit(b"")) for x in spelled])
    # The table's size is that of the model's vocabulary, so it may go to every task.
    edges = (
        lattice.join(F.broadcast(table), "piece", "left")
        .filter("code IS NOT NULL OR size = 1")
        .select(*keys, "end", "size", F.coalesce("cost", F.lit(BYTES_COST)).alias("cost"), F.coalesce("code", in_bytes).alias("code"))
    )
    # Joined as bytes, paths are compared as their ids are, at a fraction of the cost.
    by_unit = edges.groupBy(*keys).agg(F.collect_list(F.struct("end", "size", "cost", "code")).alias("edges"))
    start = F.array(F.struct(F.lit(0.0).alias("cost"), F.lit(b"").alias("code")))

    def step(last, end):
        def path(edge):
            before = F.get(last, edge["size"] - 1)
            return F.struct((before["cost"] + edge["cost"]).alias("cost"), F.concat(before["code"], edge["code"]).alias("code"))
        into = F.filter("edges", lambda e: e["end"] == end)
        return F.concat(F.array(F.array_min(F.transform(into, path))), F.slice(last, 1, longest - 1))

    whole = F.sequence(F.lit(1), F.length("unit"))
    return by_unit.select(*keys, F.aggregate(whole, start, step, lambda last: F.get(last, F.lit(0))["code"]).alias("code"))


def encode_texts(documents: DataFrame, model: Model, id: str = "doc_id", text: str = "text", piece_cost: float = PIECE_COST) -> DataFrame:
    """The id, ``ids``, ``n_pieces`` and ``decoded`` (the text made from the ids) of every row.

    Null texts have null ``ids`` and ``decoded`` and no piece; empty texts have empty ones. The space mark itself decodes to a
    space, as the format does not tell them apart; all else comes back as it was. Repeated rows are encoded each.
    Other columns are not looked at; an empty table gives no rows.
    """
    # One shuffle of the texts and one of what is asked serve two readers each; what a reader doesn't need is carried
    # along, as a narrower one would be shuffled anew.
    by_block = in_blocks(documents, id, text, BLOCK_BYTES).groupBy("block")
    sent = documents.sparkSession.sparkContext.broadcast((neighbours(model), model.spelled, model.pieces, model.byte_ids))
    tasks = max(int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * block_count(documents, text, BLOCK_BYTES))

    def ask(packed: pa.Table) -> pa.Table:
        own = [pc.unique(units_of(table["raw"], sent.value[0])[0]) for table in _pieces_of(packed["blob"])]
        own = pc.unique(pa.chunked_array(own, pa.string()))
        own = own.filter(pc.less_equal(pc.utf8_length(own), LONG_UNIT))
        own = own.take(pc.sort_indices(own))  # what is alike lies together on its way there and back, and packs well
        return pa.table({"unit": own, "block": np.full(len(own), packed["block"][0].as_py(), dtype=np.int32)})

    # A unit of ten characters has some fifty substrings, so tasks are many, and not put together by their input's size.
    asked = by_block.applyInArrow(ask, "unit string, block int").repartition(tasks, "unit")
    encoded = encode_units(asked.groupBy("unit").agg(F.min("block").alias("least")), model, piece_cost)
    answered = F.when(F.col("least") <= F.col("block"), F.col("code")).alias("code")
    # A task has a bounded number of distinct units, and looking what is asked up in them spares sorting it.
    answers = asked.join(encoded.hint("shuffle_hash"), "unit").select("block", "unit", answered).sortWithinPartitions("block")

    def assemble(packed: pa.Table, known: pa.Table) -> pa.Table:
        joined, spelled, table_of, byte_ids = sent.value
        whole = Model(table_of, byte_ids, spelled)
        replies = pa.concat_tables([pa.table({"unit": pa.array([], pa.string()), "code": pa.array([], pa.binary())}), *unpacked(known["blob"])])
        names, of_unit = replies["unit"].combine_chunks(), _ids_of(replies["code"].combine_chunks())
        del replies
        done = [pa.table({"id": pa.array([], pa.int64()), "ids": pa.array([], _IDS), "decoded": pa.array([], pa.string())})]
        for tables in _together(_pieces_of(packed["blob"])):
            cut = [units_of(table["raw"], joined) for table in tables]
            # One dictionary for all of them, so that each unit is looked up once.
            found = pa.chunked_array([x for x, _ in cut], pa.string()).dictionary_encode()
            distinct = found.chunk(0).dictionary
            at, own_units = pc.index_in(distinct, value_set=names), of_unit
            if at.null_count:  # longer units, which are folded here
                longer = distinct.filter(pc.is_null(at))
                own_units = pa.concat_arrays([of_unit, pa.array([fold_long(u, whole, piece_cost) for u in longer.to_pylist()], _IDS)])
                at = pc.index_in(distinct, value_set=pa.concat_arrays([names, longer]))
            for table, (_, ends), some in zip(tables, cut, found.chunks):
                own = own_units.take(at.take(some.indices))
                # Each text's units end where ``ends`` says, so its ids end where those of its last unit do.
                offsets = own.offsets.to_numpy()[ends].astype(np.int32)
                none = pc.is_null(table["raw"]).combine_chunks()
                ids = pa.ListArray.from_arrays(pa.array(offsets), own.values, mask=none)
                done.append(pa.table({"id": table["id"], "ids": ids, "decoded": decoded(offsets, own.values.to_numpy(), spelled, none)}))
        return pa.concat_tables(done)

    replies = answers.mapInArrow(pack_by_block, "block int, blob binary")
    done = by_block.cogroup(replies.groupBy("block")).applyInArrow(assemble, "id long, ids array<int>, decoded string")
    return done.select(F.col("id").alias(id), "ids", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_pieces"), "decoded")


def default_model() -> str:
    """The public model file of the machine this runs on, unless the caller names another."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")
