"""Language-model scores: prediction by partial matching, learned from the corpus, next to a unigram base.

Every symbol of a text, white space and the end among them, is coded by the byte contexts before it, which run over
white space and words within the document (``ppm.py``). All counted nodes stay, at every size of the corpus: they are
tables partitioned by context, which the distinct contexts of the texts are joined with, one order after the other.

Above the fixed orders stand whole beginnings of words. From there on a symbol's cost depends on its word and the
white space after it alone, so distinct units are coded once for the whole corpus. Documents are dealt into blocks; each
block asks for its distinct units and its distinct contexts elsewhere, and gets their counts and code lengths back, so
that neither the vocabulary, nor the trie, nor a document is ever in one place.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casetrail.llm.blocks import in_blocks, unpacked, unused_returned
from casetrail.llm.common import cut
from casetrail.llm.labelled import held_out
from casetrail.llm.ppm import BITS, CHUNK_BYTES, DISCOUNT, ORDER, STEM, SYMBOLS, coded_beginnings, laid_out, units_of

HELD_OUT = 1
#: Distinct units of one group, on average, whose beginnings are looked at together.
GROUP_WORDS = 40_000
BLOCK_BYTES = 16 << 20
#: Pieces of a block, of about ``ppm.CHUNK_BYTES`` each, that are looked up together.
LOOKED_UP = 4
#: The same for units, which make the larger table and come by dictionary.
LOOKED_UP_UNITS = 16
#: Contexts of up to this order are at most 67,000 by nature, and are sent to every task.
SENT_ORDER = 1


def vocabulary(documents: DataFrame, id: str, text: str) -> DataFrame:
    """``unit`` and its count ``c`` on the training side, for all units; 0 for those that the held-out side alone has."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.Table] = []

        def summed() -> pa.Table:
            whole = pa.concat_tables(parts).group_by("unit", use_threads=False).aggregate([("c", "sum")])
            return whole.select(["unit", "c_sum"]).rename_columns(["unit", "c"])

        for batch in batches:
            learn = batch["learn"].to_numpy(zero_copy_only=False)
            for first, found, document in units_of(batch["raw"]):
                distinct = found.dictionary_encode()
                c = np.bincount(distinct.indices, learn[first + document], minlength=len(distinct.dictionary))
                parts.append(pa.table({"unit": distinct.dictionary, "c": c.astype(np.int64)}))
            if sum(len(p) for p in parts) > 700_000:
                parts = [summed()]
                if len(parts[0]) > 350_000:
                    yield from parts.pop().to_batches(100_000)
            unused_returned()
        if parts:
            yield from summed().to_batches(100_000)
        unused_returned()

    return _sides(documents, id, text).mapInArrow(work, "unit binary, c long").groupBy("unit").agg(F.sum("c").alias("c"))


def _sides(documents: DataFrame, id: str, text: str) -> DataFrame:
    return documents.select(F.col(text).cast("binary").alias("raw"), (~held_out(F.col(id), HELD_OUT)).alias("learn"))


def counted_nodes(documents: DataFrame, id: str, text: str) -> DataFrame:
    """``key`` (a context of ``ORDER`` symbols and the one after it) and ``n`` on the training side, for all texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        kept = 0

        def summed() -> tuple[np.ndarray, np.ndarray]:
            keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            return keys, np.bincount(inverse, np.concatenate([n for _, n in parts])).astype(np.int64)

        def told(keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(keys), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(keys[at : at + 100_000]), pa.array(n[at : at + 100_000])], ["key", "n"])

        for batch in batches:
            learn = batch["learn"].to_numpy(zero_copy_only=False)
            for first, laid in laid_out(batch["raw"]):
                keys, own = laid.keys(laid.at), learn[first + laid.document]
                found, times = np.unique(keys[own], return_counts=True)
                parts += [(found, times), (other := _distinct(keys[~own]), np.zeros(len(other), dtype=np.int64))]
                if sum(len(k) for k, _ in parts) > kept + 500_000:
                    parts = [summed()]
                    kept = len(parts[0][0])
                    if kept > 500_000:
                        yield from told(*parts.pop())
                        kept = 0
            unused_returned()
        if parts:
            yield from told(*summed())
        unused_returned()

    return _sides(documents, id, text).mapInArrow(work, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _distinct(keys: np.ndarray) -> np.ndarray:
    """The distinct keys in their order. With counts numpy sorts them, in a third of the time that its hash table takes."""
    return np.unique(keys, return_counts=True)[0]


def _at(order: int, key: str | Column = "key") -> Column:
    """A key's last symbol and the ``order`` before it."""
    return (F.col(key) if isinstance(key, str) else key).bitwiseAND(F.lit((1 << BITS * (order + 1)) - 1))


class Trie:
    """For each order the table of nodes (``node``, ``count``) and that of contexts (``context``, its ``total``, the
    number ``several`` of its symbols, and their summed counts ``excluded`` one order lower). All nodes are kept."""

    def __init__(self, counted: DataFrame) -> None:
        nodes = {ORDER: cut(counted.filter("n > 0").select(F.col("key").alias("node"), F.col("n").alias("count")))}
        for order in range(ORDER - 1, -1, -1):
            nodes[order] = cut(nodes[order + 1].groupBy(_at(order, "node").alias("node")).agg(F.sum("count").alias("count")))
        self.nodes = {k: self._sent(v, k) for k, v in nodes.items()}
        self.contexts = {}
        for order in range(ORDER + 1):
            both = nodes[order].withColumn("below", F.lit(0).cast("long"))
            if order:
                shorter = self.nodes[order - 1].select(F.col("node").alias("short"), F.col("count").alias("below"))
                both = nodes[order].join(shorter, _at(order - 1, "node") == F.col("short"))
            rows = both.groupBy(F.shiftright("node", BITS).alias("context"))
            sums = rows.agg(F.sum("count").alias("total"), F.count("*").alias("several"), F.sum("below").alias("excluded"))
            self.contexts[order] = self._sent(cut(sums), order)

    @staticmethod
    def _sent(rows: DataFrame, order: int) -> DataFrame:
        return F.broadcast(rows) if order <= SENT_ORDER else rows

    def coded(self, rows: DataFrame) -> DataFrame:
        """Adds to ``log`` log10 of the probability of each ``key``. ``gone`` and ``kinds`` are the counts and the number
        of symbols that a longer context than the trie's has seen; they go away."""
        carried = [c for c in rows.columns if c not in ("log", "gone", "kinds")]
        done = []
        for order in range(ORDER, -1, -1):
            met = rows.join(self.nodes[order], _at(order) == F.col("node"), "left")
            met = met.join(self.contexts[order], F.shiftright(_at(order), BITS) == F.col("context"), "left")
            # Where the longer context has seen the same symbols, there is nothing to choose, and so no cost.
            more = F.col("several") > F.col("kinds")
            share = F.coalesce(F.col("count") - DISCOUNT, DISCOUNT * (F.col("several") - F.col("kinds"))) / (F.col("total") - F.col("gone"))
            met = cut(met.select(
                *carried,
                F.when(more, F.col("log") + F.log10(share)).otherwise(F.col("log")).alias("log"),
                F.coalesce(F.col("excluded").cast("double"), "gone").alias("gone"),
                F.coalesce(F.col("several").cast("double"), "kinds").alias("kinds"),
                F.col("count").isNotNull().alias("hit"),
            ))
            done.append(met.filter("hit").select(*carried, "log"))
            rows = met.filter("NOT hit").drop("hit")
        done.append(rows.select(*carried, (F.col("log") - F.log10(F.greatest(F.lit(SYMBOLS) - F.col("kinds"), F.lit(1.0)))).alias("log")))
        out = done[0]
        for more in done[1:]:
            out = out.unionAll(more)
        return out


def _coded_units(words: DataFrame, trie: Trie, coded: DataFrame) -> DataFrame:
    """``unit``, ``c`` of its word, and ``ll``, the cost of what stands behind its first ``STEM`` bytes."""

    def begin(group: pa.Table) -> pa.Table:
        own, c = group["unit"].to_pylist(), group["c"].to_numpy()
        by_word: Counter = Counter()
        for w, n in zip(own, c.tolist()):
            by_word[w[:-1]] += n
        got = coded_beginnings(own, c)
        named = pa.array(own, pa.binary())
        sizes = [len(own), len(got.key), len(got.excluded)]

        def column(kind: pa.DataType, *parts: object) -> pa.ChunkedArray:
            return pa.chunked_array([pa.nulls(n, kind) if x is None else pa.array(x, kind) for n, x in zip(sizes, parts)], kind)

        return pa.table({
            "unit": column(pa.binary(), named, named.take(pa.array(got.unit)), None),
            "c": column(pa.int64(), [by_word[w[:-1]] for w in own], None, None),
            "ll": column(pa.float64(), got.log, None, None),
            "key": column(pa.int64(), None, got.key, got.excluded),
            "begun": column(pa.int64(), None, got.begun, got.excluded_of),
            "kinds": column(pa.float64(), None, got.kinds, None),
        })

    # Units with the same beginning go to the same group, whose size doesn't depend on that of the vocabulary.
    groups = max(1, -(-words.count() // GROUP_WORDS))
    stem = F.expr(f"substring(unit, 1, least({STEM}, octet_length(unit) - 1))")
    grouped = words.withColumn("g", F.pmod(F.xxhash64(stem), F.lit(groups))).groupBy("g")
    told = cut(grouped.applyInArrow(begin, "unit binary, c long, ll double, key long, begun long, kinds double"))
    missed = told.filter("kinds IS NOT NULL").select("unit", "key", "begun", "kinds")
    lost = told.filter("unit IS NULL").select("key", F.col("begun").alias("of")).join(trie.nodes[ORDER], F.col("key") == F.col("node"))
    gone = lost.groupBy("of").agg(F.sum("count").cast("double").alias("gone"))
    begun = missed.filter("kinds > 0").join(gone, F.col("begun") == F.col("of")).select("unit", "key", F.lit(0.0).alias("log"), "gone", "kinds")
    unseen = missed.filter("kinds = 0").select("unit", "key").join(coded, "key").select("unit", "log")
    rest = trie.coded(begun).select("unit", "log").unionAll(unseen).groupBy("unit").agg(F.sum("log").alias("log"))
    return told.filter("c IS NOT NULL").select("unit", "c", "ll").join(rest, "unit", "left").select(
        "unit", "c", (F.col("ll") + F.coalesce("log", F.lit(0.0))).alias("ll")
    )


Found = Iterator[tuple[int, pa.Array, np.ndarray]]


def _keys_of(raw: pa.ChunkedArray) -> Found:
    """The keys that the fixed orders code, as ``units_of`` gives units."""
    for first, laid in laid_out(raw):
        where = laid.shallow()
        yield first, pa.array(laid.keys(laid.at[where])), laid.document[where]


def _found_in(blobs: pa.ChunkedArray, of: Callable[[pa.ChunkedArray], Found]) -> Found:
    """What is found in a block's documents, numbered through. Only the texts that are looked at are unpacked."""
    begin = 0
    some: list[pa.Table] = []
    for n, table in enumerate(unpacked(blobs), 1):
        some.append(table)
        if n == len(blobs) or sum(t["raw"].nbytes for t in some) >= LOOKED_UP * CHUNK_BYTES:
            texts, some = pa.concat_tables(some)["raw"], []
            for first, x, document in of(texts):
                yield begin + first, x, document
            begin += len(texts)


def _encoded(found: Found) -> Found:
    """The same by dictionary: an occurrence takes eight bytes, and what comes often is looked up once for each piece."""
    for first, x, document in found:
        yield first, x.dictionary_encode(), document.astype(np.int32)


def _looked_up(found: Found, known: pa.Array, pieces: int = LOOKED_UP) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Where ``known`` has what was found in some documents (number of the first, what, the document of each), and the
    document of each. What is known is made ready once for so many of them."""
    for some in batched(found, pieces):
        asked = [x.dictionary if isinstance(x, pa.DictionaryArray) else x for _, x, _ in some]
        at = pc.index_in(pa.chunked_array(asked), value_set=known).to_numpy()
        end = 0
        for (first, x, document), own in zip(some, asked):
            begin, end = end, end + len(own)
            yield (at[begin:end] if own is x else at[begin:end][x.indices]), first + document
        del some, asked, own, at, x, document
        unused_returned()


def score_texts(documents: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` (log10) of every
    row.

    Null texts count as empty: one token, the end. Rows with a null id are held out. Repeated rows are counted as often
    as they come. Without any training row all counts are 0, the base is uniform over one unseen token and the model
    over all symbols. Other columns are not looked at; an empty table gives no rows.
    """
    words = cut(vocabulary(documents, id, text))
    by_word = words.groupBy(F.expr("substring(unit, 1, octet_length(unit) - 1)").alias("word")).agg(F.sum("c").alias("c"))
    sizes = by_word.agg(F.sum("c").alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).first()
    ends = documents.filter(~held_out(F.col(id), HELD_OUT)).count()
    train_tokens, kinds = (sizes["n"] or 0) + ends, sizes["v"] + (ends > 0)
    floor = train_tokens + 0.5 * (kinds + 1)
    nodes = cut(counted_nodes(documents, id, text))
    trie = Trie(nodes)
    coded = cut(trie.coded(nodes.select("key", *[F.lit(0.0).alias(c) for c in ("log", "gone", "kinds")])))
    coded_units = _coded_units(words, trie, coded)
    blocks = in_blocks(documents, id, text, BLOCK_BYTES).groupBy("block")

    def ask_units(block: pa.Table) -> pa.Table:
        own = [pa.array([], pa.binary()), *[found.unique() for _, found, _ in _found_in(block["blob"], units_of)]]
        own = pc.unique(pa.chunked_array(own))
        unused_returned()
        return pa.table({"unit": own, "block": np.full(len(own), block["block"][0].as_py(), dtype=np.int32)})

    def ask_keys(block: pa.Table) -> pa.Table:
        own = [np.empty(0, dtype=np.int64), *[_distinct(found.to_numpy()) for _, found, _ in _found_in(block["blob"], _keys_of)]]
        keys = _distinct(np.concatenate(own))
        unused_returned()
        return pa.table({"key": pa.array(keys), "block": pa.array(np.full(len(keys), block["block"][0].as_py()), pa.int32())})

    nothing = {"unit": "binary", "c": "long", "key": "long"}
    empty = {c: F.lit(None).cast(kind).alias(c) for c, kind in nothing.items()}
    answers = (
        blocks.applyInArrow(ask_units, "unit binary, block int").join(coded_units, "unit").select("block", "unit", "c", empty["key"], "ll")
        .unionAll(blocks.applyInArrow(ask_keys, "key long, block int").join(coded, "key").select("block", empty["unit"], empty["c"], "key", F.col("log").alias("ll")))
    )

    def score(block: pa.Table, known: pa.Table) -> pa.Table:
        blobs = block["blob"]
        ids = pa.chunked_array([chunk for table in unpacked(blobs) for chunk in table["id"].chunks], pa.int64())
        n_tokens, n_known, of_base, of_model = np.zeros((4, len(ids)))

        def add(to: np.ndarray, document: np.ndarray, what: np.ndarray | None) -> None:
            if len(document):
                to[document[0] : document[-1] + 1] += np.bincount(document - document[0], what)

        # Keys first, then units, so that only one of the two is held beside what came.
        of_key = known.select(["key", "ll"]).filter(known["key"].is_valid())
        keys, costs = of_key["key"].combine_chunks(), of_key["ll"].to_numpy()
        del of_key
        for k, document in _looked_up(_found_in(blobs, _keys_of), keys):
            add(of_model, document, costs[k])
        del keys, costs
        of_unit = known.select(["unit", "c", "ll"]).filter(known["unit"].is_valid())
        names, c, ll = of_unit["unit"].combine_chunks(), of_unit["c"].to_numpy(), of_unit["ll"].to_numpy()
        del of_unit
        base, seen = np.log10((c + 0.5) / floor), c > 0
        for k, document in _looked_up(_encoded(_found_in(blobs, units_of)), names, LOOKED_UP_UNITS):
            for to, what in ((n_tokens, None), (n_known, seen[k]), (of_base, base[k]), (of_model, ll[k])):
                add(to, document, what)
        return pa.table({
            "id": ids, "n_tokens": pa.array(n_tokens.astype(np.int64) + 1), "n_known": pa.array(n_known.astype(np.int64) + (ends > 0)),
            "base_score": pa.array(of_base + np.log10((ends + 0.5) / floor)), "score": pa.array(of_model),
        })

    scored = blocks.cogroup(answers.groupBy("block")).applyInArrow(score, "id long, n_tokens long, n_known long, base_score double, score double")
    return scored.select(
        F.col("id").alias(id),
        held_out(F.col("id"), HELD_OUT).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
