"""Near-duplicate groups: fast similarity sketches, banding, and verification on full shingle sets.

Texts with equal shingle sets are one class, so that copies meet no further. Classes that share a band of their
sketches are candidates. A bucket isn't expanded into pairs. First each member meets the bucket's centre alone (the
class that has the most company over all its buckets), in buckets of several widths. Then there are strays: members in
another component than their centre, which may still be like some other member. Written as what it inserts into the centre and what it
deletes from it, a stray that is like another member must share with it either an inserted shingle, or, where both
insert few, a deleted one; so these two meet on what they share, and only where the counts allow for a link. Every link
is confirmed on the full sets, and no link between candidates is lost. A pair at the threshold shares no band with a
probability of about 4e-7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casetrail.llm.blocks import locator
from casetrail.llm.common import cut, in_few, keep_rows
from casetrail.llm.components import components
from casetrail.llm.shingles import bands, set_key, shingle_set, sketch

#: Coordinates of a sketch; rows of a band; rows of the wider bands, whose buckets hold the closest texts.
BINS, ROWS, WIDER = 125, 5, (10, 15, 20)


def _sketches(documents: DataFrame, id: str, text: str, size: int) -> DataFrame:
    """``doc_id``, ``at`` (locator), ``print`` (of the text), ``n``, ``key`` (of the shingle set), ``narrow`` and ``wide`` bands of each row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {name: [] for name in ("n", "key", "narrow", "wide")}
            for raw in batch["text"].to_pylist():
                hashes = shingle_set(raw, size)
                out["n"].append(len(hashes))
                out["key"].append(set_key(hashes))
                values = sketch(hashes, BINS) if len(hashes) else np.empty(0, dtype=np.uint64)
                out["narrow"].append(bands(values, ROWS).view(np.int64))
                out["wide"].append(np.concatenate([bands(values, r) for r in WIDER]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["at"], batch["print"], pa.array(out["n"], pa.int64()), pa.array(out["key"], pa.binary()),
                 pa.array(out["narrow"], pa.list_(pa.int64())), pa.array(out["wide"], pa.list_(pa.int64()))],
                ["doc_id", "at", "print", "n", "key", "narrow", "wide"],
            )

    rows = documents.select(
        F.col(id).cast("long").alias("doc_id"), locator(id, text).alias("at"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("print"), F.col(text).cast("binary").alias("text"),
    )
    return rows.mapInArrow(work, "doc_id long, at long, print long, n long, key binary, narrow array<long>, wide array<long>")


def _sets(documents: DataFrame, wanted: DataFrame, id: str, text: str, size: int) -> DataFrame:
    """``key`` and ``elements`` (the full shingle set) of the wanted classes, each from its representative's text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, elements = [], []
            for raw, key in zip(batch["text"].to_pylist(), batch["key"].to_pylist()):
                hashes = shingle_set(raw, size)
                if set_key(hashes) == key:
                    keys.append(key)
                    elements.append(hashes.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(elements, pa.binary())], ["key", "elements"])

    texts = documents.select(locator(id, text).alias("at"), F.col(text).cast("binary").alias("text"))
    return texts.join(wanted, "at").select("key", "text").mapInArrow(work, "key binary, elements binary").dropDuplicates(["key"])


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) of classes for which 100 * intersection >= percent * union."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"].to_pylist(), batch["y"].to_pylist()):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                both = np.sort(np.concatenate([x, y]))
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(both) - common))
            kept = batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))
            yield kept

    left = sets.select(F.col("key").alias("u"), F.col("elements").alias("x"))
    right = sets.select(F.col("key").alias("v"), F.col("elements").alias("y"))
    with_sets = pairs.join(left, "u").join(right, "v").select("u", "v", "x", "y")
    return with_sets.mapInArrow(work, "u binary, v binary")


def _close(n: Column, m: Column, percent: int) -> Column:
    """Sets of these sizes can be similar enough."""
    return (100 * F.least(n, m)) >= (percent * F.greatest(n, m))


def _central(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) of each bucket's centre with its other members."""
    centre = F.max(F.struct("weight", "key", "n")).alias("c")
    centres = members.groupBy("band").agg(centre, F.count("*").alias("size")).filter("size > 1").select("band", "c")
    met = members.join(centres, "band").filter(F.col("key") != F.col("c.key")).filter(_close(F.col("n"), F.col("c.n"), percent))
    return met.select(F.greatest("key", "c.key").alias("u"), F.least("key", "c.key").alias("v")).distinct()


def _differences(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """For pairs of a ``centre`` and a ``key``: what the key's set inserts and deletes (``element``, ``inserted``),
    how many of each, and how many of its kind come from this one on, in the order of their hashes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, elements, kinds, ins, dels, left_over = [], [], [], [], [], []
            for at, (x, y) in enumerate(zip(batch["x"].to_pylist(), batch["y"].to_pylist())):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                more, less = np.setdiff1d(y, x, assume_unique=True), np.setdiff1d(x, y, assume_unique=True)
                size = len(more) + len(less)
                rows.append(np.full(size, at))
                elements.append(np.concatenate([more, less]).view(np.int64))
                kinds.append(np.arange(size) < len(more))
                ins.append(np.full(size, len(more)))
                dels.append(np.full(size, len(less)))
                left_over.append(np.concatenate([np.arange(len(more), 0, -1), np.arange(len(less), 0, -1)]))
            if rows:
                whole = batch.select(["centre", "key", "n", "component", "stray"]).take(pa.array(np.concatenate(rows)))
                yield pa.RecordBatch.from_arrays(
                    [*whole.columns, *(pa.array(np.concatenate(c)) for c in (elements, kinds, ins, dels, left_over))],
                    ["centre", "key", "n", "component", "stray", "element", "inserted", "ins", "dels", "left"],
                )

    left = sets.select(F.col("key").alias("centre"), F.col("elements").alias("x"))
    both = pairs.join(sets.withColumnRenamed("elements", "y"), "key").join(left, "centre")
    schema = "centre binary, key binary, n long, component binary, stray boolean, element long, inserted boolean, ins long, dels long, left long"
    return both.select("centre", "key", "n", "component", "stray", "x", "y").mapInArrow(work, schema)


def _stray_pairs(placed: DataFrame, count: int, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) that may be linked, of a bucket's strays with its other members; ``count`` members in all.

    With c the centre, I and E the numbers inserted and deleted, and T the largest number of shingles that linked sets
    of these sizes may differ in: x and y are linked if they share at least (I_x + E_x + I_y + E_y - T) / 2 of what they
    insert or delete. At most min(E_x, E_y) of that are deleted ones, so at least the rest is inserted by both. Where
    that rest is 0 or less, I_x + I_y + |E_x - E_y| <= T, and a deleted one may do: x and y are in two components, so one of
    them is not like c and differs from it by more than T, which leaves something for both to share.
    """
    centres = placed.groupBy("band").agg(F.max(F.struct("weight", "key", "component")).alias("c")).select(
        "band", F.col("c.weight").alias("pull"), F.col("c.key").alias("centre"), F.col("c.component").alias("main")
    )
    met = in_few(placed.join(in_few(centres, count), "band"), count)
    seen = met.select("band", "key", "n", "component", "pull", "centre", (F.col("component") != F.col("main")).alias("stray"))
    # Each stray is looked at from one centre, the weightiest of its buckets; so are all that share a bucket with it.
    homes = (
        seen.groupBy("key")
        .agg(F.max(F.when(F.col("centre") != F.col("key"), F.struct("pull", "centre"))).alias("home"), F.max("stray").alias("stray"))
        .filter("stray").select("key", F.col("home.centre").alias("centre"))
    )
    homes = in_few(homes, count)
    looked_at = in_few(in_few(seen.filter("stray").select("band", "key").join(homes, "key"), count).select("band", "centre").distinct(), count)
    around = in_few(seen.select("band", "key", "n", "component").join(looked_at, "band"), count).drop("band").filter(F.col("key") != F.col("centre"))
    marked = in_few(around.distinct(), count).join(homes.withColumn("stray", F.lit(True)), ["key", "centre"], "left")
    parts = cut(_differences(in_few(marked, count).withColumn("stray", F.coalesce("stray", F.lit(False))), sets))
    parts = in_few(parts, parts.count())

    x = parts.filter("stray").select("centre", "element", "inserted", *[F.col(c).alias(f"x_{c}") for c in ("key", "n", "component", "ins", "dels", "left")])
    y = parts.select("centre", "element", "inserted", *[F.col(c).alias(f"y_{c}") for c in ("key", "n", "component", "stray", "ins", "dels", "left")])
    apart = F.floor((F.col("x_n") + F.col("y_n")) * (100 - percent) / (100 + percent))
    slack = apart - F.col("x_ins") - F.col("y_ins") - F.abs(F.col("x_dels") - F.col("y_dels"))
    once = ~F.col("y_stray") | (F.col("x_key") < F.col("y_key"))
    # Both sides' inserted shingles are in one order; from the first that they share on, each must have enough left.
    enough = 2 * F.least("x_left", "y_left") + slack >= 0
    allowed = F.when(F.col("inserted"), (slack >= 0) | enough).otherwise(slack >= 0)
    other = (F.col("x_component") != F.col("y_component")) & once & _close(F.col("x_n"), F.col("y_n"), percent)
    met = x.join(y, ["centre", "element", "inserted"]).filter(other & allowed)
    return met.select(F.greatest("x_key", "y_key").alias("u"), F.least("x_key", "y_key").alias("v")).distinct()


def near_groups(
    documents: DataFrame, id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80
) -> tuple[DataFrame, DataFrame]:
    """(rows, classes). rows: ``doc_id``, ``print``, ``n`` (size of the shingle set), ``key`` for every row. classes: for every
    ``key`` of a set that isn't empty the ``component`` (a key) and its smallest id ``least``."""
    found = cut(_sketches(documents, id, text, size))
    rows = found.select("doc_id", "print", "n", "key")
    classes = cut(found.filter("n > 0").groupBy("key").agg(
        F.min("doc_id").alias("least"), F.min("at").alias("at"), F.count("*").alias("copies"), F.max("n").alias("n"),
        F.first("narrow").alias("narrow"), F.first("wide").alias("wide"),
    ))
    spread = lambda which: classes.select("key", "copies", "n", F.explode(which).alias("band"))
    full = spread("narrow").groupBy("band").agg(F.count("*").alias("size")).filter("size > 1")
    shared = cut(spread("narrow").join(full, "band"))
    # How much company a class has in its buckets: what lies in the middle of a group has the most.
    weights = shared.groupBy("key").agg((F.sum("size") + F.max("copies")).alias("weight"))
    members = cut(shared.drop("size", "copies").join(weights, "key"))
    count = members.count()
    members = in_few(members, count)
    weights = members.groupBy("key").agg(F.max("weight").alias("weight"))
    candidates = members.select("key").distinct()
    sets = cut(_sets(documents, classes.select("key", "at").join(candidates, "key"), id, text, size))
    wider = spread("wide").drop("copies").join(weights, "key")
    pairs = _central(members, percent).unionAll(_central(wider, percent)).distinct()
    first = cut(_linked(pairs, sets, percent))
    joined = components(first)

    placed = in_few(members.join(joined.withColumnRenamed("node", "key"), "key", "left"), count).withColumn("component", F.coalesce("component", "key"))
    second = _linked(_stray_pairs(placed, count, sets, percent), sets, percent)
    whole = components(first.unionAll(second)).withColumnRenamed("node", "key")
    labelled = classes.select("key", "least").join(whole, "key", "left").withColumn("component", F.coalesce("component", "key"))
    smallest = labelled.groupBy("component").agg(F.min("least").alias("least"))
    return rows, labelled.select("key", "component").join(smallest, "component").select("key", "component", "least")


def find_near_duplicates(documents: DataFrame, id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """One row per row: the id, ``n_shingles``, ``component_id`` (smallest id reachable over links) and ``kept``.

    Words are what stands between ASCII white space, A-Z lower-cased. Texts of fewer words than a shingle are one
    shingle; null texts and texts without words are linked with nothing and kept. Null ids count as larger than any
    other. Repeated rows have equal texts and so one component; each row whose id is the component's is kept. Other
    columns are not looked at; an empty table gives no rows.
    """
    rows, classes = near_groups(documents, id, text, size, percent)
    reached = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("least"))
    return rows.join(classes, "key", "left").select(
        F.col("doc_id").alias(id),
        F.col("n").alias("n_shingles"),
        reached.alias("component_id"),
        F.col("doc_id").eqNullSafe(reached).alias("kept"),
    )


def keep_one_of_each(documents: DataFrame, id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The rows that stay, with all their columns: the smallest id of each group, one row even where ids repeat or are
    null. Rows without words all stay, but for those that share id and text."""

    rows, classes = near_groups(documents, id, text, size, percent)
    placed = rows.join(classes.select("key", "component"), "key", "left")
    # Null ids sort last.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "print")).alias("first")
    winners = placed.filter("component IS NOT NULL").groupBy("component").agg(first)
    stays = F.col("component").isNull() | (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("print") == F.col("first.print")))
    marked = cut(placed.join(winners, "component", "left").select("doc_id", "print", stays.alias("stays")))
    return keep_rows(documents, marked, id, text)
