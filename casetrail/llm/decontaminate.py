"""Benchmark decontamination: a prefix-filtered join of item windows with documents, in DataFrame functions alone.

An item gives windows of ``length`` consecutive words. To lie in a document, a window needs all of its words there,
so its rarest word alone decides which documents and positions come into question: the necessary prefix of its words
when these are ordered by how often the corpus has them. Documents join on those prefix words; the word's place in the
window gives the start in the document, the lengths of both bound it, and the words from that start are compared one
by one with the window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casetrail.llm.common import cut, lower_ascii, sent_if_small, unused_name

#: What stands between words, after A-Z are lower-cased: ASCII that is neither a digit nor a letter.
BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
WINDOW = 10


def words(text: Column) -> Column:
    """The words of a text; null has none."""
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BETWEEN), lambda w: w != "")


def item_windows(items: DataFrame, id: str = "item_id", text: str = "text", length: int = WINDOW) -> DataFrame:
    """Each distinct window once: ``window`` (its words) and ``items`` (the ids, as text, of the items that have it).

    Items of fewer words are one window; items without words have none.
    """
    split = items.select(F.col(id).cast("string").alias("item"), words(F.col(text)).alias("w")).filter("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - length + 1, F.lit(1)))
    each = split.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, length))).alias("window"))
    return each.groupBy("window").agg(F.collect_set("item").alias("items"))


def _spread_words(documents: DataFrame, text: str) -> DataFrame:
    return documents.select(F.explode(words(F.col(text))).alias("word"))


def prefix_words(documents: DataFrame, windows: DataFrame, text: str = "text") -> DataFrame:
    """``word``, ``offset``, ``window``, ``items``: each window with its rarest word over all documents."""
    placed = windows.select("window", "items", F.posexplode("window").alias("offset", "word"))
    vocabulary = sent_if_small(placed.select("word").distinct())
    counts = _spread_words(documents, text).join(vocabulary, "word").groupBy("word").count()
    rare = F.struct(F.coalesce("count", F.lit(0)).alias("count"), "word", "offset")
    first = placed.join(counts, "word", "left").groupBy("window").agg(F.min(rare).alias("rare"), F.first("items").alias("items"))
    # A word that no document has rules its window out.
    return first.filter("rare.count > 0").select("rare.word", "rare.offset", "window", "items")


def _with_candidates(
    documents: DataFrame, items: DataFrame, id: str, text: str, item_id: str, item_text: str, length: int
) -> tuple[DataFrame, str]:
    """The documents with an array of windows that may occur (null for none) and where, and that column's name."""
    key, candidate = unused_name(documents, "_key"), unused_name(documents, "_candidates")
    windows = cut(item_windows(items, item_id, item_text, length))
    prefixes = sent_if_small(prefix_words(documents, windows, text))
    # Any key does that says the same for the same row: whatever else shares it is compared with its own words below.
    keyed = documents.withColumn(key, F.coalesce(F.col(id).cast("long"), F.xxhash64(F.col(text))))
    placed = keyed.select(key, words(F.col(text)).alias("w")).select(key, F.size("w").alias("n"), F.posexplode("w").alias("pos", "word"))
    starts = placed.join(prefixes, "word").select(key, (F.col("pos") - F.col("offset")).alias("start"), "n", "window", "items")
    within = starts.filter((F.col("start") >= 0) & (F.col("start") + F.size("window") <= F.col("n")))
    candidates = within.groupBy(key).agg(F.collect_list(F.struct("start", "window", "items")).alias(candidate))
    return keyed.join(candidates, key, "left").drop(key), candidate


def _occurs(words: Column, candidate: Column) -> Column:
    return F.slice(words, candidate["start"] + 1, F.size(candidate["window"])) == candidate["window"]


def find_leaks(
    documents: DataFrame,
    items: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    length: int = WINDOW,
) -> DataFrame:
    """The documents with columns ``_n_words``, ``_n_hit`` (words inside any occurrence of a window) and ``_leaks``
    (ids of the items whose windows occur, as sorted text).

    Null texts and texts without a word have no hits. Rows are judged one by one, so repeated rows and repeated or
    null ids are no matter. Items without words occur nowhere; an item's null id counts for hits, but is not listed.
    All columns of ``documents`` stay, whatever their names; three that are named as the new ones must not be there.
    """
    joined, candidate = _with_candidates(documents, items, id, text, item_id, item_text, length)
    split, found = unused_name(joined, "_words"), unused_name(joined, "_found")
    joined = joined.withColumn(split, words(F.col(text)))
    none = F.array().cast(joined.schema[candidate].dataType)
    verified = joined.withColumn(found, F.filter(F.coalesce(candidate, none), lambda c: _occurs(F.col(split), c)))
    covered = F.array_distinct(F.flatten(F.transform(found, lambda c: F.sequence(c["start"], c["start"] + F.size(c["window"]) - 1))))
    return verified.select(
        *[F.col(c) for c in documents.columns],
        F.size(split).cast("long").alias("_n_words"),
        F.size(covered).cast("long").alias("_n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.transform(found, lambda c: c["items"])))).alias("_leaks"),
    )


def drop_leaks(documents: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", length: int = WINDOW) -> DataFrame:
    """The documents without any window of an item; the rest as for ``find_leaks``.

    The words are an element of an array, so that each text with candidates is split once, wherever the filter goes.
    """
    joined, candidate = _with_candidates(documents, items, id, text, "item_id", "text", length)
    hit = F.exists(F.array(words(F.col(text))), lambda w: F.exists(candidate, lambda c: _occurs(w, c)))
    clean = F.when(F.col(candidate).isNull(), F.lit(True)).otherwise(~hit)
    return joined.filter(clean).select(*[F.col(c) for c in documents.columns])
