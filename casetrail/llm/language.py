"""Language identification by fusing evidence: text, declared markup language, address suffix and host.

Bayes' rule over four sources taken as independent given the language:

    log P(language | all) = text likelihood + P(declared | language) + P(suffix | language) + P(language | host)

- Text: hashed byte trigrams per language, counted over all rows under their declared languages. Trigrams overlap, so
  their mean log-likelihood counts as that of ``TEXT_WEIGHT`` independent ones at most.
- Declared language and suffix: how often rows of each language carry them, counted with the text's own posteriors,
  so that a wrong declaration is outweighed by a text that speaks clearly.
- Host: language shares of the host's rows, drawn towards those of its parent (its suffix, or all rows where there is
  none), which are drawn towards those of all rows. All three levels are grouped sums.

The classes are declared languages with at least ``LEAST_ROWS`` rows, however small their share. The text of rows that
declare a rarer one isn't counted; such rows get the class that their text and the other evidence speak for, or are
rejected. The trigram table has a fixed number of places for each class. Up to ``TOGETHER`` classes are counted and
scored in one pass; with more, that many at a time, and a text's scores are joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casetrail.llm.common import cut, sent_if_small

BITS = 15
#: Rows that a declared language needs to be a class; classes counted and sent to the tasks together.
LEAST_ROWS, TOGETHER = 5, 200
TEXT_WEIGHT = 40.0
#: Pseudo-rows of the parent's shares in a host's, and of all rows' shares in a parent's.
HOST_PRIOR, PARENT_PRIOR = 20.0, 100.0
#: A document is rejected when no language reaches this probability, or when it has no letter at all.
LEAST_PROBABILITY = 0.5

UNKNOWN = "und"
#: What counts as a letter: A-Z and everything beyond ASCII.
_LETTER = "[A-Za-z]|[^\\x00-\\x7F]"


def trigrams(raw: bytes | None) -> np.ndarray:
    """Places of the text's letter trigrams: A-Z lower-cased, everything that is no letter a single space."""
    if not raw:
        return np.empty(0, dtype=np.int64)
    codes = _FOLD[np.frombuffer(raw, dtype=np.uint8)]
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    codes = np.concatenate([[32], codes[keep], [32]]).astype(np.uint32)
    if (codes == 32).all():
        return np.empty(0, dtype=np.int64)
    grams = (codes[:-2] << 16) | (codes[1:-1] << 8) | codes[2:]
    return ((grams * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64)


_FOLD = np.full(256, 32, dtype=np.uint8)
_FOLD[128:] = np.arange(128, 256)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def primary(tag: Column) -> Column:
    """The primary subtag of a declared language, in lower case: ``pt-BR`` is ``pt``; blank is null."""
    first = F.lower(F.regexp_extract(F.coalesce(tag, F.lit("")), "^\\s*([A-Za-z]{2,8})", 1))
    return F.when(first != "", first)


def host_of(address: Column) -> Column:
    """The host name of a URL, in lower case; null where there is none."""
    host = F.lower(F.regexp_extract(F.coalesce(address, F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def suffix_of(host: Column) -> Column:
    """The last label of a host name; null where the name has no dot."""
    last = F.regexp_extract(F.coalesce(host, F.lit("")), "\\.([a-z0-9-]+)\\.?$", 1)
    return F.when(last != "", last)


def evidence(rows: DataFrame, text: str, declared: str | None, host: Column | None) -> DataFrame:
    """Adds ``_text`` (bytes), ``_declared``, ``_host`` and ``_suffix``."""
    site = F.lit(None).cast("string") if host is None else host
    tag = F.lit(None).cast("string") if declared is None else primary(F.col(declared))
    return rows.select(
        "*", F.col(text).cast("binary").alias("_text"), tag.alias("_declared"), site.alias("_host"), suffix_of(site).alias("_suffix")
    )


def classes(rows: DataFrame) -> list[str]:
    """The declared languages with enough rows, in alphabetical order."""
    enough = rows.filter("_declared IS NOT NULL").groupBy("_declared").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_ROWS)
    return sorted(r[0] for r in enough.select("_declared").collect())


def trigram_table(rows: DataFrame, languages: list[str]) -> np.ndarray:
    """log P(place | language), from all rows that declare one of ``languages``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {x: k for k, x in enumerate(languages)}
        counts = np.zeros((len(languages), 1 << BITS), dtype=np.int64)
        for batch in batches:
            for raw, tag in zip(batch["_text"].to_pylist(), batch["_declared"].to_pylist()):
                if tag in number:
                    counts[number[tag]] += np.bincount(trigrams(raw), minlength=1 << BITS)
        k, place = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (k, place, counts[k, place])], ["k", "place", "n"])

    # Each task sends one row per language and place at most, and so does the driver get.
    summed = rows.select("_text", "_declared").mapInArrow(work, "k long, place long, n long").groupBy("k", "place").agg(F.sum("n").alias("n"))
    got = summed.toArrow()
    table = np.full((len(languages), 1 << BITS), 0.05)
    if got.num_rows:
        table[got["k"].to_numpy(), got["place"].to_numpy()] += got["n"].to_numpy()
    return np.log(table / table.sum(axis=1, keepdims=True))


def _means(rows: DataFrame, table: np.ndarray, carried: list[str]) -> DataFrame:
    """``carried`` columns, ``_ll`` (mean log-likelihood of a trigram in each language) and ``_grams``."""
    sent = rows.sparkSession.sparkContext.broadcast(np.ascontiguousarray(table.T.astype(np.float32)))
    kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carried]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_place = sent.value
        for batch in batches:
            scores, grams = [], []
            for raw in batch["_text"].to_pylist():
                places = trigrams(raw)
                grams.append(len(places))
                if len(places):
                    scores.append(np.bincount(places, minlength=len(by_place)) @ by_place / len(places))
                else:
                    scores.append(np.zeros(by_place.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [*[batch[c] for c in carried], pa.array(scores, pa.list_(pa.float64())), pa.array(grams, pa.int64())], [*carried, "_ll", "_grams"]
            )

    return rows.select(*carried, "_text").mapInArrow(work, ", ".join([*kinds, "_ll array<double>", "_grams long"]))


def _text_scores(rows: DataFrame, languages: list[str], carried: list[str]) -> DataFrame:
    """``carried`` columns, ``_ll`` (log-likelihood of each language, the best 0) and ``_grams``."""
    parts = [languages[k : k + TOGETHER] for k in range(0, len(languages), TOGETHER)]
    if len(parts) == 1:
        means = _means(rows, trigram_table(rows, languages), carried)
    else:
        # Equal texts have equal scores, so that a digest of the text is enough to join by.
        named = rows.withColumn("_print", F.sha2(F.coalesce(F.col("_text"), F.lit(b"")), 256))
        means = named.select(*carried, "_print")
        for k, part in enumerate(parts):
            scored = cut(_means(named, trigram_table(rows, part), ["_print"]).dropDuplicates(["_print"]))
            scored = scored.select(F.col("_print").alias("_at_print"), F.col("_ll").alias(f"_ll{k}"), F.col("_grams").alias(f"_grams{k}"))
            means = means.join(scored, F.col("_print") == F.col("_at_print")).drop("_at_print")
        means = means.select(*carried, F.concat(*[f"_ll{k}" for k in range(len(parts))]).alias("_ll"), F.col("_grams0").alias("_grams"))
    weight = F.least(F.col("_grams") / 3, F.lit(TEXT_WEIGHT))
    top = F.array_max("_ll")
    return means.select(*carried, F.transform("_ll", lambda x: (x - top) * weight).alias("_ll"), "_grams")


def _softmax(scores: Column) -> Column:
    top = F.array_max(scores)
    powers = F.transform(scores, lambda x: F.exp(x - top))
    return F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda s, y: s + y))


def _sums(rows: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Sum of the posteriors ``_p`` for each key, as array ``s``."""
    sums = [F.sum(F.get("_p", F.lit(k))).alias(f"s{k}") for k in range(width)]
    return rows.groupBy(*keys).agg(*sums).select(*keys, F.array(*[f"s{k}" for k in range(width)]).alias("s"))


def _log_shares(counts: Column, prior: Column, weight: float) -> Column:
    """Shares of each language, drawn towards ``prior`` with ``weight`` pseudo-rows."""
    total = F.aggregate(counts, F.lit(0.0), lambda s, y: s + y)
    return F.zip_with(counts, prior, lambda c, p: (c + weight * p) / (total + weight))


def _given_language(sums: DataFrame, key: str, totals: list[float], name: str) -> DataFrame:
    """log P(key | language), smoothed by one pseudo-row that any key may have."""
    number = sums.count() + 1
    logs = F.array(*[F.log((F.get("s", F.lit(k)) + 1.0 / number) / F.lit(totals[k] + 1.0)) for k in range(len(totals))])
    return sums.select(F.col(key).alias(f"_at_{name}"), logs.alias(f"_{name}"))


def identify(
    rows: DataFrame, text: str = "text", declared: str | None = "lang", host: Column | None = None, carried: list[str] | None = None
) -> DataFrame:
    """The carried columns (those of ``rows`` but the text, if not named) with ``language``, ``probability``,
    ``text_language`` (by the text alone) and ``accepted``.

    A row whose text is null, empty or without letters is ``und`` with probability 0 and not accepted. Without declared
    language or host, or with one that is null, that source says nothing. Repeated rows count each time and get the
    same answer; ties go to the language first in alphabetical order. With no declared language that has
    ``LEAST_ROWS`` rows (in an empty table too) there are no classes, and every row is ``und``. Names that start with an underscore are taken.
    """
    keep = [c for c in rows.columns if c != text] if carried is None else carried
    seen = evidence(rows, text, declared, host)
    languages = classes(seen)
    width = len(languages)
    if not width:
        return rows.select(
            *keep, F.lit(UNKNOWN).alias("language"), F.lit(0.0).alias("probability"), F.lit(UNKNOWN).alias("text_language"), F.lit(False).alias("accepted")
        )
    scored = cut(_text_scores(seen, languages, [*keep, "_declared", "_host", "_suffix"]))
    speaks = scored.filter("_grams > 0").select("_declared", "_host", "_suffix", _softmax(F.col("_ll")).alias("_p"))

    everything = _sums(speaks, [], width).first()
    totals = [x or 0.0 for x in everything["s"]] if everything else [0.0] * width
    rows_in_all = sum(totals)
    overall = F.array(*[F.lit((x + 1.0) / (rows_in_all + width)) for x in totals])

    by_host = _sums(speaks.filter("_host IS NOT NULL"), ["_host", "_suffix"], width)
    by_suffix = _sums(speaks.filter("_suffix IS NOT NULL"), ["_suffix"], width)
    parents = by_suffix.select(F.col("_suffix").alias("_at"), _log_shares(F.col("s"), overall, PARENT_PRIOR).alias("_parent"))
    hosts = by_host.join(parents, F.col("_suffix") == F.col("_at"), "left").select(
        F.col("_host").alias("_at_host"), _log_shares(F.col("s"), F.coalesce("_parent", overall), HOST_PRIOR).alias("_prior")
    )
    tags = _given_language(_sums(speaks.filter("_declared IS NOT NULL"), ["_declared"], width), "_declared", totals, "tag")
    ends = _given_language(by_suffix, "_suffix", totals, "end")

    nothing = F.array(*[F.lit(0.0)] * width)
    joined = (
        scored.join(hosts, F.col("_host") == F.col("_at_host"), "left")
        .join(tags, F.col("_declared") == F.col("_at_tag"), "left")
        .join(ends, F.col("_suffix") == F.col("_at_end"), "left")
    )
    parts = [F.col("_ll"), F.coalesce("_tag", nothing), F.coalesce("_end", nothing), F.transform(F.coalesce("_prior", overall), lambda p: F.log(p))]
    fused = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), parts)
    names = F.array(*[F.lit(x) for x in languages])
    judged = joined.withColumn("_all", _softmax(fused)).withColumn("_best", F.array_max("_all"))
    silent = F.col("_grams") == 0
    best_of = lambda scores: F.get(names, (F.array_position(scores, F.array_max(scores)) - 1).cast("int"))
    return judged.select(
        *keep,
        F.when(silent, UNKNOWN).otherwise(best_of(F.col("_all"))).alias("language"),
        F.when(silent, 0.0).otherwise(F.col("_best")).alias("probability"),
        F.when(silent, UNKNOWN).otherwise(best_of(F.col("_ll"))).alias("text_language"),
        (~silent & (F.col("_best") >= LEAST_PROBABILITY)).alias("accepted"),
    )


def keep_identified(rows: DataFrame, id: str = "doc_id", text: str = "text", declared: str | None = "lang", host: Column | None = None) -> DataFrame:
    """The rows whose language is accepted, with all their columns; of rows that share id and text all or none.

    A row that declares a language of fewer than ``LEAST_ROWS`` rows stays as well if it has a letter: there is no class
    for it to be accepted in, and so nothing that speaks against it.
    """
    named = rows.withColumn("_row", F.xxhash64(F.col(text)))
    judged = identify(named.select(id, text, "_row", *([declared] if declared else []), *([] if host is None else [host.alias("_site")])),
                      text, declared, None if host is None else F.col("_site"), carried=[id, "_row"])
    refused = judged.filter("NOT accepted").select(F.col(id).alias("_gone_id"), F.col("_row").alias("_gone_row")).distinct()
    if declared:
        tagged = named.withColumn("_tag", primary(F.col(declared)))
        rare = tagged.filter("_tag IS NOT NULL").groupBy("_tag").count().filter(F.col("count") < LEAST_ROWS).select("_tag")
        lettered = tagged.filter(F.col(text).rlike(_LETTER)).select(id, "_row", "_tag").join(rare, "_tag", "left_semi")
        spared = sent_if_small(lettered.select(F.col(id).alias("_spared_id"), F.col("_row").alias("_spared_row")).distinct())
        none_of = F.col("_gone_id").eqNullSafe(F.col("_spared_id")) & F.col("_gone_row").eqNullSafe(F.col("_spared_row"))
        refused = refused.join(spared, none_of, "left_anti")
    gone = sent_if_small(refused)
    same = F.col(id).eqNullSafe(F.col("_gone_id")) & F.col("_row").eqNullSafe(F.col("_gone_row"))
    return named.join(gone, same, "left_anti").select(*[F.col(c) for c in rows.columns])
