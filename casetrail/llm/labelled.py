"""Labelled rows to learn from: a bounded sample of the training side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS, HELD_OUT = 5, 0


def fold(id: Column) -> Column:
    """crc32 of the id as text, modulo ``FOLDS``; null for a null id."""
    return F.crc32(id.cast("string").cast("binary")) % FOLDS


def held_out(id: Column, fold_number: int = HELD_OUT) -> Column:
    """Whether a row is kept from learning; a null id is."""
    return F.coalesce(fold(id) == fold_number, F.lit(True))


def training_sample(documents: DataFrame, labels: DataFrame, label: str, most: int, id: str = "doc_id") -> DataFrame:
    """``documents`` columns and ``_label`` of about ``most`` labelled rows of the training side, all of them if there
    are no more. Rows are chosen by a hash of their id. Labels other than 0 and 1 count as none; of several labels
    for one id the largest counts."""
    known = labels.filter(F.col(label).isin(0, 1) & ~held_out(F.col(id))).groupBy(id).agg(F.max(label).cast("int").alias("_label"))
    total = known.count()
    if total > most:
        known = known.filter(F.pmod(F.xxhash64(F.col(id), F.lit("sample")), F.lit(1_000_000)) < int(1_000_000 * most / total))
    # At most about ``most`` ids, so they may go to every task.
    return documents.join(F.broadcast(known), id)
