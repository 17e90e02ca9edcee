"""Connected components of a large edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casetrail.llm.common import cut, in_few


def _stars(edges: DataFrame, smaller_too: bool, count: int) -> DataFrame:
    """Links each node's larger neighbours (or its smaller ones) to the smallest node around it."""
    if smaller_too:
        around = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    around = in_few(around, count)
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = in_few(around.join(least, "u"), count)
    if smaller_too:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
    return in_few(in_few(out.filter("u <> v"), count).distinct(), count)


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of ``edges`` (u, v), in any comparable type.

    A node with many neighbours is aggregated per task before it meets. Rounds grow with the logarithm of the longest
    chain; each is written to the shared folder, and takes as many tasks as the edges that are left call for.
    """
    edges = cut(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = (edges.count(), None)
    while True:
        edges = cut(_stars(_stars(edges, True, before[0]), False, before[0]))
        # When nothing moves any more, every node hangs on the smallest of its component.
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        in_few(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct(), before[0])
    )
