"""Rule-hit counts and run summaries, each from one pass of partial aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .facets import Facets
from .rules import Rule, match_column

# Fixed value: length of the rule-hit report unless told otherwise.
TOP_RULES = 15
# Matches that one number carries, a bit each.
HITS_A_NUMBER = 62


class EmptyOutput(RuntimeError):
    """A run that must give records gave none."""


def rule_hits(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row of counts, ``hit_0`` for the first rule and so on."""
    facets = Facets(rows.schema)
    hits = [F.count_if(match_column(rule, facets)).alias(f"hit_{i}") for i, rule in enumerate(rules)]
    return facets.project(rows).agg(*hits)


def packed_hits(rules: Sequence[Rule], facets: Facets, prefix: str) -> dict[str, Column]:
    """The rules a row matches as bits, in as few numbers as will hold them: 300 rules take five.

    So matches cross a shuffle with their row and are counted behind it. What a task counts in front of a shuffle is
    counted again when the task runs again; in the stage that writes, each task counts once.
    """
    packed = {}
    for first in range(0, len(rules), HITS_A_NUMBER):
        bits = F.lit(0).cast("bigint")
        for place, rule in enumerate(rules[first:first + HITS_A_NUMBER]):
            bit = F.when(match_column(rule, facets), F.lit(1 << place).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
            bits = bits.bitwiseOR(bit)
        packed[f"{prefix}{first // HITS_A_NUMBER}"] = bits
    return packed


def unpacked_hits(rules: Sequence[Rule], prefix: str) -> list[Column]:
    """Counts over rows with ``packed_hits``: ``hit_0`` for the first rule and so on."""
    counts = []
    for i in range(len(rules)):
        number, place = divmod(i, HITS_A_NUMBER)
        bit = F.col(f"{prefix}{number}").bitwiseAND(F.lit(1 << place).cast("bigint"))
        counts.append(F.count_if(bit != 0).alias(f"hit_{i}"))
    return counts


def hit_report(counts: DataFrame, rules: Sequence[Rule], top: int = TOP_RULES) -> DataFrame:
    """The rules hit most often; rules never hit count 0, ties keep rule order."""
    pairs = F.array(*[
        F.struct(F.lit(i).alias("rule_no"), F.lit(r.key).alias("rule"), F.col(f"hit_{i}").alias("hits"))
        for i, r in enumerate(rules)
    ])
    return counts.select(F.inline(pairs)).orderBy(F.desc("hits"), "rule_no").limit(top)


def run_summary(source_rows: DataFrame, records: DataFrame) -> DataFrame:
    """Source rows, records and events of a run."""
    none = F.lit(0).cast("bigint")
    made = records.agg(
        none.alias("source_rows"),
        F.count("*").alias("output_records"),
        F.sum(F.size("process_event_set")).alias("process_events"),
        F.sum(F.size("on_hold_event_set")).alias("on_hold_events"),
    )
    read = source_rows.agg(F.count("*").alias("source_rows"))
    return (
        made.unionByName(read, allowMissingColumns=True)
        .agg(*[F.coalesce(F.sum(c), none).alias(c) for c in made.columns])
        .withColumn("total_events", F.col("process_events") + F.col("on_hold_events"))
    )


def check_not_empty(written: int) -> None:
    if written == 0:
        raise EmptyOutput("no record was produced")
