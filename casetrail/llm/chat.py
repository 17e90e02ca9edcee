"""Chat formatting: of logged conversations, those that a longer one continues are dropped before rendering.

A running sum over each conversation's turns, of hashes that depend on the turn's place, role and text, names every
prefix. A conversation whose whole is a proper prefix of another is found by an anti-join on those names. Window,
join and aggregate only; no conversation is gathered before the last step, which writes it as one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rendering of one turn, and what ends a conversation.
OPEN, CLOSE, END = "<|im_start|>", "<|im_end|>\n", "<|endoftext|>"
DEFAULT_ROLE = "unknown"

_SUM = "decimal(38,0)"


def prefixes(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text``, place ``k`` and the two running hashes ``a`` and ``b`` of the prefix."""
    rows = turns.select(
        F.col(conversation).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")
    ).distinct()
    along = Window.partitionBy("conv_id").orderBy(
        F.asc_nulls_last("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text")
    )
    placed = rows.withColumn("k", F.row_number().over(along))
    # Null and empty differ: hashes skip nulls, so each is told apart by a flag.
    content = ["k", F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first, second = F.xxhash64(*content), F.xxhash64(F.lit(7_919), *content, F.lit("b"))
    return placed.withColumn("a", F.sum(first.cast("decimal(20,0)")).over(so_far).cast(_SUM)).withColumn(
        "b", F.sum(second.cast("decimal(20,0)")).over(so_far).cast(_SUM)
    )


def maximal(named: DataFrame) -> DataFrame:
    """``conv_id`` (the smallest of its copies), ``n_turns`` and ``n_copies`` of each conversation that no longer one
    begins with."""
    length = Window.partitionBy("conv_id")
    sized = named.select("conv_id", "k", "a", "b").withColumn("n", F.max("k").over(length))
    whole = sized.filter("k = n").groupBy("k", "a", "b").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    # The distinct prefixes: a first turn that a third of all conversations share is one row per task.
    begun = sized.filter("k < n").select("k", "a", "b").distinct()
    return whole.join(begun, ["k", "a", "b"], "left_anti").select("conv_id", F.col("k").alias("n_turns"), "n_copies")


def rendered(turns: Column) -> Column:
    """One text out of an array of (role, text) turns."""
    parts = F.transform(
        turns,
        lambda t: F.concat(F.lit(OPEN), F.coalesce(t["role"], F.lit(DEFAULT_ROLE)), F.lit("\n"), F.coalesce(t["text"], F.lit("")), F.lit(CLOSE)),
    )
    return F.concat(F.concat_ws("", parts), F.lit(END))


def format_chats(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id``, ``n_turns``, ``n_copies`` and ``chat`` (the rendered text) of every maximal conversation.

    Turns go by number; those of one number by role, then text, nulls first; turns without a number come last.
    Repeated rows count once. Of conversations with equal turns the smallest id stays, and ``n_copies`` counts all.
    Rows without a conversation id belong to none and are left out. Null roles render as "unknown" and null texts as
    empty, but neither equals another role or text. Other columns are not looked at; an empty table gives no rows.
    """
    named = prefixes(turns.filter(F.col(conversation).isNotNull()), conversation, turn, role, text)
    stay = maximal(named)
    gathered = named.join(stay.select("conv_id"), "conv_id", "left_semi").groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("k", "role", "text"))).alias("turns")
    )
    return stay.join(gathered, "conv_id").select("conv_id", F.col("n_turns").cast("long").alias("n_turns"), "n_copies", rendered(F.col("turns")).alias("chat"))
