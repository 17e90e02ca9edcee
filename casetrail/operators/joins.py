"""Left joins that rename clashing columns and keep missing keys from piling up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import quoted

_SALT = "__null_salt"


def spread_missing(key: Column) -> Column:
    """A cleaned text key; where there is none, a filler that starts with a blank, as no cleaned key does, and
    names the task that sends the row. Rows that can match nothing are so dealt over all tasks."""
    return F.coalesce(key, F.concat(F.lit(" "), F.spark_partition_id().cast("string")))


def _null_salt(df: DataFrame, keys: Sequence[str]) -> Column:
    """0 where the key is complete, else the number of the task that sends the row, from 1.

    Rows that can match nothing are so dealt over as many tasks as send them; otherwise they would all meet in the
    partition of NULL. No further column is read. A task that runs again, because an executor was lost, has the same
    rows in any order, so each goes where it went before: a running number would not do, as blocks that arrive in
    another order number the rows anew, and those sent elsewhere are lost or doubled.
    """
    incomplete = F.greatest(*[F.col(quoted(k)).isNull() for k in keys], F.lit(False))
    return F.when(incomplete, F.spark_partition_id() + 1).otherwise(F.lit(0))


def _matching_salt(keys: Sequence[str]) -> Column:
    """0 for every row that can match."""
    complete = F.least(*[F.col(quoted(k)).isNotNull() for k in keys], F.lit(True))
    return F.when(complete, F.lit(0))


def left_join(left: DataFrame, right: DataFrame, keys: Sequence[str], null_match: bool = False) -> DataFrame:
    """Left outer join on keys both sides share by name; the right side's keys are dropped.

    NULL keys match nothing. ``null_match`` makes NULL equal NULL, as the staging flows this
    library replaces do: every row without a key then meets every other one, which no cluster
    survives at scale, so it is off unless asked for.
    """
    if null_match:
        pairs = [left[quoted(k)].eqNullSafe(right[quoted(k)]) for k in keys]
        return left.join(right, pairs, "left").drop(*[right[quoted(k)] for k in keys])
    salted = left.withColumn(_SALT, _null_salt(left, keys))
    return salted.join(right.withColumn(_SALT, _matching_salt(keys)), [*keys, _SALT], "left").select(
        *[F.col(quoted(c)) for c in left.columns],
        *[F.col(quoted(c)) for c in right.columns if c not in keys],
    )


def clash_names(taken: Sequence[str], columns: Sequence[str], prefix: str = "", suffix: str = "") -> dict[str, str]:
    """New names for the columns already taken on the left."""
    used = {name.lower() for name in taken}
    return {c: f"{prefix}{c}{suffix}" if c.lower() in used else c for c in columns}


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    columns: Sequence[str] | None = None,
    prefix: str = "",
    suffix: str = "",
    null_match: bool = False,
    complete: bool = False,
) -> DataFrame:
    """Left join that brings in ``columns`` of the right side, renaming only those that clash.

    ``on`` pairs a left key with a right key. Duplicate right keys fan out; deduplicate the
    right side first where they must not. ``complete`` says that no left key is NULL: the join
    then shuffles by the left columns themselves, so a table already partitioned by them stays put.
    """
    chosen = list(columns) if columns is not None else list(right.columns)
    names = clash_names(left.columns, chosen, prefix, suffix)
    if complete:
        brought = right.select(
            *[F.col(quoted(r)).alias(l) for l, r in on],
            *[F.col(quoted(c)).alias(names[c]) for c in chosen if c not in [l for l, _ in on]],
        )
        return left.join(brought, [l for l, _ in on], "left").select(
            *[F.col(quoted(c)) for c in left.columns],
            *[F.col(quoted(c)) for c in brought.columns if c not in [l for l, _ in on]],
        )
    keys = [f"__lookup_key_{i}" for i in range(len(on))]
    brought = right.select(
        *[F.col(quoted(r)).alias(k) for k, (_, r) in zip(keys, on, strict=True)],
        *[F.col(quoted(c)).alias(names[c]) for c in chosen],
    )
    driving = left.withColumns({k: F.col(quoted(l)) for k, (l, _) in zip(keys, on, strict=True)})
    return left_join(driving, brought, keys, null_match).drop(*keys)


def decode(df: DataFrame, codes: DataFrame, on: Sequence[tuple[str, str]], describe: dict[str, str]) -> DataFrame:
    """Adds descriptions from a code table. ``describe`` maps its columns to output names.

    No broadcast hint: code tables are small, and Spark broadcasts a side whose size it has
    checked against ``spark.sql.autoBroadcastJoinThreshold``, in the plan or at run time.
    """
    keys = {right: f"__code_{i}" for i, (_, right) in enumerate(on)}
    brought = codes.select(
        *[F.col(quoted(r)).alias(k) for r, k in keys.items()],
        *[F.col(quoted(c)).alias(out) for c, out in describe.items()],
    )
    return lookup(df, brought, [(left, keys[right]) for left, right in on], columns=list(describe.values()))


#: Rows that one row is repeated as at a time, so that no array grows with their number.
_REPEATED = 1_000


def repeated(df: DataFrame, times: Column) -> DataFrame:
    """Each row as often as ``times`` says; a row for which that is NULL or below 1 goes."""
    named = df.withColumn("__times", times.cast("long")).filter("__times >= 1")
    some = named.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(__times - 1) DIV {_REPEATED}"))))
    left = F.least(F.col("__times") - F.col("__part") * _REPEATED, F.lit(_REPEATED)).cast("int")
    each = some.withColumn("__each", F.explode(F.array_repeat(F.lit(0), left)))
    return each.select(*[F.col(quoted(c)) for c in df.columns])


def matching(df: DataFrame, *others: tuple[DataFrame, Sequence[tuple[str, str]]]) -> DataFrame:
    """Rows with a partner in every other table (chained EXISTS)."""
    for other, on in others:
        df = df.join(_keys_only(other, on), [l for l, _ in on], "left_semi")
    return df


def without_match(df: DataFrame, other: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows without a partner (NOT EXISTS); rows with a NULL key stay."""
    keys = [l for l, _ in on]
    salted = df.withColumn(_SALT, _null_salt(df, keys))
    return salted.join(
        _keys_only(other, on).withColumn(_SALT, _matching_salt(keys)), [*keys, _SALT], "left_anti"
    ).select(*[F.col(quoted(c)) for c in df.columns])


def _keys_only(other: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    return other.select(*[F.col(quoted(r)).alias(l) for l, r in on])
