"""Helpers shared by the operators: ASCII case, lineage cuts and checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z alone. ``lower`` is quicker, and the same where there is nothing but ASCII."""
    return F.when(text.rlike("[^\\x00-\\x7F]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Only a local session without that setting, as in tests, gets its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        # A session on one machine: "local", "local[8]", not "local-cluster[...]".
        if not named and not context.master.partition("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="casetrail-checkpoint-"))
    return context.getCheckpointDir()


def cut(rows: DataFrame) -> DataFrame:
    """Rows written once to the shared folder, so that a lost executor repeats nothing before them."""
    shared_folder(rows.sparkSession)
    return rows.checkpoint(eager=True)


#: Rows of one task in steps over narrow rows whose number is known.
TASK_ROWS = 100_000


def in_few(rows: DataFrame, count: int) -> DataFrame:
    """``count`` narrow rows, or a few times as many, in as many tasks as they call for instead of one for each shuffle
    partition: every task of a step leaves files of its own. Never more tasks than before."""
    return rows.coalesce(max(1, -(-count // TASK_ROWS)))


def unused_name(rows: DataFrame, name: str) -> str:
    """The name, or one with underscores behind it that no column has."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Bytes of a row group that a task holds while it writes; whole texts fill the usual 128 MB quickly.
ROW_GROUP_BYTES = 16 << 20


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Rows written as Parquet to a new place in the shared folder, and read again."""
    path = f"{shared_folder(rows.sparkSession)}/{name}-{uuid.uuid4().hex}"
    rows.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return rows.sparkSession.read.parquet(path)


#: A side of a join is sent to every task only when it was measured to be below this.
BROADCAST_BYTES = 32 << 20


def sent_if_small(rows: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The rows, written once and measured: marked for broadcast when they are below ``limit``, else left to be
    shuffled."""
    rows = cut(rows)
    size = rows.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(rows) if size <= limit else rows


def keep_rows(documents: DataFrame, marked: DataFrame, id: str, text: str) -> DataFrame:
    """The rows that stay, with all their columns. ``marked`` has one row per document: ``doc_id``, ``print`` (the
    text's ``xxhash64``, null as empty) and ``stays``. Of rows that share id and text one stays.

    The texts aren't shuffled where the rows to drop are few enough to be sent to every task.
    """
    gone = sent_if_small(marked.filter("NOT stays").select(F.col("doc_id").alias("_id"), F.col("print").alias("_print_of")).distinct())
    several = marked.filter("stays").groupBy(F.col("doc_id").alias("_id"), F.col("print").alias("_print_of")).count().filter("count > 1").drop("count")
    several = sent_if_small(several)
    named = documents.withColumn("_print", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    same = F.col(id).eqNullSafe(F.col("_id")) & F.col("_print").eqNullSafe(F.col("_print_of"))
    left = named.join(gone, same, "left_anti")
    columns = [F.col(c) for c in documents.columns]
    if several.isEmpty():
        return left.select(*columns)
    ties = [F.col(c) for c, kind in documents.dtypes if c != text and not kind.startswith(("map", "variant"))]
    one = Window.partitionBy(id, "_print").orderBy(*ties)
    repeated = left.join(several, same, "left_semi").withColumn("_nth", F.row_number().over(one)).filter("_nth = 1")
    return left.join(several, same, "left_anti").select(*columns).unionAll(repeated.select(*columns))
