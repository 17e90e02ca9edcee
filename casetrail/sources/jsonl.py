"""JSON lines: one record per line, written by all executors."""

from __future__ import annotations

import posixpath
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.report import check_not_empty


def output_path(folder: str, job: str, environment: str, day: date) -> str:
    """Folder of one run, named by job, environment and day."""
    env = environment.lower()
    return posixpath.join(folder, env, f"{job}_{env}_{day:%Y%m%d}.jsonl")


def write_lines(lines: DataFrame, path: str, column: str = "value", fail_on_empty: bool = False,
                compression: str = "none") -> int:
    """Writes the text column and returns the number of lines, counted in the same pass.

    ``compression`` is a codec of Spark's text files; ``read_lines`` and ``read_numbered_lines`` read either.
    """
    seen = Observation()
    counted = lines.select(column).observe(seen, F.count(F.lit(1)).alias("lines"))
    counted.write.mode("overwrite").text(path, compression=compression)
    written = int(seen.get["lines"])
    if fail_on_empty:
        check_not_empty(written)
    return written


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value``, ``file``, ``line_in_file`` and ``line_no`` of stored lines, both from 1; files count by name.

    No line moves for it: one pass counts the lines of each piece of a file that a task reads, sums of the counts say
    with which number a piece begins, and a line's place in its piece is the task's running number less the piece's
    first. Only one row per piece is sorted. The second pass makes sure that it reads the pieces as the first did.
    """
    lines = read_lines(spark, path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("__piece"),
        F.monotonically_increasing_id().alias("__place"),
    )
    pieces = lines.groupBy("file", "__piece").agg(F.count("*").alias("__lines"), F.min("__place").alias("__first"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    files = pieces.groupBy("file").agg(F.sum("__lines").alias("__all"))
    files = files.select("file", F.coalesce(F.sum("__all").over(before.orderBy("file")), F.lit(0)).alias("__files"))
    inside = F.coalesce(F.sum("__lines").over(before.partitionBy("file").orderBy("__piece")), F.lit(0))
    begins = pieces.withColumn("__pieces", inside).join(files, "file")
    place = F.col("__place") - F.col("__first")
    held = F.when(place.between(0, F.col("__lines") - 1), place).otherwise(F.raise_error(F.lit("the files are not read as they were counted")))
    number = F.col("__pieces") + held.cast("bigint") + 1
    return lines.join(begins, ["file", "__piece"]).select(
        "value", "file", number.alias("line_in_file"), (F.col("__files") + number).alias("line_no")
    )
