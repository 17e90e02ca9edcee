"""Registry of queries and of the SQL that gives the same rows."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from casetrail.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


class Inputs:
    """Source tables in the shapes the pipelines expect, derived from the driver tables.

    Each shape is one SELECT that Spark and the checking engine both run, so both start from
    the same rows. Every shape covers its whole table.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = prepare(spark)
        # On one machine, as in tests, any folder is shared; a cluster names its own.
        if spark.sparkContext.master.partition("[")[0] == "local" and not spark.conf.get("spark.checkpoint.dir", None):
            spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="casetrail-"))
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def shape(self, select: str) -> DataFrame:
        """Runs a shaping SELECT; ``{name}`` in it stands for a driver table."""
        used = {t: self.table(t) for t in DRIVER_TABLES if "{" + t + "}" in select}
        return self.spark.sql(select, **used)


def plain(select: str) -> str:
    """The same SELECT for an engine that knows the driver tables by their names."""
    for t in DRIVER_TABLES:
        select = select.replace("{" + t + "}", t)
    return select


def with_shapes(sql: str, **shapes: str) -> str:
    """Checking SQL on top of shaped tables."""
    parts = ",\n".join(f"{name} AS ({plain(select)})" for name, select in shapes.items())
    return f"WITH {parts}\n{sql}"


def query(sql: str | None = None) -> Callable[[Callable[[Inputs], DataFrame]], Callable[[Inputs], DataFrame]]:
    """Registers a query under its function's name, with its checking SQL if there is one."""

    def register(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        QUERIES[build.__name__] = lambda spark, folder: build(Inputs(spark, folder))
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register
