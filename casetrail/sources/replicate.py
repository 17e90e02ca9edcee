"""Full-refresh replication of relational tables, driven by specifications."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.shape import land
from .tables import replace_table

# Landed type names of a column mapping and their Spark types.
LANDED_TYPES = {
    "integer": "int",
    "long": "bigint",
    "float": "float",
    "double": "double",
    "string": "string",
    "timestamp": "timestamp",
    "boolean": "boolean",
    "binary": "binary",
}


@dataclass(frozen=True)
class ReplicaSpec:
    """One table to copy. Without a mapping all columns are taken as they are."""

    source_schema: str
    source_table: str
    target_schema: str
    target_table: str
    mapping: tuple[tuple[str, str, str], ...] = ()

    @property
    def source(self) -> str:
        return f"{self.source_schema}.{self.source_table}"

    @property
    def target(self) -> str:
        return f"{self.target_schema}.{self.target_table}"


@dataclass(frozen=True)
class JdbcSource:
    """Connection to the system that is copied.

    A table with an entry in ``predicates`` is read by one query each (``sources.split`` makes them from the keys
    themselves). One with an entry in ``ranges`` (column, lowest, highest) is read by ``partitions`` even ranges, which
    suits keys without gaps. One named in ``small`` is read by a single query; any other is refused, as one task would
    have to move it.
    """

    url: str
    properties: Mapping[str, str]
    ranges: Mapping[str, tuple[str, int, int]]
    small: frozenset[str] = frozenset()
    partitions: int = 64
    fetch_size: int = 10_000
    predicates: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def read(self, spark: SparkSession, spec: ReplicaSpec) -> DataFrame:
        if not any(spec.source in named for named in (self.predicates, self.ranges, self.small)):
            raise ValueError(f"{spec.source} needs predicates or a range to be read in parallel, or to be named as small")
        if spec.source in self.predicates:
            options = {**self.properties, "fetchsize": str(self.fetch_size)}
            return spark.read.jdbc(self.url, spec.source, predicates=list(self.predicates[spec.source]), properties=options)
        reader = (
            spark.read.format("jdbc")
            .option("url", self.url)
            .option("dbtable", spec.source)
            .option("fetchsize", self.fetch_size)
            .options(**self.properties)
        )
        if spec.source in self.ranges:
            column, lowest, highest = self.ranges[spec.source]
            reader = reader.options(
                partitionColumn=column, lowerBound=lowest, upperBound=highest, numPartitions=self.partitions
            )
        return reader.load()


def landed(df: DataFrame, spec: ReplicaSpec) -> DataFrame:
    """Columns chosen, renamed and converted as the specification says."""
    return land(df, spec.mapping) if spec.mapping else df


def replicate(
    spark: SparkSession,
    specs: Iterable[ReplicaSpec],
    read: Callable[[SparkSession, ReplicaSpec], DataFrame],
    write: Callable[[DataFrame, ReplicaSpec], None] | None = None,
    at_once: int = 4,
) -> None:
    """Copies every table in full, replacing what was there, several at a time. Rows go from
    reader to writer on the executors."""
    store = write or (lambda df, spec: replace_table(df, spec.target))
    with ThreadPoolExecutor(at_once) as pool:
        for done in [pool.submit(lambda s=spec: store(landed(read(spark, s), s), s)) for spec in specs]:
            done.result()


def specs_from_copy_job(job: Mapping[str, Any]) -> list[ReplicaSpec]:
    """Specifications out of a copy-job document (JSON with ``activities``)."""
    specs = []
    for activity in job["activities"]:
        body = activity["properties"]
        source = body["source"]["datasetSettings"]
        target = body["destination"]["datasetSettings"]
        columns = body.get("translator", {}).get("mappings", ())
        mapping = tuple(
            (c["source"]["name"], c["destination"]["name"], _landed_type(c["destination"])) for c in columns
        )
        specs.append(ReplicaSpec(source["schema"], source["table"], target["schema"], target["table"], mapping))
    return specs


def _landed_type(column: Mapping[str, Any]) -> str:
    kind = column["physicalType"]
    if kind == "decimal":
        return f"decimal({column['precision']},{column['scale']})"
    return LANDED_TYPES[kind]


def replica_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per copied table, to compare with the source."""
    counted = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    first, *others = counted
    for other in others:
        first = first.unionByName(other)
    return first
