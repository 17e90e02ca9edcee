"""Rule sets, lifecycle maps and code maps: small JSON files read on the driver."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from ..operators.rules import Rule, parse_hold_rules, parse_rules


def read_json(spark: SparkSession, path: str) -> Any:
    """JSON document from any file system Spark reads. The path must lead to one file."""
    found = spark.read.text(path, wholetext=True).take(2)
    if not found:
        raise FileNotFoundError(path)
    if len(found) > 1:
        raise ValueError(f"{path} leads to more than one file")
    return json.loads(found[0]["value"])


def read_rules(spark: SparkSession, path: str, source: str | None = None) -> list[Rule]:
    return parse_rules(read_json(spark, path), source)


def read_hold_rules(spark: SparkSession, path: str | None) -> list[Rule]:
    return parse_hold_rules(read_json(spark, path)) if path else []


def read_map(spark: SparkSession, path: str | None, tolerant: bool = False) -> Mapping[str, Any]:
    """Lifecycle or code map; a document that is no object counts as empty. A tolerant reader takes one that cannot be
    read for empty as well."""
    try:
        content = read_json(spark, path) if path else {}
    except (OSError, ValueError, PySparkException):
        if not tolerant:
            raise
        content = {}
    return content if isinstance(content, Mapping) else {}
