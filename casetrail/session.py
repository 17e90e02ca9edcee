"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import SparkSession


# Java leaves methods above this many bytes uncompiled, which makes wide rule projections several
# times slower; beyond it Spark then generates many small methods instead of one.
LARGEST_COMPILED_METHOD = "8000"


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the jobs rely on. Event times are written in UTC, so text without an offset must
    be read as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", LARGEST_COMPILED_METHOD)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; nothing written earlier is ever reused."""
    return posixpath.join(shared_dir(spark), "casetrail", f"{name}-{uuid.uuid4().hex}")
