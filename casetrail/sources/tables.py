"""Reading stored tables and publishing results as tables and views.

A refresh writes a folder of its own, and counts from the moment a mark of its number stands beside it: readers have
the rows before or the rows after, never half of them, and a run that dies leaves the old ones.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# How files with timestamps of the old calendar are read.
REBASE_CORRECTED, REBASE_LEGACY = "CORRECTED", "LEGACY"

#: Versions that stay after a refresh: the new one, and the one that readers may still be reading.
KEPT_VERSIONS = 2
# Names that begin with an underscore are no data to a reader of the whole folder.
_MARK, _VERSION = "_current-", "version-"


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", rebase: str = REBASE_CORRECTED) -> DataFrame:
    """Columnar table by path, in its current version if it has several. Old-calendar dates follow ``rebase`` for this
    read only."""
    reader = spark.read.format(fmt)
    if fmt in ("parquet", "avro"):
        reader = reader.option("datetimeRebaseMode", rebase)
    if fmt == "parquet":
        reader = reader.option("int96RebaseMode", rebase)
    return reader.load(current_path(spark, path))


def current_path(spark: SparkSession, path: str) -> str:
    """Folder of the current version, or the path itself where nothing was refreshed by this module."""
    marks = _marks(spark, path)
    return posixpath.join(path, marks[-1].split("-", 2)[2]) if marks else path


def replace_files(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Full refresh of a table kept by path; gives the folder of the new version. The rows may come from the old one."""
    spark = df.sparkSession
    version = f"{_VERSION}{uuid.uuid4().hex}"
    df.write.format(fmt).save(posixpath.join(path, version))
    marks = _marks(spark, path)
    number = int(marks[-1].split("-", 2)[1]) + 1 if marks else 1
    files, folder = _folder(spark, path)
    # Of two refreshes at the same time that take the same number, the name decides for all readers alike.
    files.createNewFile(_path(spark, f"{path}/{_MARK}{number:020d}-{version}"))
    for mark in _marks(spark, path)[:-KEPT_VERSIONS]:
        files.delete(_path(spark, f"{path}/{mark}"), False)
        files.delete(_path(spark, f"{path}/{mark.split('-', 2)[2]}"), True)
    return posixpath.join(path, version)


def drop_unfinished(spark: SparkSession, path: str) -> int:
    """Deletes versions that no mark names, which runs that died have left; gives their number. Only for when no
    refresh is running."""
    files, _ = _folder(spark, path)
    named = {mark.split("-", 2)[2] for mark in _marks(spark, path)}
    left = [name for name in _names(spark, path) if name.startswith(_VERSION) and name not in named]
    for name in left:
        files.delete(_path(spark, f"{path}/{name}"), True)
    return len(left)


def replace_table(df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None) -> None:
    """Full refresh of a table by name, kept below ``path`` or the warehouse.

    The catalogue points to the new version once that is whole. A table whose columns change is named anew, so that a
    reader may for a moment find none.
    """
    spark = df.sparkSession
    base = path or posixpath.join(spark.conf.get("spark.sql.warehouse.dir"), name.replace("`", "").replace(".", "/") + "_versions")
    version = replace_files(df, base, fmt)
    same = spark.catalog.tableExists(name) and spark.table(name).schema.simpleString() == df.schema.simpleString()
    if same and spark.catalog.getTable(name).tableType == "EXTERNAL":
        quoted = version.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{quoted}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path=version, source=fmt, schema=df.schema)


def materialise_view(df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None) -> DataFrame:
    """Stores a view's rows unless it is stored already; gives the stored rows. A view is there once all of its rows
    are, so what a run that died has written doesn't count."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        replace_table(df, name, fmt, path)
    return spark.table(name)


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Creates or replaces a session view."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def drop_and_publish_view(df: DataFrame, name: str) -> DataFrame:
    """Drops the view if it is there, then creates it."""
    df.sparkSession.catalog.dropTempView(name)
    df.createTempView(name)
    return df.sparkSession.table(name)


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _folder(spark: SparkSession, path: str):
    folder = _path(spark, path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _names(spark: SparkSession, path: str) -> Iterator[str]:
    files, folder = _folder(spark, path)
    if files.exists(folder) and files.getFileStatus(folder).isDirectory():
        yield from (status.getPath().getName() for status in files.listStatus(folder))


def _marks(spark: SparkSession, path: str) -> list[str]:
    """Names of the marks, the current version's last."""
    return sorted(name for name in _names(spark, path) if name.startswith(_MARK))
