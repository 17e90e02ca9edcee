"""Refreshes that readers never see half done."""

import uuid

import pytest
from pyspark.sql import functions as F

from casetrail.sources import tables


def broken(spark):
    """Rows of several files, of which the last can't be made."""
    return spark.range(0, 1000, 1, 4).select(F.when(F.col("id") == 999, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))


def total(df):
    return df.agg(F.sum("id")).first()[0]


def test_a_write_that_fails_halfway_leaves_the_old_rows(spark, tmp_path):
    path = f"{tmp_path}/kept"
    tables.replace_files(spark.range(10), path)
    with pytest.raises(Exception, match="lost"):
        tables.replace_files(broken(spark), path)
    assert total(tables.read_table(spark, path)) == 45
    assert tables.drop_unfinished(spark, path) == 1 and total(tables.read_table(spark, path)) == 45
    tables.replace_files(spark.range(3), path)
    assert total(tables.read_table(spark, path)) == 3


def test_readers_go_on_and_old_versions_go(spark, tmp_path):
    path = f"{tmp_path}/read"
    tables.replace_files(spark.range(4), path)
    reading = tables.read_table(spark, path)
    for _ in range(3):
        # A refresh from its own rows.
        tables.replace_files(tables.read_table(spark, path).select((F.col("id") * 2).alias("id")), path)
        assert total(reading) is not None
        reading = tables.read_table(spark, path)
    assert total(reading) == 6 * 8
    names = sorted(p.name for p in (tmp_path / "read").iterdir() if not p.name.endswith(".crc"))
    assert len([n for n in names if n.startswith("version-")]) == len([n for n in names if n.startswith("_current-")]) == tables.KEPT_VERSIONS


def test_plain_folders_and_files_are_read_as_they_are(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/plain")
    assert total(tables.read_table(spark, f"{tmp_path}/plain")) == 10


def test_a_table_is_replaced_when_its_rows_are_whole(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    for path in (None, f"{tmp_path}/named"):
        tables.replace_table(spark.range(10), name, path=path)
        with pytest.raises(Exception, match="lost"):
            tables.replace_table(broken(spark), name, path=path)
        assert total(spark.table(name)) == 45
        tables.replace_table(spark.range(3), name, path=path)
        assert total(spark.table(name)) == 3
        tables.replace_table(spark.range(2).withColumn("more", F.lit("x")), name, path=path)
        assert spark.table(name).columns == ["id", "more"] and total(spark.table(name)) == 1
        spark.sql(f"DROP TABLE {name}")


def test_a_view_that_was_left_half_made_is_made_again(spark, tmp_path):
    name = f"v_{uuid.uuid4().hex}"
    with pytest.raises(Exception, match="lost"):
        tables.materialise_view(broken(spark), name, path=f"{tmp_path}/view")
    assert not spark.catalog.tableExists(name)
    assert total(tables.materialise_view(spark.range(10), name, path=f"{tmp_path}/view")) == 45
    assert total(tables.materialise_view(spark.range(3), name, path=f"{tmp_path}/view")) == 45
    spark.sql(f"DROP TABLE {name}")
