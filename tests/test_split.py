"""Pieces of a table by its own keys."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from casetrail.sources.replicate import JdbcSource, ReplicaSpec
from casetrail.sources.split import (
    KEY_NUMBERS, Unsplittable, key_bounds, number_predicates, range_predicates, split_report,
)


def report(rows, predicates):
    return split_report(rows, predicates).first().asDict()


@pytest.mark.parametrize("key", [
    "id * id * id", "CAST(id * id AS DECIMAL(20,2)) / 4", "CAST(pow(1.01, id % 2000) AS DOUBLE)", "DATE '2000-01-01' + CAST(pow(1.001, id) AS INT)",
    "TIMESTAMP_NTZ '2000-01-01' + make_interval(0, 0, 0, 0, 0, 0, pow(1.002, id))", "-id * id",
])
def test_ranges_of_uneven_keys(spark, key):
    rows = spark.range(6400).selectExpr(f"IF(id = 7, NULL, {key}) AS k")
    got = report(rows, range_predicates("k", key_bounds(rows, "k", 64)))
    assert got["rows"] == got["rows_taken_once"] == 6400
    if not key.startswith("DATE"):
        assert got["pieces"] == 64 and got["most"] < 2 * got["fewest"]


def test_a_heavy_key_takes_a_piece_for_itself(spark):
    rows = spark.range(3000).selectExpr("IF(id % 3 = 0, 500, id) AS k")
    got = report(rows, range_predicates("k", key_bounds(rows, "k", 10)))
    assert got["rows_taken_once"] == 3000 and got["most"] < 1300 and got["pieces"] < 10


def test_bounds_of_a_sample_cut_the_table(spark):
    rows = spark.range(20_000).selectExpr("id * id AS k")
    got = report(rows, range_predicates("k", key_bounds(rows.filter("xxhash64(k) % 4 = 0"), "k", 16)))
    assert got["rows_taken_once"] == 20_000 and got["most"] < 2 * got["fewest"]


def test_few_keys_or_none(spark):
    empty = spark.range(0).selectExpr("id AS k")
    assert key_bounds(empty, "k", 8) == [] and range_predicates("k", []) == ["1 = 1"]
    same = spark.range(50).selectExpr("IF(id < 10, NULL, 3) AS k")
    assert key_bounds(same, "k", 8) == [] and key_bounds(same, "k", 1) == []
    assert report(same, ["1 = 1"]) == {"pieces": 1, "rows": 50, "rows_taken_once": 50, "fewest": 50, "most": 50}
    with pytest.raises(ValueError):
        key_bounds(same, "k", 0)


def test_text_keys_are_cut_by_number(spark):
    rows = spark.range(6400).selectExpr("IF(id = 7, NULL, concat('A', id)) AS k")
    with pytest.raises(Unsplittable, match="'k' is string"):
        key_bounds(rows, "k", 8)
    got = report(rows, number_predicates("k", 16, "spark"))
    assert got["rows_taken_once"] == 6400 and got["most"] < 2 * got["fewest"]
    assert set(KEY_NUMBERS) > {"oracle", "sqlserver"}
    assert number_predicates("K", 2, "oracle")[1] == "(K IS NOT NULL AND ORA_HASH(K, 2 - 1) = 1)"
    with pytest.raises(ValueError, match="no key number"):
        number_predicates("K", 2, "punch cards")


def test_literals():
    assert range_predicates("k", [dt.date(2020, 1, 2)])[1] == "(k >= DATE '2020-01-02')"
    assert range_predicates("k", [Decimal("1E+3")])[1] == "(k >= 1000)"
    assert range_predicates("k", [dt.datetime(2020, 1, 2, 3, 4, 5, 6)])[1] == "(k >= TIMESTAMP '2020-01-02 03:04:05.000006')"


def test_a_table_needs_a_way_to_be_split(spark):
    source = JdbcSource("jdbc:none", {}, {}, predicates={"A.B": ["1 = 1"]})
    with pytest.raises(ValueError, match="needs predicates or a range"):
        source.read(spark, ReplicaSpec("A", "C", "x", "c"))
