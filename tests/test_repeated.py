"""Rows repeated by a number, and joins that carry each of them once."""

from pyspark.sql import functions as F

from __spark_entry__ import queries
from casetrail.operators.joins import repeated
from tests.conftest import SMALL


def test_each_as_often_as_it_says(spark):
    numbers = [None, -1, 0, 1, 2, 999, 1_000, 1_001, 2_000, 2_500]
    df = spark.createDataFrame([(k, n) for k, n in enumerate(numbers)], "k int, `a.b` long")
    found = repeated(df, F.col("`a.b`"))
    assert found.columns == df.columns
    assert {r["k"]: r["count"] for r in found.groupBy("k").count().collect()} == {k: n for k, n in enumerate(numbers) if n and n > 0}


def test_applications_are_repeated_behind_the_joins(spark):
    df = queries()["applications_with_authorizations"](spark, SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" in plan[: plan.index("Join")]
