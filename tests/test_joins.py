"""Joins, dedup, shaping and staging on small tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from casetrail.operators import dedup, routing, shape
from casetrail.operators.joins import decode, lookup, matching, spread_missing, without_match
from casetrail.plans.water_staging import AUTHORIZATION, JOB, TRACKING, WaterTables, water_staging


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_missing_keys_match_nothing_and_are_spread(spark):
    left = spark.createDataFrame([(i, None) for i in range(500)] + [(1000, "a")], "id int, k string")
    right = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    joined = lookup(left, right, [("k", "k")], columns=["v"])
    assert joined.count() == 501
    assert joined.filter("v is not null").collect()[0]["id"] == 1000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        used = lookup(left.repartition(32, "id"), right, [("k", "k")], columns=["v"]).select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert used > 4


def test_lookup_reads_no_further_column(spark, tmp_path):
    wide = spark.range(10).selectExpr("id AS k", "id AS wanted", *[f"id AS other_{i}" for i in range(5)])
    wide.write.parquet(f"{tmp_path}/wide")
    right = spark.createDataFrame([(1, 1)], "k long, v int")
    plan = lookup(spark.read.parquet(f"{tmp_path}/wide"), right, [("k", "k")], columns=["v"]).select("wanted", "v")
    text = plan._jdf.queryExecution().toString()
    assert "ReadSchema: struct<k:bigint,wanted:bigint>" in text and "other_" not in text.split("Physical Plan")[1]


def test_null_match_is_opt_in(spark):
    left = spark.createDataFrame([(1, None), (2, "a")], "id int, k string")
    right = spark.createDataFrame([(None, 7), ("a", 8)], "k string, v int")
    assert rows(lookup(left, right, [("k", "k")], columns=["v"], null_match=True)) == [(1, None, 7), (2, "a", 8)]


def test_duplicates_fan_out_and_clashes_are_renamed(spark):
    left = spark.createDataFrame([(1, "x")], "K int, NAME string")
    right = spark.createDataFrame([(1, "a", 5), (1, "b", 6)], "K int, name string, extra int")
    joined = lookup(left, right, [("K", "K")], suffix="__APP")
    assert joined.columns == ["K", "NAME", "K__APP", "name__APP", "extra"]
    assert joined.count() == 2
    assert lookup(left, right, [("K", "K")], columns=["name"], prefix="P_").columns == ["K", "NAME", "P_name"]


def test_semi_anti_and_decode(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, k string")
    codes = spark.createDataFrame([("a", "Letter A")], "CODE string, DESCRIPTION string")
    assert rows(matching(left, (codes, [("k", "CODE")])).select("id")) == [(1,)]
    assert rows(without_match(left, codes, [("k", "CODE")]).select("id")) == [(2,), (3,)]
    assert rows(decode(left, codes, [("k", "CODE")], {"DESCRIPTION": "name"})) == [
        (1, "a", "Letter A"), (2, None, None), (3, "c", None)]


def test_keep_first_and_any(spark):
    df = spark.createDataFrame([(3, None, 1), (1, None, 2), (2, "a", 3), (2, "a", 3)], "id int, k string, v int")
    assert rows(dedup.keep_first(df, ["k"], ["id"])) == [(1, None, 2), (2, "a", 3)]
    assert dedup.keep_any(df, ["k"]).count() == 2
    plan = dedup.keep_first(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_canonical_names(spark):
    df = shape.upper_names(spark.createDataFrame([(1, 2)], "` ats_link_id` int, Other int"))
    assert df.columns == ["ATS_LINK_ID", "OTHER"]
    named = shape.canonical(df, "ATSLINKID", ["ATS_LINKID", "ATS_LINK_ID"], "links")
    assert named.columns == ["ATS_LINK_ID", "OTHER", "ATSLINKID"]
    with pytest.raises(shape.MissingColumn, match="no column of links can serve as X.*ATS_LINK_ID, OTHER"):
        shape.canonical(df, "X", ["Y"], "links")


def test_existing_empty_column_is_not_refilled(spark):
    df = spark.createDataFrame([(None, "v")], "a string, b string")
    assert rows(shape.ensure_columns(df, {"a": ("b",), "c": ("a", "b"), "d": ("none",)})) == [(None, "v", "v", None)]


def test_first_useful_mixes_types_as_text(spark):
    df = spark.createDataFrame([("10:30", dt.datetime(2020, 1, 1)), (" ", None), ("x", None)], "a string, b timestamp_ntz")
    got = df.select(shape.first_useful(df, ["a", "zzz", "b"]).alias("r")).collect()
    assert [r["r"] for r in got] == ["2020-01-01 00:00:00", None, "x"]


def test_landing_is_lossy_but_never_fails(spark):
    df = spark.createDataFrame([("12.7", 3.99, 1e300)], "a string, b double, c double")
    got = shape.land(df, [("b", "B2", "int"), ("c", "C2", "bigint"), ("a", "A2", "int"), ("A", "D", "decimal(38,18)")])
    assert got.columns == ["B2", "C2", "A2", "D"]
    row = got.collect()[0]
    assert (row["B2"], row["C2"], row["A2"]) == (3, None, None)
    assert str(row["D"]) == "12.700000000000000000"


def test_split_keeps_unknown_rows(spark):
    df = spark.createDataFrame([(1,), (None,), (5,)], "x int")
    low, rest = routing.split(df, F.col("x") < 3)
    assert (low.count(), rest.count()) == (1, 2)
    assert routing.append(low.withColumn("y", F.lit(1)), rest).columns == ["x", "y"]


def water_tables(spark):
    jobs = spark.createDataFrame(
        [("J1", "T1", None, 100.0), ("J2", " T1 ", None, None), (None, "T2", None, None), (" ", None, 7, None),
         ("J3", None, None, 999.0)],
        "JOBNUMBER string, VFCTRACKINGNUMBER string, ATSLINKID int, AUTHORIZATIONID double")
    applications = spark.createDataFrame([("T1", 5), ("T2", 6), (None, 7)], "TRACKINGNUMBER string, ATSLINKID int")
    links = spark.createDataFrame([(5, 100), (5, 101), (6, 102), (7, 103)], "ATSLINKID int, ATSAUTHORIZATIONNUMBER int")
    authorizations = spark.createDataFrame(
        [("100", "A100"), ("101.0", "A101"), ("102", "A102"), ("103", "A103"), ("999", "A999")],
        "AUTHORIZATION_ID string, FILE_NUMBER string")
    return WaterTables(jobs, applications, links, authorizations)


@pytest.mark.parametrize(("route", "corrected", "expected"), [
    (JOB, False, [("J1", 100, "A100"), ("J1", 101, "A100"), ("J2", 100, "A100"), ("J2", 101, "A101"), ("J3", None, "A999")]),
    (JOB, True, [("J1", 100, "A100"), ("J2", 100, "A100"), ("J2", 101, "A101"), ("J3", None, "A999")]),
    (TRACKING, False, [("T2", 102, "A102")]),
    (TRACKING, True, [("T2", 102, "A102")]),
    (AUTHORIZATION, False, [("103", 103, "A103")]),
])
def test_water_routes(spark, route, corrected, expected):
    staged = water_staging(water_tables(spark), route, "PERMIT_ID", corrected)
    got = staged.select("PERMIT_ID", "ATSAUTHORIZATIONNUMBER", "FILE_NUMBER")
    assert rows(got) == sorted(expected, key=repr)
    assert not [c for c in staged.columns if c.startswith("__")]
    assert "CODE_CHR_STATUS != 'DI'" in staged.columns
    assert {r[0] for r in staged.select("`CODE_CHR_STATUS != 'CA'`").collect()} == {"OK"}


def test_trusted_links_equal_split_and_append(spark):
    """One join with a wildcard gives what two branches joined apart and appended give."""
    t = water_tables(spark)
    together = water_staging(t, JOB, "PERMIT_ID", corrected=True)
    own, none = routing.split(t.jobs, F.col("AUTHORIZATIONID").isNotNull())
    branches = [
        water_staging(WaterTables(part, t.applications, t.links, t.authorizations), JOB, "PERMIT_ID", corrected=True)
        for part in (own, none)
    ]
    assert rows(together) == rows(routing.append(*branches))


def without_broadcast(spark):
    for name, value in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.enabled", "false")):
        spark.conf.set(name, value)


@pytest.fixture
def plain_shuffles(spark):
    without_broadcast(spark)
    yield spark
    for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"):
        spark.conf.unset(name)


def chained(orders):
    """Two lookups in a row; two thirds of the rows have no key in the first, and three quarters none in the second."""
    spark = orders.sparkSession
    customers = spark.createDataFrame([(i, i % 7 if i % 2 else None) for i in range(40)], "k int, nation int")
    nations = spark.createDataFrame([(i, f"n{i}") for i in range(7)], "nation int, name string")
    return lookup(lookup(orders, customers, [("k", "k")], columns=["nation"]), nations, [("nation", "nation")], columns=["name"])


def many_orders(spark):
    return spark.range(3000).selectExpr("id", "CAST(IF(id % 3 = 0, id % 40, NULL) AS INT) AS k").repartition(6, "id")


def test_place_of_keyless_rows_doesnt_depend_on_their_order(plain_shuffles):
    """What a task that runs again sends arrives in another order, and must go to the same tasks."""
    orders = many_orders(plain_shuffles)
    places = [
        rows(chained(again).select("id", F.spark_partition_id().alias("place")))
        for again in (orders.sortWithinPartitions("id"), orders.sortWithinPartitions(F.desc("id")))
    ]
    assert places[0] == places[1] and len({p for _, p in places[0]}) > 4
    holds = plain_shuffles.createDataFrame([("1", [1])], "__hold_key string, on_hold_event_set array<int>")
    keyed = [
        rows(again.withColumn("__hold_key", spread_missing(F.lit(None).cast("string"))).join(holds, "__hold_key", "left")
             .select("id", F.spark_partition_id().alias("place")))
        for again in (orders.sortWithinPartitions("id"), orders.sortWithinPartitions(F.desc("id")))
    ]
    assert keyed[0] == keyed[1] and len({p for _, p in keyed[0]}) > 2


def test_lost_map_outputs_lose_and_double_no_row(plain_shuffles):
    spark = plain_shuffles
    joined = chained(many_orders(spark))
    jvm_rows = joined._jdf.queryExecution().toRdd()
    assert jvm_rows.count() == 3000
    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    shuffles = {d for d in joined.rdd.toDebugString().decode().split() if d.startswith("Shuffled")}
    assert shuffles
    thrown = 0
    ids = tracker.shuffleStatuses().keys().iterator()
    while ids.hasNext():
        shuffle = ids.next()
        statuses = tracker.shuffleStatuses().apply(shuffle).mapStatuses()
        for task in range(0, len(statuses), 2):
            if statuses[task] is not None:
                tracker.unregisterMapOutput(shuffle, task, statuses[task].location())
                thrown += 1
    assert thrown and jvm_rows.count() == 3000
    got = joined.collect()
    assert sorted(r["id"] for r in got) == list(range(3000))
    wanted = {i: (f"n{i % 40 % 7}" if i % 3 == 0 and i % 40 % 2 else None) for i in range(3000)}
    assert {r["id"]: r["name"] for r in got} == wanted


def test_no_running_number_below_a_shuffle(spark):
    plans = [
        chained(many_orders(spark)),
        without_match(many_orders(spark), spark.createDataFrame([(1,)], "k int"), [("k", "k")]),
        water_staging(water_tables(spark), JOB, "PERMIT_ID", corrected=True),
    ]
    for plan in plans:
        assert "monotonically_increasing_id" not in plan._jdf.queryExecution().toString().lower()
