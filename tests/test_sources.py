"""Configuration, replication specs, sharing specs, tables and lines."""

import json

import pytest
from pyspark.sql import functions as F

from casetrail.operators import delivery
from casetrail.session import scratch_path, shared_dir
from casetrail.sources import config, jsonl, tables
from casetrail.sources.catalogue import SYSTEMS, replica_specs
from casetrail.sources.replicate import ReplicaSpec, landed, replicate, specs_from_copy_job
from casetrail.sources.sharing import PERMIT_VIEWS, RIPARIAN_VIEWS, publish_share, shared_rows


def test_catalogue_covers_every_copied_table():
    specs = replica_specs()
    assert len(specs) == len({s.target for s in specs}) == 190
    assert len(SYSTEMS) == 16
    targets = {s.source: s.target for s in specs}
    assert targets["ATS.ATS_ATHN_ON_HOLD_REASON_CODES"] == "ats_replication.ats_athn_on_hold_reasons_code"
    assert targets["THE.TIMBER_MARK"] == "fta_replication.fta_timber_mark"
    assert targets["CORRAL_GENERATED_VIEWS.AMSPROCESSES"] == "apts_replication.apts_amsprocesses"


def test_copy_job_documents_give_specs(spark):
    def column(name, kind, **extra):
        return {"source": {"name": name}, "destination": {"name": name.lower(), "physicalType": kind, **extra}}

    job = {"activities": [
        {"properties": {"source": {"datasetSettings": {"schema": "S", "table": "A"}},
                        "destination": {"datasetSettings": {"schema": "raw", "table": "a"}}}},
        {"properties": {"source": {"datasetSettings": {"schema": "S", "table": "B"}},
                        "destination": {"datasetSettings": {"schema": "raw", "table": "b2"}},
                        "translator": {"mappings": [column("ID", "long"), column("N", "decimal", precision=38, scale=18)]}}},
    ]}
    plain, mapped = specs_from_copy_job(job)
    assert (plain.source, plain.target, plain.mapping) == ("S.A", "raw.a", ())
    assert mapped.mapping == (("ID", "id", "bigint"), ("N", "n", "decimal(38,18)"))
    df = spark.createDataFrame([(1.9, 2, "x")], "id double, n int, secret string")
    assert landed(df, mapped).columns == ["id", "n"]
    assert landed(df, mapped).collect()[0]["id"] == 1


def test_replicate_overwrites_managed_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS raw_test")
    spec = ReplicaSpec("S", "T", "raw_test", "t")
    for rows in ([(1,), (2,)], [(3,)]):
        replicate(spark, [spec], read=lambda s, _, rows=rows: s.createDataFrame(rows, "x int"))
    assert [r["x"] for r in spark.table("raw_test.t").collect()] == [3]


def test_sharing_specs():
    assert (len(PERMIT_VIEWS), len(RIPARIAN_VIEWS)) == (15, 16)
    by_view = {s.view: s for s in (*PERMIT_VIEWS, *RIPARIAN_VIEWS)}
    assert len(by_view["apts_amsprocesses_subset"].only[1]) == 18
    assert by_view["apts_amsprocesses_subset"].source == "apts_amsprocesses"
    assert by_view["rar_people_redacted"].columns[-1] == "REGISTRATION_NUMBER"
    assert by_view["rar_dev_assess_status_audit"].clean_dates == ("WHEN_CREATED",)
    assert by_view["rar_dev_assessments"].clean_dates == (
        "PROPOSED_START_DATE", "PROPOSED_END_DATE", "WHEN_CREATED", "WHEN_UPDATED")
    assert all(len(set(s.columns)) == len(s.columns) for s in by_view.values())


def test_every_shared_view_can_be_built(spark):
    for spec in (*PERMIT_VIEWS, *RIPARIAN_VIEWS):
        kinds = ", ".join(f"{c} {'timestamp' if c in spec.clean_dates else 'string'}" for c in (*spec.columns, "HIDDEN"))
        shared = shared_rows(spark.createDataFrame([], kinds), spec)
        assert shared.columns == list(spec.columns)


def test_share_is_stored_once(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS share_test")
    spec = next(s for s in PERMIT_VIEWS if s.view == "apts_ar_bordennumber")
    table = spark.createDataFrame([(1, "B-1", "secret")], "OBJECTID int, BORDENNUMBER string, OTHER string")
    publish_share({spec.source: table}, spec, "share_test")
    again = publish_share({spec.source: table.withColumn("BORDENNUMBER", F.lit("new"))}, spec, "share_test")
    assert [tuple(r) for r in again.collect()] == [(1, "B-1")]


def test_views_are_replaced_or_dropped_first(spark):
    df = spark.createDataFrame([(1,)], "x int")
    tables.publish_view(df, "some_view")
    assert tables.publish_view(df.withColumn("y", F.lit(2)), "some_view").columns == ["x", "y"]
    assert tables.drop_and_publish_view(df, "some_view").columns == ["x"]
    assert tables.drop_and_publish_view(df, "fresh_view").count() == 1


def test_tables_by_path_with_rebase(spark):
    path = scratch_path(spark, "rebase")
    assert path.startswith(shared_dir(spark))
    tables.replace_files(spark.createDataFrame([(1,)], "x int"), path)
    tables.replace_files(spark.createDataFrame([(2,)], "x int"), path)
    for mode in (tables.REBASE_CORRECTED, tables.REBASE_LEGACY):
        assert tables.read_table(spark, path, rebase=mode).collect()[0]["x"] == 2


def test_configuration_files(spark, tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps({"R": {"logic": {"and": []}}}, indent=2), encoding="utf-8")
    assert [r.key for r in config.read_rules(spark, str(path))] == ["R"]
    assert config.read_hold_rules(spark, None) == [] and config.read_map(spark, None) == {}
    listing = tmp_path / "list.json"
    listing.write_text("[1]", encoding="utf-8")
    assert config.read_map(spark, str(listing)) == {}
    (tmp_path / "two").mkdir()
    for name in "ab":
        (tmp_path / "two" / name).write_text("{}")
    with pytest.raises(ValueError, match="more than one file"):
        config.read_json(spark, str(tmp_path / "two"))
    broken = tmp_path / "broken.json"
    broken.write_text("{")
    assert config.read_map(spark, str(broken), tolerant=True) == {}
    with pytest.raises(ValueError):
        config.read_map(spark, str(broken))


ATTEMPTS = {
    "ok": [200], "retry then ok": [503, None, 201], "never ok": [503, 429, 500], "raised": [None, None, None],
    "refused": [400, 200], "refreshed": [401, 200], "refreshed once only": [401, 403, 200], "auth at last": [500, 500, 401],
    "late": [503], "four": [503, 503, 503, 200],
}
EXPECTED = {
    "ok": ("delivered", 1, 200, None), "retry then ok": ("delivered", 3, 201, None),
    "never ok": ("failed", 3, 500, "HTTP 500: e3"), "raised": ("failed", 3, None, "e3"),
    "refused": ("failed", 1, 400, "HTTP 400: e1"), "refreshed": ("delivered", 2, 200, None),
    "refreshed once only": ("failed", 2, 403, "HTTP 403: e2"), "auth at last": ("failed", 3, 401, "HTTP 401: e3"),
    "late": ("pending", 1, None, None), "four": ("failed", 3, 503, "HTTP 503: e3"),
}


def attempt_log(spark):
    return spark.createDataFrame(
        [(name, i, n, status, f"e{n}") for i, (name, log) in enumerate(ATTEMPTS.items()) for n, status in enumerate(log, 1)],
        "record_id string, line_no int, attempt int, status int, error string")


def test_delivery_outcomes(spark):
    got = {r["record_id"]: (r["outcome"], r["attempts"], r["status_code"], r["error"])
           for r in delivery.outcomes(attempt_log(spark)).collect()}
    assert got == EXPECTED
    without = delivery.outcomes(attempt_log(spark), with_auth=False).filter("record_id = 'refreshed'").collect()[0]
    assert (without["outcome"], without["attempts"]) == ("failed", 1)


def test_backoff_is_capped(spark):
    got = spark.range(1, 8).select(delivery.backoff_seconds(F.col("id")).alias("s")).collect()
    assert [r["s"] for r in got] == [1, 2, 4, 8, 10, 10, 10]


def test_error_bucket_and_totals(spark):
    decided = delivery.outcomes(attempt_log(spark))
    records = spark.createDataFrame(
        [(name, i, json.dumps({"record_id": name})) for i, name in enumerate(ATTEMPTS)],
        "record_id string, line_no int, value string")
    lines = [json.loads(r["value"]) for r in delivery.error_lines(delivery.error_bucket(decided, records)).collect()]
    assert len(lines) == sum(e[0] == "failed" for e in EXPECTED.values())
    raised = next(x for x in lines if x["record_id"] == "raised")
    assert raised == {"line_no": 3, "record_id": "raised", "status_code": None, "error": "e3",
                      "record": {"record_id": "raised"}}
    assert tuple(delivery.totals(decided).collect()[0]) == (3, 6, 1)


def test_sendable_lines(spark):
    df = spark.createDataFrame([('{"a":1}',), ("  ",), ("{bad",), (None,), (' {"b":2} ',)], "value string")
    assert delivery.sendable_lines(df).count() == 2


def test_lines_are_numbered_where_they_stand(spark, tmp_path):
    wanted = []
    folder = tmp_path / "lines"
    folder.mkdir()
    for k, size in enumerate((500, 0, 3, 1200, 1)):
        texts = [f"{k}:{i}" + "x" * (i % 50) for i in range(size)]
        (folder / f"part-{k}.txt").write_text("".join(t + "\n" for t in texts))
        wanted += [(t, i + 1) for i, t in enumerate(texts)]
    for size in ("1000", "134217728"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        try:
            got = jsonl.read_numbered_lines(spark, str(folder)).orderBy("line_no").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert [r["line_no"] for r in got] == list(range(1, len(wanted) + 1))
        assert [(r["value"], r["line_in_file"]) for r in got] == wanted
