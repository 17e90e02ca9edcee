"""Counts of a job whose map stage runs twice."""

import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from casetrail.operators.events import RecordSpec, record_json
from casetrail.operators.facets import Facets
from casetrail.operators.report import packed_hits, unpacked_hits
from casetrail.operators.rules import match_column, parse_hold_rules, parse_rules
from casetrail.plans import event_sets

SPEC = RecordSpec(id_column="PERMIT_ID", default_system_id="S", process_code_system="p", hold_code_system="h")
RULES = parse_rules({
    f"R{i}": {"start_attr": "DAY", "logic": {"and": [{"op": "=", "attr": "KIND", "value": f"k{i}"}]}} for i in range(70)
})
HOLD_RULES = parse_hold_rules({
    "H": {"code": "C", "start_attr": "ON_HOLD_START_DATE",
          "logic": {"and": [{"op": "=", "attr": "ATHN_ON_HOLD_REASON_CODE", "value": "1"}]}},
})


def permits(spark, n=2000):
    return spark.range(0, n, 1, 6).selectExpr(
        "id AS PERMIT_ID", "concat('k', id % 100) AS KIND", "'2020-01-02' AS DAY", "CAST(id % 50 AS STRING) AS AUTHORIZATION_ID")


def holds(spark):
    return spark.range(0, 200, 1, 3).selectExpr(
        "id AS AUTHORIZATION_ON_HOLD_ID", "CAST(id % 2 AS STRING) AS ATHN_ON_HOLD_REASON_CODE",
        "CAST(id % 100 AS STRING) AS AUTHORIZATION_ID", "'2020-01-03' AS ON_HOLD_START_DATE", "CAST(NULL AS STRING) AS ON_HOLD_END_DATE")


@pytest.fixture
def plain_shuffles(spark):
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for name, value in changed.items():
        spark.conf.set(name, value)
    yield spark
    for name in changed:
        spark.conf.unset(name)


def test_packed_hits_are_those_of_the_rules(spark):
    rows = permits(spark)
    facets = Facets(rows.schema)
    packed = packed_hits(RULES, facets, "m")
    assert list(packed) == ["m0", "m1"]
    plain = [F.count_if(match_column(r, facets)).alias(f"hit_{i}") for i, r in enumerate(RULES)]
    projected = facets.project(rows)
    wanted = projected.agg(*plain).first().asDict()
    assert projected.select(*[c.alias(n) for n, c in packed.items()]).agg(*unpacked_hits(RULES, "m")).first().asDict() == wanted
    assert set(wanted.values()) == {20}
    assert packed_hits([], facets, "m") == {} and unpacked_hits([], "m") == []


def test_counts_hold_when_the_map_stage_runs_again(plain_shuffles, tmp_path):
    """Shuffle files vanish while the writing stage reads them; what stands in front of the shuffle counts twice."""
    spark = plain_shuffles
    below, seen, holds_seen, made = Observation(), Observation(), Observation(), Observation()
    given = permits(spark).observe(below, F.count(F.lit(1)).alias("rows"))
    records = event_sets.event_set_with_holds(
        given, holds(spark), event_sets.Ruleset(RULES, HOLD_RULES), SPEC, seen=seen, holds_seen=holds_seen)
    records = records.observe(made, F.count(F.lit(1)).alias("records"), F.sum(F.size("process_event_set")).alias("process"))
    folders = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    flag = str(tmp_path / "thrown-away")

    def lose_shuffle_files(batches):
        import glob
        import os
        import time

        for batch in batches:
            if not os.path.exists(flag):
                open(flag, "w").close()
                for folder in folders:
                    for name in glob.glob(f"{folder}/**/shuffle_*", recursive=True):
                        os.remove(name)
            time.sleep(0.2)
            yield batch

    lines = record_json(records).select("value").mapInPandas(lose_shuffle_files, "value string")
    lines.write.mode("overwrite").text(str(tmp_path / "out"))
    assert below.get["rows"] > 2000, "the map stage has run again"
    got = seen.get
    assert got["source_rows"] == 2000
    assert [got[f"hit_{i}"] for i in range(70)] == [20] * 70
    assert holds_seen.get["hit_0"] == 2000
    stored = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert made.get == {"records": len(stored), "process": 1400}
    assert sum(len(r["process_event_set"]) for r in stored) == 1400 and len({r["record_id"] for r in stored}) == len(stored)


@pytest.mark.parametrize("limit", [0, 500])
def test_nothing_is_observed_in_front_of_a_shuffle(plain_shuffles, limit):
    spark = plain_shuffles
    rows = permits(spark).limit(limit) if limit else permits(spark)
    records = event_sets.event_set_with_holds(
        rows, holds(spark), event_sets.Ruleset(RULES, HOLD_RULES), SPEC, seen=Observation(), holds_seen=Observation())
    plan = records._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = {word: [len(line) - len(line.lstrip(" :+-|")) for line in plan if word in line] for word in ("CollectMetrics", "Exchange")}
    assert depth["CollectMetrics"] and max(depth["CollectMetrics"]) < min(depth["Exchange"])
