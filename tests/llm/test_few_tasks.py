"""Steps over few rows take few tasks, however many partitions a shuffle has."""

import pytest

from casetrail.llm.components import components

MANY = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture
def many_partitions(spark):
    before = {k: spark.conf.get(k) for k in MANY}
    for k, v in MANY.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def test_rounds_over_few_edges(many_partitions):
    # A chain of 40 nodes, a star of 40, and a pair.
    edges = [(k, k + 1) for k in range(39)] + [(100, 100 + k) for k in range(1, 40)] + [(500, 501)]
    sc, group = many_partitions.sparkContext, "rounds over few edges"
    sc.setJobGroup(group, group)
    try:
        rows = components(many_partitions.createDataFrame(edges, "u long, v long")).collect()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert {r["node"]: r["component"] for r in rows} == {k: 0 for k in range(40)} | {100 + k: 100 for k in range(40)} | {500: 500, 501: 500}
    tracker = sc.statusTracker()
    stages = {s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds}
    assert sum(info.numCompletedTasks for s in stages if (info := tracker.getStageInfo(s))) < 1_500
