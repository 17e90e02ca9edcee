"""Exact dedup where a few old ids are small and all others large."""

from casetrail.llm import exact_dedup


def uneven(spark):
    rows = [(1, "a"), (2, "b")] + [((1 << 62) + k * 10_000_000, f"t{k % 70}") for k in range(98)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_history_is_about_half_of_the_rows(spark):
    history, incoming = exact_dedup.older_half(uneven(spark))
    assert 45 <= history.count() <= 55 and history.count() + incoming.count() == 100


def test_shards_follow_both_sides(spark, monkeypatch):
    asked, groups = [], exact_dedup._groups
    monkeypatch.setattr(exact_dedup, "SHARD_DIGESTS", 10)
    monkeypatch.setattr(exact_dedup, "_groups", lambda rows, id, text, shards: asked.append(shards) or groups(rows, id, text, shards))
    rows = uneven(spark)
    found = exact_dedup.digest_groups(rows.filter("doc_id < 3"), rows.filter("doc_id >= 3"))
    assert {(r.group_size, r.in_history) for r in found.collect()} == {(1, True), (1, False), (2, False)}
    assert asked == [10, 10]
