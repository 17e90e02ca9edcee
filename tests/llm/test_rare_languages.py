"""Languages with a small share of the rows, and more of them than are looked at together."""

import random

import pytest
from pyspark.sql import functions as F

from casetrail.llm import language


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    letters = {"en": "abcdefgh", "nl": "ijklmnop", "fr": "qrstuvwx", "xx": "yzayzb"}
    sizes = {"en": 3_000, "fr": 30, "nl": 12, "xx": 2}

    def text(tag):
        return " ".join("".join(rng.choice(letters[tag]) for _ in range(5)) for _ in range(40))

    made = [(k, text(tag), tag) for k, tag in enumerate(t for t, n in sizes.items() for _ in range(n))]
    return spark.createDataFrame([*made, (9_999, None, "nl"), (9_998, made[0][1], "en")], "doc_id long, text string, lang string")


def test_small_share_is_a_class(rows):
    found = language.identify(rows, carried=["doc_id", "lang", "text"]).filter("text IS NOT NULL").collect()
    assert all(r.language == r.lang and r.accepted for r in found if r.lang != "xx")
    assert all(r.language in ("en", "fr", "nl") for r in found)


def test_in_parts_as_at_once(rows, monkeypatch):
    few = rows.filter("doc_id % 10 < 2 OR lang <> 'en'")
    answers = []
    for together in (200, 2):
        monkeypatch.setattr(language, "TOGETHER", together)
        got = language.identify(few, carried=["doc_id"]).withColumn("probability", F.round("probability", 9))
        answers.append(sorted(map(tuple, got.collect())))
    assert answers[0] == answers[1] and len(answers[0]) == few.count()


def test_rows_of_a_language_without_a_class_stay(spark):
    """Four rows make no class; their texts look like nothing known, and one has no letter."""
    rng = random.Random(5)
    texts = {tag: [" ".join("".join(rng.choice(pool) for _ in range(5)) for _ in range(30)) for _ in range(n)]
             for tag, pool, n in (("en", "abcdefgh", 40), ("fr", "qrstuvwx", 40), ("nl-BE", "abcdqrst", 4))}
    made = [(t, tag) for tag, several in texts.items() for t in several]
    made += [("12 34", "nl-BE"), ("12 34", "en"), (None, "sv"), ("", "da")]
    rows = spark.createDataFrame([(k, t, tag) for k, (t, tag) in enumerate(made)], "doc_id long, text string, lang string")
    only = rows.filter("lang <> 'nl-BE' OR text <> '12 34'")
    kept = {r.doc_id for r in language.keep_identified(only).collect()}
    assert kept == set(range(84))
    # With a fifth row the language is a class, and its rows are judged as any other's.
    assert {r.doc_id for r in language.keep_identified(rows).collect()} <= set(range(84))


def test_no_class_at_all(spark):
    rows = spark.createDataFrame([(1, "abc", "en"), (2, "12", "en"), (3, "abc", None), (None, "abc", "fr")], "doc_id long, text string, lang string")
    assert {r.doc_id for r in language.keep_identified(rows).collect()} == {1, None}
