"""Every operator on odd input and on empty tables."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from casetrail.llm import chat, decontaminate, exact_dedup, language, lm_score, near_dedup, pieces, quality, substrings, toxicity


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(
        [(1, "ONE"), (2, None), (None, "one"), (3, ""), (4, "9 10 11 12"), (5, "1 2 3 4 5 6 7 8 9 10 11 12"), (5, "1 2 3 4 5 6 7 8 9 10 11 12"), (6, "zz yy")],
        "item_id long, text string",
    )


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, k % 2, (k + 1) % 2) for k in range(1, 16)] + [(None, 1, 1), (1, None, None), (2, 7, 0)], "doc_id long, quality int, toxic int")


def plain(rows, *columns):
    return Counter(tuple(r[c] for c in columns) for r in rows.collect())


def test_exact_dedup(odd, none):
    rows = odd.collect()
    best = {}
    for r in rows:
        t = r.text or ""
        best[t] = max(best.get(t, (-1, 0)), (r.doc_id if r.doc_id is not None else -1, 0))
    sizes = Counter(r.text or "" for r in rows)
    wanted = Counter()
    for r in rows:
        t = r.text or ""
        keep = best[t][0] if best[t][0] >= 0 else None
        wanted[(r.doc_id, keep, sizes[t], r.doc_id == keep, hashlib.sha256(t.encode()).hexdigest())] += 1
    found = exact_dedup.find_repeats(*exact_dedup.older_half(odd))
    assert plain(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == wanted
    kept = exact_dedup.keep_last(odd)
    assert kept.columns == odd.columns
    assert sorted(r.text or "" for r in kept.collect()) == sorted(sizes)
    assert exact_dedup.find_repeats(none, none).count() == 0 and exact_dedup.keep_last(none).count() == 0
    assert plain(exact_dedup.find_repeats(none, odd), "doc_id", "keep_id") == plain(found, "doc_id", "keep_id")


def shingles(text, size):
    w = (text or "").encode().lower().split()
    return {tuple(w)} - {()} if len(w) < size else {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def test_near_dedup(odd, none):
    rows = odd.collect()
    sets = [shingles(r.text, 5) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    wanted = Counter()
    for i, r in enumerate(rows):
        ids = [rows[k].doc_id for k in range(len(rows)) if group[k] == group[i] and rows[k].doc_id is not None] if sets[i] else [r.doc_id]
        least = min([x for x in ids if x is not None], default=None)
        wanted[(r.doc_id, len(sets[i]), least, r.doc_id == least)] += 1
    found = near_dedup.find_near_duplicates(odd, size=5, percent=80)
    assert plain(found, "doc_id", "n_shingles", "component_id", "kept") == wanted
    kept = near_dedup.keep_one_of_each(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len({group[i] for i in range(len(rows)) if sets[i]}) + sum(not s for s in sets)
    assert near_dedup.find_near_duplicates(none).count() == 0 and near_dedup.keep_one_of_each(none).count() == 0


def test_decontamination(odd, none, items):
    found = {(r.doc_id, r.text): r for r in decontaminate.find_leaks(odd, items).collect()}
    assert found[(6, "one")]._n_hit == 1 and found[(6, "one")]._leaks == ["1"]
    assert found[(8, "ONE")]._leaks == ["1"] and found[(15, "1 2 3 4 5 6 7 8 9 10 11 12")]._n_hit == 12
    assert found[(15, "1 2 3 4 5 6 7 8 9 10 11 12")]._leaks == ["4", "5"]
    assert found[(None, None)]._n_words == 0 and found[(14, "!!! ... ???")]._n_words == 0
    rest = [r for (i, t), r in found.items() if i not in (6, 7, 8, 15)]
    assert all(r._n_hit == 0 and r._leaks == [] for r in rest)
    kept = decontaminate.drop_leaks(odd, items)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 4
    assert decontaminate.find_leaks(none, items).count() == 0
    assert decontaminate.find_leaks(odd, items.limit(0)).filter("_n_hit > 0").count() == 0


def test_substrings(odd, none):
    rows = odd.collect()
    first = {}
    words = [(r.text or "").encode().split() for r in rows]
    number = [float("inf") if r.doc_id is None else r.doc_id for r in rows]
    for n, w in zip(number, words):
        for i in range(len(w) - 12):
            g = tuple(w[i : i + 13])
            first[g] = min(first.get(g, n), n)
    wanted = Counter()
    for r, n, w in zip(rows, number, words):
        gone = {p for i in range(len(w) - 12) if first[tuple(w[i : i + 13])] < n for p in range(i, i + 13)}
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        wanted[(r.doc_id, len(w), len(gone), hashlib.sha256(kept).hexdigest())] += 1
    assert plain(substrings.remove_repeats(odd), "doc_id", "n_words", "n_removed", "kept_sha256") == wanted
    assert substrings.remove_repeats(none).count() == 0


@pytest.mark.parametrize("window", [1, 7, 8, 30])
def test_substrings_of_other_lengths(odd, window):
    assert substrings.ladder(30) == [4, 8, 15, 30] and substrings.ladder(50) == [7, 13, 25, 50] and substrings.ladder(13) == [7, 13]
    few = odd.filter("doc_id IS NOT NULL AND length(text) < 10000").select("doc_id", "text").distinct()
    rows, first = few.collect(), {}
    for r in rows:
        w = r.text.split()
        for i in range(len(w) - window + 1):
            first[tuple(w[i : i + window])] = min(first.get(tuple(w[i : i + window]), r.doc_id), r.doc_id)
    wanted = Counter()
    for r in rows:
        w = r.text.encode().split()
        t = r.text.split()
        if len(w) != len(t):
            continue
        gone = {p for i in range(len(t) - window + 1) if first[tuple(t[i : i + window])] < r.doc_id for p in range(i, i + window)}
        wanted[(r.doc_id, len(t), len(gone))] += 1
    found = plain(substrings.remove_repeats(few, window=window), "doc_id", "n_words", "n_removed")
    assert all(found[k] >= v for k, v in wanted.items())


def test_language(odd, none):
    found = language.identify(odd, "text", "lang", F.col("source"), carried=["doc_id", "text"]).collect()
    assert len(found) == odd.count()
    assert all((r.language == "und") == (not any(c.isalpha() or ord(c) > 127 for c in r.text or "")) for r in found)
    assert all(r.probability == 0 and not r.accepted for r in found if r.language == "und")
    kept = language.keep_identified(odd, "doc_id", "text", "lang", F.col("source"))
    assert kept.columns == odd.columns and kept.count() == sum(r.accepted for r in found)
    assert language.identify(none, carried=["doc_id"]).count() == 0 and language.keep_identified(none).count() == 0
    bare = language.identify(odd.withColumn("lang", F.lit(None).cast("string")), carried=["doc_id"])
    assert {r.language for r in bare.collect()} == {"und"}


def test_quality(odd, none, labels):
    model = quality.train(odd, labels)
    found = quality.score_quality(odd, model).collect()
    assert len(found) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    assert all(r.held_out for r in found if r.doc_id is None)
    assert quality.score_quality(none, model).count() == 0
    assert {r.score for r in quality.score_quality(odd, quality.train(none, labels)).collect()} == {0.5}


def test_toxicity(odd, none, labels):
    grammar = toxicity.learn(odd, labels)
    found = toxicity.score_toxicity(odd, grammar).collect()
    assert len(found) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    assert toxicity.score_toxicity(none, grammar).count() == 0
    assert len({r.score for r in toxicity.score_toxicity(odd, toxicity.learn(none, labels)).collect()}) == 1


def test_lm_scores(odd, none):
    found = lm_score.score_texts(odd).collect()
    assert len(found) == odd.count() and all(r.score < 0 and r.base_score < 0 for r in found)
    assert sorted(r.n_tokens for r in found) == sorted(len((r.text or "").encode().split()) + 1 for r in odd.collect())
    assert lm_score.score_texts(none).count() == 0
    untrained = lm_score.score_texts(odd.filter("doc_id IS NULL")).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in untrained)


def test_pieces(odd, none):
    model = pieces.load_model(pieces.default_model())
    found = pieces.encode_texts(odd, model)
    got = Counter((r.doc_id, r.decoded) for r in found.collect())
    assert got == Counter((r.doc_id, None if r.text is None else r.text.replace(pieces.MARK, " ")) for r in odd.collect())
    joined = pieces.neighbours(model)
    by_text = {r.decoded: r.ids for r in found.collect()}
    for r in odd.filter("length(text) < 10000").collect():
        ids = [i for u in pieces.units(r.text, joined) for i in pieces.fold_long(u, model, pieces.PIECE_COST)]
        assert by_text[r.text.replace(pieces.MARK, " ")] == ids
    assert pieces.encode_texts(none, model).count() == 0


def test_chats(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "assistant", "yes"), (3, 2, "user", "so"),
        (4, 0, "user", "hi"), (4, 1, "assistant", "no"), (5, 0, None, "hi"), (6, 0, "user", None), (7, 0, "user", ""), (None, 0, "user", "lost"),
        (8, 0, "user", "hi"), (8, 0, "user", "hi"), (8, 1, "assistant", "no"), (9, None, "user", "last"), (9, 0, "user", "first"), (9, 0, "bot", "tie"),
    ]
    turns = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, k long, a string")
    found = {r.conv_id: r for r in chat.format_chats(turns).collect()}
    assert sorted(found) == [3, 4, 5, 6, 7, 9] and found[4].n_copies == 2 and found[3].n_turns == 3
    assert found[9].chat == "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in (("bot", "tie"), ("user", "first"), ("user", "last"))) + "<|endoftext|>"
    assert chat.format_chats(turns.limit(0)).count() == 0


def test_pipeline_on_odd_rows(spark, odd, none, tmp_path):
    spark.createDataFrame([(1, "one")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for table in (odd, none):
        docs = table
        for _, stage in corpus_pipeline.STAGES:
            before, docs = docs, stage(spark, docs, str(tmp_path))
        assert docs.count() <= before.count() and "ids" in docs.columns


def test_leaks_beside_columns_of_the_same_names(spark):
    rows = [(1, "a b c", "mine", "w"), (2, "x a b c d", "own", None), (2, None, None, "w"), (None, "z", "k", "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _key string, _words string")
    items = spark.createDataFrame([("i", "A b C")], "item_id string, text string")
    found = decontaminate.find_leaks(df, items)
    assert found.columns == [*df.columns, "_n_words", "_n_hit", "_leaks"]
    assert sorted((r._key or "", r._words or "", r._n_hit) for r in found.collect()) == [("", "w", 0), ("k", "v", 0), ("mine", "w", 3), ("own", "", 3)]
    left = decontaminate.drop_leaks(df, items)
    assert left.columns == df.columns and sorted(str(r._key) for r in left.collect()) == ["None", "k"]
