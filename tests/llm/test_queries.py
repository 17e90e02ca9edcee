"""The registered queries against their SQL or a brute-force version, on the smallest driver tables."""

import hashlib
import math
import zlib
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as spark_entry
import corpus_pipeline
from casetrail.llm import language, pieces, queries
from tests.conftest import SMALL
from tools.check import TABLES, rows_of

from .test_edges import shingles


@pytest.fixture(scope="module")
def checker():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    yield con
    con.close()


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").collect()


def test_all_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(spark_entry.queries())
    assert [f"op{n}" for n in range(1, 14)] == sorted((q.split("_")[0] for q in queries.QUERIES if q.startswith("op")), key=lambda x: int(x[2:]))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, checker, name):
    df = queries.QUERIES[name](spark, SMALL)
    answer = checker.execute(queries.ORACLES[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, answer.fetchall())


def test_lm_base(spark, documents):
    tokens = {r.doc_id: (r.text or "").encode().lower().split() + [None] for r in documents}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tokens}
    counts = Counter(t for i, w in tokens.items() if not held[i] for t in w)
    n, v = sum(counts.values()), len(counts)
    found = {r.doc_id: r for r in queries.QUERIES["op3_lm_scoring"](spark, SMALL).collect()}
    assert set(found) == set(tokens)
    for i, w in tokens.items():
        r = found[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(w), sum(counts[t] > 0 for t in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in w))
        assert r.score < 0


def auc(pairs):
    good, bad = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad))


@pytest.mark.parametrize(("name", "label"), [("op2_toxicity", "toxic"), ("op7_quality_classifier", "quality")])
def test_classifiers_on_held_out_rows(spark, name, label):
    # Few rows are labelled as toxic, so these need the larger tables.
    folder = SMALL.replace("sf0.001", "sf0.1" if label == "toxic" else "sf0.01")
    scored = queries.QUERIES[name](spark, folder)
    known = spark.read.parquet(f"{folder}/labels.parquet")
    pairs = [(r.score, r[label]) for r in scored.filter("held_out").join(known, "doc_id").collect()]
    assert auc(pairs) > 0.9


def test_languages_against_declared(spark, documents):
    found = {r.doc_id: r for r in queries.QUERIES["op1_language_id"](spark, SMALL).collect()}
    right = [found[r.doc_id].language == r.lang for r in documents]
    assert len(found) == len(documents) and sum(right) >= 0.97 * len(right)
    assert all(found[r.doc_id].accepted for r in documents if any(c.isalpha() for c in r.text or ""))


def test_wrong_declaration_is_outweighed(spark, documents):
    rows = [(r.doc_id, r.text, "fr" if r.doc_id % 20 == 0 else r.lang, r.lang) for r in documents if r.n_chars > 300]
    found = language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string, truth string"), carried=["truth"]).collect()
    assert sum(r.language == r.truth for r in found) >= 0.97 * len(found)


def test_pages_by_all_evidence(spark):
    found = queries.QUERIES["page_languages"](spark, SMALL).collect()
    assert found and sum(r.accepted for r in found) >= 0.9 * len(found)


def test_pieces_come_back(spark, documents):
    found = {r.doc_id: r.decoded_sha256 for r in queries.QUERIES["op10_sentencepiece"](spark, SMALL).collect()}
    assert found == {r.doc_id: hashlib.sha256((r.text or "").replace(pieces.MARK, " ").encode()).hexdigest() for r in documents if r.text is not None} | {
        r.doc_id: None for r in documents if r.text is None
    }


def test_pipeline_by_brute_force(spark, documents, checker):
    kept = {r.doc_id: r.text or "" for r in documents if any(c.isalpha() for c in r.text or "")}
    last = {}
    for i, t in sorted(kept.items()):
        last[t] = i
    kept = {i: t for t, i in last.items()}
    sets = {i: shingles(t, 5) for i, t in kept.items()}
    group = {i: i for i in kept}
    order = sorted(kept)
    for k, i in enumerate(order):
        for j in order[:k]:
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and group[i] != group[j]:
                a, b = group[i], group[j]
                group = {x: min(a, b) if g in (a, b) else g for x, g in group.items()}
    kept = {i: t for i, t in kept.items() if group[i] == i}
    leaks = {r[0] for r in checker.execute(f"SELECT doc_id FROM ({queries.ORACLES['op9_benchmark_decontamination']}) WHERE contaminated").fetchall()}
    wanted = {i: t for i, t in kept.items() if i not in leaks}
    model = pieces.load_model(pieces.default_model())
    joined = pieces.neighbours(model)
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert set(found) == set(wanted)
    for i, t in wanted.items():
        ids = [x for u in pieces.units(t, joined) for x in pieces.fold_long(u, model, pieces.PIECE_COST)]
        assert found[i].ids == ids and found[i].n_pieces == len(ids)
