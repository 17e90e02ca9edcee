"""The lattice against all paths, and texts worked on together against texts one by one."""

import tracemalloc

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from casetrail.llm import pieces

SCORES = {"a": -3.0, "b": -1.0, "ab": -2.0, "ba": -2.0, "aba": -5.0, "bb": -7.0, "▁": -1.5, "▁a": -4.0}
MODEL = pieces.Model(
    {p: (300 + i, s) for i, (p, s) in enumerate(SCORES.items())},
    list(range(256)),
    [bytes([b]) for b in range(256)] + [b""] * 44 + [p.replace("▁", " ").encode() for p in SCORES],
)


def all_paths(unit: str) -> list[tuple[float, list[int]]]:
    """Every way to spell a unit, with its cost for a piece cost of 10."""
    if not unit:
        return [(0.0, [])]
    found = []
    for size in range(1, len(unit) + 1):
        head = unit[:size]
        if head in SCORES:
            step = (10 - SCORES[head], [300 + list(SCORES).index(head)])
        elif size == 1:
            step = (1e8, list(head.encode()))
        else:
            continue
        found += [(step[0] + cost, step[1] + ids) for cost, ids in all_paths(unit[size:])]
    return found


def test_lattice_is_the_best_of_all_paths(spark):
    words = ["a", "b", "▁", "abab", "bbbb", "▁aba", "ababab", "bbabba", "é", "aéb", "▁😀a", "日", "abbaabba", "x" * 9]
    found = spark.createDataFrame([(w,) for w in words], "unit string")
    got = {r.unit: np.frombuffer(r.code, dtype=">i4").tolist() for r in pieces.encode_units(found, MODEL, 10.0).collect()}
    assert got == {w: min(all_paths(w))[1] for w in words}


def test_equal_costs_go_to_the_ids_that_come_first(spark):
    model = pieces.Model({"a": (5, -1.0), "aa": (900, -1.0)}, list(range(256)), [])
    row = pieces.encode_units(spark.createDataFrame([("aaa",)], "unit string"), model, 1.0).first()
    assert np.frombuffer(row.code, dtype=">i4").tolist() == [5, 900]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab ▁é日😀\x00\n", max_size=12)), max_size=6))
def test_texts_together_are_cut_as_one_by_one(texts):
    joined = pieces.neighbours(MODEL)
    raw = pa.chunked_array([pa.array([None if t is None else t.encode() for t in texts], pa.binary())])
    found, ends = pieces.units_of(raw, joined)
    assert [found.to_pylist()[a:b] for a, b in zip(ends, ends[1:])] == [pieces.units(t, joined) for t in texts]


def test_ids_together_are_decoded_as_one_by_one():
    texts = [[306, 300, 301], [], [306, 0xC3, 0xA9], [306, 0xC3], None]
    ids = np.array([i for t in texts for i in t or []], dtype=np.int32)
    ends = np.concatenate([[0], np.cumsum([len(t or []) for t in texts])])
    none = pa.array([t is None for t in texts])
    got = pieces.decoded(ends, ids, MODEL.spelled, none).to_pylist()
    assert got == [None if t is None else pieces.decode(t, MODEL.spelled) for t in texts] == ["ab", "", "é", "�", None]


def test_a_block_is_never_held_as_units_at_once(spark, monkeypatch):
    """Texts are looked up some at a time, longer units among them, and come back the same."""
    raw = [None, b"", b"a b", b"b" * 30, b"aba " * 20, b"x" * 300, "日 é".encode(), b"ab"]
    tables = [pa.table({"raw": pa.array([t], pa.binary())}) for t in raw]
    monkeypatch.setattr(pieces, "_LOOKED_UP", 64)
    groups = list(pieces._together(iter(tables)))
    assert [t for g in groups for t in g] == tables and len(groups) > 2
    assert all(sum(t["raw"].nbytes for t in g[:-1]) < 64 for g in groups)


def test_texts_of_several_lookups_and_no_sort_of_what_is_asked(spark):
    texts = [None, "", "a b", "b" * 300, "aba " * 20, "x" * 300, "日 é", "ab", *["ab " * k for k in range(40)]]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    encoded = pieces.encode_texts(table, MODEL)
    assert {r.doc_id: r.decoded for r in encoded.collect()} == dict(enumerate(texts))
    assert "SortMergeJoin" not in encoded._jdf.queryExecution().executedPlan().toString()


def test_ids_are_read_where_they_stand():
    """No object for each unit: a block has hundreds of thousands of them."""
    lists = [[k, k + 1, 1 << 20] for k in range(100_000)] + [[], [5]]
    codes = pa.array([b"".join(i.to_bytes(4, "big") for i in x) for x in lists], pa.binary())
    tracemalloc.start()
    found = pieces._ids_of(codes)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.to_pylist() == lists and most < 4_500_000, most
    assert pieces._ids_of(codes.slice(99_998, 3)).to_pylist() == lists[99_998:100_001]
    assert pieces._ids_of(codes.slice(100_000, 1)).to_pylist() == [[]] and pieces._ids_of(pa.array([], pa.binary())).to_pylist() == []
