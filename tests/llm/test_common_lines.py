"""Line dedup against a plain version, also on odd input."""

import random
from collections import defaultdict

import numpy as np
import pytest

from casetrail.llm import common_lines
from casetrail.llm.perfect_hash import MinimalPerfectHash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least_chars, least_documents):
    """(id, lines, dropped, text) of every row, row by row."""
    key = [[x.strip(" \t\n\x0b\x0c\r").translate(LOWER) for x in (t or "").split("\n")] for _, t in rows]
    having = defaultdict(set)
    for k, keys in enumerate(key):
        for x in keys:
            if len(x) >= least_chars:
                having[x].add(k)
    out = []
    for (id, text), keys in zip(rows, key):
        lines = (text or "").split("\n")
        stays = []
        for line, x in zip(lines, keys):
            ids = [rows[k][0] for k in having.get(x, ())]
            best = max((i for i in ids if i is not None), default=None)
            if len(ids) < least_documents or id == best:
                stays.append(line)
        out.append((id, len(lines), len(lines) - len(stays), "\n".join(stays)))
    return sorted(out, key=str)


def found(df, **options):
    rows = common_lines.drop_common_lines(df, **options).collect()
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in rows), key=str)


def test_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for chars, documents in ((40, 5), (1, 2), (3, 3)):
        assert found(odd, least_chars=chars, least_documents=documents) == plain(rows, chars, documents)
    assert found(none) == []


@pytest.mark.parametrize("seed", range(3))
def test_random_rows_over_small_blocks_and_shards(spark, seed, monkeypatch):
    rng = random.Random(seed)
    shared = ["É" * 40, "é" * 39, "  padded \t" + "Line " * 9 + "\r", "line " * 9, "x" * 39, "y" * 40, "", " "]
    rows = []
    for k in range(200):
        lines = [rng.choice(shared) if rng.random() < 0.5 else f"{rng.randrange(60)} own line that is long enough to count here" for _ in range(rng.randrange(6))]
        rows.append((rng.choice([None, k, k, k, 7]), rng.choice([None, "\n".join(lines), "\n".join(lines) + "\n"])))
    monkeypatch.setattr(common_lines, "BLOCK_BYTES", 500)
    monkeypatch.setattr(common_lines, "SHARD_KEYS", 20)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(df) == plain(rows, 40, 5)


def test_other_names_and_clashes(spark):
    rows = [(k, "a line that is in all of these documents, surely\nown " + str(k), k, "b", "h") for k in range(6)]
    df = spark.createDataFrame(rows, "key long, block string, n long, hash string, raw string")
    kept = common_lines.drop_common_lines(df, "key", "block").collect()
    assert {r.key: r.n_dropped for r in kept} == {0: 1, 1: 1, 2: 1, 3: 1, 4: 1, 5: 0}


def test_perfect_hash_from_its_bits():
    digests = np.random.default_rng(1).integers(0, 256, (1000, 16), dtype=np.uint8)
    made = MinimalPerfectHash(digests)
    again = MinimalPerfectHash.of_bits(made.bits())
    assert sorted(again.slots(digests)) == list(range(1000)) and (again.slots(digests) == made.slots(digests)).all()
    assert MinimalPerfectHash.of_bits(MinimalPerfectHash(digests[:0]).bits()).size == 0
