"""Extension queries and runs against plain scans."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from casetrail.llm import queries, runs
from casetrail.llm.recompression import Grammar
from tests.conftest import SMALL


def plain_runs(words, least=6, periods=4):
    """(start, length, period) by scanning all periods."""
    found = {}
    for q in range(1, len(words) // periods + 1):
        begin = None
        for i in range(len(words) - q + 1):
            if i < len(words) - q and words[i] == words[i + q]:
                begin = i if begin is None else begin
            elif begin is not None:
                length = i - begin + q
                if length >= max(least, periods * q):
                    found.setdefault((begin, length), q)
                begin = None
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_text(words, found):
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    return b" ".join(w for k, w in enumerate(words) if k not in gone)


def sequence(rng):
    out = []
    while len(out) < rng.randrange(200):
        kind = rng.randrange(4)
        unit = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(1, 9))]
        out += unit * (rng.randrange(1, 9) if kind else 1)
        out = out[: -rng.randrange(1, 4)] if kind == 2 and len(out) > 4 else out
    return out


@pytest.mark.parametrize("seed", range(20))
def test_extension(seed):
    rng = random.Random(seed)
    parts = [sequence(rng) for _ in range(4)]
    whole = [1000]
    for k, p in enumerate(parts):
        whole += [*p, 1001 + k]
    grammar = Grammar(np.array(whole))
    inner = [k for k, s in enumerate(whole) if s < 1000]
    pairs = [tuple(rng.sample(inner, 2)) for _ in range(500)] if len(inner) > 1 else []
    x, y = (np.array([p[k] for p in pairs], dtype=np.int64) for k in (0, 1))
    for step in (1, -1):
        want = []
        for a, b in pairs:
            n = 0
            while whole[a + n * step] == whole[b + n * step]:
                n += 1
            want.append(n)
        assert grammar.extension(x, y, step).tolist() == want


@pytest.mark.parametrize("seed", range(30))
def test_runs(seed, monkeypatch):
    rng = random.Random(seed)
    if seed % 2:
        monkeypatch.setattr(runs, "AT_ONCE", 7)
    parts = [sequence(rng) for _ in range(8)] + [[], [1] * 5, [1] * 6, [1, 2] * 4, [1, 2] * 3 + [1], [3] * 400]
    least, periods = rng.choice([(6, 4), (1, 2), (9, 3)])
    found = runs.runs_of([np.array(p, dtype=np.int64) for p in parts], least, periods)
    want = [(k, *r) for k, p in enumerate(parts) for r in plain_runs(p, least, periods)]
    assert list(zip(*(c.tolist() for c in found))) == want


def test_nothing_to_find():
    assert [len(c) for c in runs.runs_of([])] == [0] * 4 and [len(c) for c in runs.runs_of([np.arange(50)])] == [0] * 4


def test_odd_rows(odd, none, monkeypatch):
    monkeypatch.setattr(runs, "PIECE_BYTES", 300)
    more = odd.selectExpr("doc_id", "repeat('a B ', 30) || text AS text").unionAll(odd.select("doc_id", "text")).repartition(2)
    short = more.filter("text IS NULL OR length(text) < 3000")
    found = sorted((str(r.doc_id), r.n_words, r.collapsed_text, [tuple(x) for x in r.runs]) for r in runs.find_runs(short).collect())
    want = []
    for r in short.collect():
        words = (r.text or "").encode().split()
        of = plain_runs(words)
        want.append((str(r.doc_id), len(words), plain_text(words, of).decode(), of))
    assert found == sorted(want)
    assert runs.find_runs(more).count() == more.count() and runs.find_runs(none).collect() == []
    assert runs.find_runs(odd.withColumnRenamed("doc_id", "raw"), "raw").count() == odd.count()


def test_every_document(spark):
    found = {r.doc_id: r for r in queries.QUERIES["op11_periodic_runs"](spark, SMALL).collect()}
    documents = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(found) == len(documents)
    changed = 0
    for d in documents:
        words = (d.text or "").encode().split()
        n, h = len(words), zlib.crc32(str(d.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            changed += 1
        if n > 1_500:
            continue
        of, r = plain_runs(words), found[d.doc_id]
        best = min(of, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        assert r.n_runs == len(of)
        assert (r.start, r.length, r.period, r.exponent_milli) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in of).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(plain_text(words, of)).hexdigest()
    assert changed
