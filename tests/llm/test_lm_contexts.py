"""The language model against a plain version of itself, and what its contexts reach."""

import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from casetrail.llm import blocks, lm_score, ppm

SPACE = b"\t\n\x0b\x0c\r "


def by_hand(rows):
    """Scores by prediction by partial matching with dictionaries, one symbol after the other."""

    def steps(raw):
        s = [ppm.START, *(x + 1 for x in raw.lower()), ppm.END]
        word = 0
        for i in range(1, len(s)):
            contexts = [("word", tuple(s[i - word : i]))] if word >= ppm.STEM else []
            yield contexts + [(k, tuple(s[i - k : i])) for k in range(min(ppm.ORDER, i), -1, -1)], s[i]
            word = word + 1 if s[i] != ppm.END and s[i] - 1 not in SPACE else 0

    seen = defaultdict(Counter)
    for i, raw in rows:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            for contexts, symbol in steps(raw):
                for c in contexts:
                    seen[c][symbol] += 1
    out = {}
    for i, raw in rows:
        total = 0.0
        for contexts, symbol in steps(raw):
            gone = set()
            for c in contexts:
                left = {x: n for x, n in seen[c].items() if x not in gone}
                if not left:
                    continue
                room = sum(left.values())
                if symbol in left:
                    total += math.log10((left[symbol] - ppm.DISCOUNT) / room)
                    break
                total += math.log10(ppm.DISCOUNT * len(left) / room)
                gone = set(seen[c])
            else:
                total -= math.log10(max(ppm.SYMBOLS - len(gone), 1))
        out[i] = total
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeF") for _ in range(rng.choice([1, 2, 3, 4, 5, 8, 90]))) for _ in range(60)]
    texts = ["".join(rng.choice(words) + rng.choice([" ", " ", " ", "\n", "  "]) for _ in range(rng.randint(0, 40))) for _ in range(60)]
    return [(k, (t if k % 3 else t.strip()).encode()) for k, t in enumerate([*texts, "x\x00", "\x00", " ", "abcdef\x00 abcdef"])]


def test_scores_against_plain_version(spark, rows):
    table = spark.createDataFrame([(i, t.decode()) for i, t in rows], "doc_id long, text string")
    found = {r.doc_id: r.score for r in lm_score.score_texts(table).collect()}
    assert found == pytest.approx(by_hand(rows), rel=1e-9)


def test_words_before_count(spark):
    learn = [i for i in range(1, 400) if zlib.crc32(str(i).encode()) % 5 != 1]
    held = [i for i in range(400, 500) if zlib.crc32(str(i).encode()) % 5 == 1]
    rows = [(i, "the cat sat on a mat") for i in learn] + [(i, "a mat sat on the dog") for i in learn[:20]]
    rows += [(held[0], "the cat sat on a mat"), (held[1], "mat a on sat cat the")]
    found = {r.doc_id: r.score for r in lm_score.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[held[0]] > found[held[1]] + 1


def test_rare_nodes_stay(spark):
    """A short word seen once among millions of symbols is still known, and its letters the other way round are not."""
    learn = [i for i in range(1, 60) if zlib.crc32(str(i).encode()) % 5 != 1]
    held = [i for i in range(60, 100) if zlib.crc32(str(i).encode()) % 5 == 1]
    rows = [(i, "aaaa bbbb " * 10_000) for i in learn] + [(learn[0], "qx"), (held[0], "qx"), (held[1], "xq")]
    found = {r.doc_id: r.score for r in lm_score.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[held[0]] > found[held[1]] + 3


def test_long_words_are_contexts_to_their_end(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("ab") for _ in range(200)) for _ in range(3)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(3)).encode()) for i in range(60)]
    table = spark.createDataFrame([(i, t.decode()) for i, t in rows], "doc_id long, text string")
    assert {r.doc_id: r.score for r in lm_score.score_texts(table).collect()} == pytest.approx(by_hand(rows), rel=1e-9)


def test_texts_together_have_the_units_that_they_have_alone(monkeypatch):
    texts = [None, b"", b" ", b"\x00", b"a\x00", b"\x00 \x00", b" A  b\t\n c", b"x ", b"x", b"\x0b\x0cY\xff\xc3\xa9 \r", b"long " * 50 + b"end", b""]
    for chunk in (1, 40, 1 << 20):
        monkeypatch.setattr(ppm, "CHUNK_BYTES", chunk)
        got = [[] for _ in texts]
        for first, found, document in ppm.units_of(pa.array(texts, pa.binary())):
            for unit, k in zip(found.to_pylist(), document.tolist(), strict=True):
                got[first + k].append(unit)
        assert got == [ppm.units(t) for t in texts]


def test_no_unit_is_looked_up_by_itself(spark, rows, monkeypatch):
    """Units are cut and looked up many at a time; one by one they took most of the time."""
    monkeypatch.setattr(ppm, "units", None)
    assert not hasattr(lm_score, "units")
    assert lm_score.vocabulary(spark.createDataFrame(rows, "doc_id long, text binary"), "doc_id", "text").count() > 60


def test_memory_of_laid_out_texts():
    """Many workers hold such arrays at a time, so what a byte of text takes is bounded."""
    rng = np.random.default_rng(5)
    texts = pa.array([bytes(rng.integers(97, 123, 2_000, dtype=np.uint8)) for _ in range(2_000)])
    tracemalloc.start()
    for _, laid in ppm.laid_out(texts):
        laid.keys(laid.at)
        laid.shallow()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 60e6, most


def test_a_block_is_unpacked_a_few_pieces_at_a_time(monkeypatch):
    rng = random.Random(9)
    texts = [None, b"", *[bytes(rng.choices(b"abc de\nF", k=rng.randint(0, 4_000))) for _ in range(3_000)]]
    table = pa.table({"id": pa.array(range(len(texts)), pa.int64()), "raw": pa.array(texts, pa.binary())})
    blobs = pa.chunked_array([pa.array([blocks.packed(table.slice(a, 37)) for a in range(0, len(texts), 37)], pa.binary())])
    monkeypatch.setattr(lm_score, "CHUNK_BYTES", 1 << 16)
    monkeypatch.setattr(ppm, "CHUNK_BYTES", 1 << 16)
    whole = table["raw"].nbytes

    for of in (ppm.units_of, lm_score._keys_of):
        at_rest, most, got = pa.total_allocated_bytes(), 0, []
        for first, found, document in lm_score._found_in(blobs, of):
            most = max(most, pa.total_allocated_bytes() - at_rest)
            got += zip((document + first).tolist(), found.to_pylist())
        assert got == [(first + d, x) for first, found, document in of(table["raw"]) for d, x in zip(document.tolist(), found.to_pylist())]
        # Texts that are looked at, and their copy in one piece.
        assert most < 3 * lm_score.LOOKED_UP * lm_score.CHUNK_BYTES < whole / 4


def test_memory_is_given_back():
    pool = pa.default_memory_pool()
    released = []

    class Watched:
        def release_unused(self):
            released.append(True)
            pool.release_unused()

    keys = pa.array(range(1_000), pa.int64())
    with pytest.MonkeyPatch.context() as patched:
        patched.setattr(blocks.pa, "default_memory_pool", Watched)
        found = [(0, keys, np.zeros(len(keys), dtype=np.int32))] * (2 * lm_score.LOOKED_UP + 1)
        assert [at.tolist() for at, _ in lm_score._looked_up(iter(found), keys)] == [list(range(1_000))] * len(found)
    assert len(released) == 3


def test_units_are_looked_up_by_dictionary():
    """What is known is made ready once for many pieces, and a unit is asked for once in each."""
    rng = random.Random(3)
    texts = pa.array([None, *[" ".join(rng.choices(["a", "bb", "ccc", "dd"], k=500)).encode() for _ in range(40)]], pa.binary())
    known = pa.array([b"dd ", b"bb ", b"a ", b"ccc\x00", b"ccc ", b"dd\x00", b"a\x00", b"bb\x00", b"other"])
    got = [[] for _ in texts]
    for _, x, _ in lm_score._encoded(ppm.units_of(texts)):
        assert len(x.dictionary) <= 8
    for at, document in lm_score._looked_up(lm_score._encoded(ppm.units_of(texts)), known, 2):
        for k, d in zip(at.tolist(), document.tolist(), strict=True):
            got[d].append(known[k].as_py())
    assert got == [ppm.units(t.as_py()) for t in texts]


def test_keys_are_packed_as_their_symbols_stand():
    texts = [None, b"", b"\x00", b"Ab c", b"\xff" * 7, b"", b"abcdefgh"]
    for _, laid in ppm.laid_out(pa.array(texts, pa.binary())):
        wanted = []
        for t in texts:
            symbols = [0] * ppm.ORDER + [ppm.START, *(x + 1 for x in (t or b"").lower()), ppm.END]
            wanted += [sum(x << ppm.BITS * k for k, x in enumerate(symbols[i - ppm.ORDER : i + 1][::-1])) for i in range(ppm.ORDER + 1, len(symbols))]
        assert laid.keys(laid.at).tolist() == wanted
