"""Alignment against plain byte spans, on every document and on odd input."""

import hashlib
import json
import random
from collections import Counter

import numpy as np
import pytest

from casetrail.llm import alignment, queries
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def pair():
    return alignment.Pair.read(*queries.tokenizer_files())


def spans(pair, text):
    """(id, begin, end) of A's and of B's tokens, or two empty lists."""
    if not text:
        return [], []
    out = []
    for ids, table in ((pair.a.encode(" " + text, add_special_tokens=False).ids, pair.a_bytes), (pair.b.encode(text), pair.b_bytes)):
        spelled = [table[i].as_py() for i in ids]
        if b"".join(spelled) != (" " + text).encode():
            return [], []
        at = np.cumsum([0, *map(len, spelled)]).tolist()
        out.append(list(zip(ids, at, at[1:])))
    return tuple(out)


def plain(pair, rows):
    links, groups = [], []
    for _, text in rows:
        a, b = spans(pair, text)
        found, j = [], 0
        for i, begin, end in a:
            while j < len(b) and b[j][2] <= begin:
                j += 1
            k = j
            while k < len(b) and b[k][1] < end:
                found.append((i, b[k][0]))
                k += 1
        links.append(found)
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        parts = [(x, y) for x, y in zip([0, *cuts], cuts)]
        inside = lambda tokens, x, y: ",".join(str(i) for i, s, e in tokens if x <= s and e <= y)
        # Only short texts are sliced this way: it is quadratic.
        groups.append((len(a), len(b), len(parts), ";".join(f"{inside(a, x, y)}|{inside(b, x, y)}" for x, y in parts) if len(a) < 2_000 else None))
    total = Counter(x for found in links for x in found)
    most = Counter()
    for (_, j), n in total.items():
        most[j] = max(most[j], n)
    out = []
    for (id, _), found, (n_a, n_b, n_groups, whole) in zip(rows, links, groups):
        out.append((id, n_a, n_b, n_groups, len(found), sum(total[x] == most[x[1]] for x in found), sum(total[x] for x in found), whole))
    return out


def held(got, want):
    """The rows agree, the digest wherever the plain version has the groups."""
    order = lambda rows: sorted(rows, key=lambda r: str(r[:7]) + str(r[7]))
    want = [(*w[:7], None if w[7] is None else hashlib.sha256(w[7].encode()).hexdigest() if w[1] else "") for w in want]
    for g, w in zip(order(got), order(want), strict=True):
        assert g[:7] == w[:7] and (w[7] is None or g[7] == w[7])


def scored(df):
    return [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()]


def test_every_document(spark, pair):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    held(scored(queries.QUERIES["op12_tokenizer_alignment"](spark, SMALL)), plain(pair, rows))


def test_odd_rows_over_small_blocks(spark, pair, odd, none, monkeypatch):
    more = [(90, "<|endoftext|> <s></s> <unk> <0x41>"), (91, "▁"), (92, " a  b\n\n\tc"), (93, "日本語のテキスト😀😀 नमस्ते"), (94, "▁x y"), (95, "é ﬁ")]
    rows = [(r.doc_id, r.text) for r in odd.collect()] + more
    df = odd.select("doc_id", "text").unionAll(spark.createDataFrame(more, "doc_id long, text string")).repartition(3)
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 3_000)
    monkeypatch.setattr(alignment, "PIECE_BYTES", 700)
    held(scored(alignment.score_links(df, pair)), plain(pair, rows))
    assert alignment.score_links(none, pair).collect() == []
    assert alignment.align_texts(none, pair).collect() == []
    clashing = odd.withColumnRenamed("doc_id", "number").withColumnRenamed("text", "block_text")
    assert alignment.score_links(clashing, pair, "number", "block_text").count() == odd.count()


def test_groups_as_text(spark, pair):
    df = spark.createDataFrame([(1, "hello worlds"), (2, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in alignment.align_texts(df, pair).collect()}
    (_, _, _, whole), _ = [(w[1], w[2], w[3], w[7]) for w in plain(pair, [(1, "hello worlds"), (2, None)])]
    assert found[1].groups == whole and (found[2].n_a, found[2].groups) == (0, "")


def test_quick_encoder_is_the_same(pair):
    rng = random.Random(1)
    alphabet = [*" \n\t\r'", *"abcXYZ019", *"!?.-_", *"éßÇñ中文日本한글नमस्", *"\u0085\u00a0\u180e\u200b\u2028\u3000\ufeff", "😀", "'s", "'LL", "<|endoftext|>", "\x00", "\U0001e900"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 60))) for _ in range(3_000)]
    texts += [" " * 300_000 + "x", "\n" * 4_999 + "y", "z" * 100_000]
    assert pair.quick is not None
    own = pair.a.encode_batch([" " + t for t in texts], add_special_tokens=False)
    assert [x.tolist() for x in pair.a_ids(texts)] == [x.ids for x in own]


def test_other_merges_have_no_quick_encoder(pair):
    file = json.loads(pair.a_file)
    file["model"]["merges"] = file["model"]["merges"][1:]
    other = alignment.Pair(json.dumps(file), pair.b_file)
    assert other.quick is None and len(other.a_ids(["some words", ""])) == 2


@pytest.mark.parametrize("seed", range(5))
def test_gallop_is_a_search(seed):
    rng = np.random.default_rng(seed)
    wanted, rank, low, last, ends = [], [], [], [], []
    for _ in range(30):
        total = int(rng.integers(1, 400))
        a = sorted({total, *rng.integers(1, total + 1, rng.integers(1, 60)).tolist()})
        b = sorted({total, *rng.integers(1, total + 1, rng.integers(1, 300)).tolist()})
        low += [len(ends)] * len(a)
        last += [len(ends) + len(b) - 1] * len(a)
        base = ends[-1] if ends else 0
        wanted, rank, ends = wanted + [base + x for x in a], rank + list(range(len(a))), ends + [base + x for x in b]
    found = alignment.gallop(*map(np.array, (wanted, rank, low, last, ends)))
    assert found.tolist() == np.searchsorted(ends, wanted).tolist()
