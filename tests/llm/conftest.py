import random

import pytest

from tests.conftest import spark  # noqa: F401

CLASHES = "id string, key long, block string, n long, h string, word string, digest long, component string, element long, unit string, c long"


@pytest.fixture(scope="session")
def odd(spark):  # noqa: F811
    """Nulls in every column, empty and very long texts, ties, repeated rows, and names that operators use inside."""
    rng = random.Random(3)
    vocabulary = [a + b for a in "ka lo mi nu re".split() for b in "ba de fi go hu ja".split()]
    long_text = " ".join(rng.choice(vocabulary) for _ in range(30_000))
    passage = " ".join(rng.choice(vocabulary) for _ in range(40))
    other = " ".join(rng.choice(vocabulary) for _ in range(60))
    texts = [
        (1, passage + " " + other), (2, "x " + passage), (2, "x " + passage), (None, "x " + passage), (None, None), (3, None), (4, ""),
        (5, " \t\n "), (6, "one"), (7, "one"), (8, "ONE"), (9, long_text), (10, long_text + " end"), (11, other), (12, other), (None, other),
        (13, "É ñ 　 \x00 ▁x <0x0A> " + "y" * 5_000), (14, "!!! ... ???"), (15, "1 2 3 4 5 6 7 8 9 10 11 12"), (2, "another text for the id"),
    ]
    extra = [(f"i{k}", k, None, k, "h", "w", k, "c", k, "u", k) if k % 3 else (None,) * 11 for k in range(len(texts))]
    rows = [(d, t, ["en", "fr", None, ""][k % 4], ["s.org", None][k % 2], None if k % 5 == 0 else len(t or ""), *extra[k]) for k, (d, t) in enumerate(texts)]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
