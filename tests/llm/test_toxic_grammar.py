"""Each match of a clause by its own negation, report and target."""

import pytest

from casetrail.llm import toxicity

LEXICON = {"idiot": 2.0, "moron": 3.0}


@pytest.mark.parametrize(("text", "wanted"), [
    ("i would never hurt you", [(2, 0.3)]),
    ("i will hurt you", [(5, 1.0)]),
    ("not an idiot but you are a moron", [(2, 0.6), (1, 3.0)]),
    ('"nice" day, you idiot', [(1, 2.0)]),
    ('she said "you idiot" and you are a moron', [(3, 2.0), (1, 3.0)]),
    ("she said you are an idiot", [(3, 2.0)]),
    ("an idiot said so", [(0, 2.0)]),
    ("a moron, and an idiot like you", [(0, 3.0), (1, 2.0)]),
    ("you say nothing", []),
])
def test_matches(text, wanted):
    (words,) = toxicity.clauses(text)
    found = toxicity.matches(words, LEXICON, {})
    assert [k for k, _ in found] == [k for k, _ in wanted] and [w for _, w in found] == pytest.approx([w for _, w in wanted])
