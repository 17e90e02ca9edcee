"""Toxicity: a weighted finite-state grammar over clauses.

Five weighted transducers are composed over a clause's words, each reading what the one before it wrote:

    insult      word -> INSULT, weighted by a lexicon that is learned from labelled rows
    threat      word -> THREAT (a fixed list of verbs)
    target      marks a match as AIMED if a second person or a group of people stands before it in the clause, or
                behind it before the next match
    negation    marks a match as NEGATED within ``REACH`` words behind a negating one, and takes weight from it
    reported    marks a match as REPORTED behind a verb of saying, up to the end of the quotation that follows or else of
                the clause, and between quotation marks

The first two have one state, and their output is remembered by word; the others are transition tables. Each match
falls into a class by its own marks and adds its weight there. A document's score is a logistic function of the classes'
sums, fitted on the labelled sample: matches in their clauses count, not isolated words.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casetrail.llm.labelled import held_out, training_sample

#: Labelled rows to learn from, at most; they also bound the learned lexicon.
SAMPLE_ROWS = 12_000
#: An entry needs so many toxic documents, so many different words before it, and so much more evidence (log-odds).
LEAST_DOCUMENTS, LEAST_CONTEXTS, LEAST_ODDS = 5, 4, 2.5
#: Lengths of word beginnings that can be entries, so that inflected insults share one.
BEGINNINGS = (4, 5, 6)
REACH = 3
#: What a negated match keeps of its weight.
NEGATED_SHARE = 0.3
THRESHOLD = 0.5

THREAT = frozenset("kill hurt destroy beat shoot burn murder töten umbringen schlagen tuer frapper matar golpear".split())
TARGET = frozenset(
    "you your yours yourself u they them their he she his her du dich dein ihr euch sie tu toi ton vous votre ils elles "
    "tú usted ustedes vosotros ellos ellas".split()
)
NEGATION = frozenset("not no never neither nor without isn't aren't don't nicht kein keine nie niemals ne pas jamais sin nunca ni".split())
SAYING = frozenset(
    "said says say quoted called claimed wrote reported allegedly sagte sagt schrieb angeblich dit disait écrit dijo dice escribió".split()
)

CLAUSE = re.compile(r"[.!?;:\n]+")
WORD = re.compile(r"\w+(?:'\w+)?|[\"“”«»„]")
QUOTES = frozenset('"“”«»„')

#: Classes of a match: plain, aimed, negated, reported, threatening, aimed threat; then the share of the clauses with a
#: match and the largest weight of one.
CLASSES = 8

#: What a word is, as bits: several may hold.
INSULT, THREATENS, TARGETS, NEGATES, SAYS, QUOTES_ = 1, 2, 4, 8, 16, 32
MATCH = INSULT | THREATENS
#: What a machine writes on a match.
AIMED, NEGATED, REPORTED = 64, 128, 256


@dataclass(frozen=True)
class Machine:
    """A sequential transducer: by state and the first of ``reads`` that a word is (else 0), the next state, the mark
    written on a match, and the factor of its weight. ``backwards`` reads from the clause's end."""

    reads: tuple[int, ...]
    moves: dict[tuple[int, int], tuple[int, int, float]]
    backwards: bool = False

    def run(self, tape: list[list]) -> None:
        state = 0
        for cell in reversed(tape) if self.backwards else tape:
            symbol = next((x for x in self.reads if cell[0] & x), 0)
            state, mark, factor = self.moves[state, symbol]
            if cell[0] & MATCH:
                cell[0] |= mark
                cell[1] *= factor


def _target_before() -> Machine:
    return Machine((TARGETS,), {(0, 0): (0, 0, 1.0), (0, TARGETS): (1, AIMED, 1.0), (1, 0): (1, AIMED, 1.0), (1, TARGETS): (1, AIMED, 1.0)})


def _target_behind() -> Machine:
    # A word that is target and match at once is read as the target, and so aims at the match before it too.
    moves = {(s, TARGETS): (1, AIMED, 1.0) for s in (0, 1)}
    moves |= {(s, MATCH): (0, AIMED if s else 0, 1.0) for s in (0, 1)} | {(s, 0): (s, 0, 1.0) for s in (0, 1)}
    return Machine((TARGETS, MATCH), moves, backwards=True)


def _negation() -> Machine:
    # The state is how many words the negation still reaches. What is a match doesn't negate.
    moves = {}
    for left in range(REACH + 1):
        written = (max(left - 1, 0), NEGATED if left else 0, NEGATED_SHARE if left else 1.0)
        moves |= {(left, 0): written, (left, MATCH): written, (left, NEGATES): (REACH, 0, 1.0)}
    return Machine((MATCH, NEGATES), moves)


def _reported() -> Machine:
    # 0: own words; 1: behind a verb of saying; 2: within quotation marks.
    moves = {}
    for state, quoted in ((0, 2), (1, 2), (2, 0)):
        mark = REPORTED if state else 0
        moves |= {(state, 0): (state, mark, 1.0), (state, QUOTES_): (quoted, 0, 1.0), (state, SAYS): (state or 1, mark, 1.0)}
    return Machine((QUOTES_, SAYS), moves)


CASCADE = (_target_before(), _target_behind(), _negation(), _reported())


def clauses(text: str | None) -> Iterator[list[str]]:
    for part in CLAUSE.split(text.lower()) if text else ():
        found = WORD.findall(part)
        if found:
            yield found


def entries(word: str) -> list[str]:
    """What the lexicon may hold for a word: the word itself and its beginnings, marked by a star."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


def read(word: str, lexicon: dict[str, float]) -> tuple[int, float]:
    """What the insult and the threat transducer, and the word lists, make of a word: its bits and its weight."""
    insult = max((lexicon.get(e, 0.0) for e in entries(word)), default=0.0)
    bits = INSULT if insult > 0 else THREATENS if word in THREAT else 0
    for bit, words in ((TARGETS, TARGET), (NEGATES, NEGATION), (SAYS, SAYING), (QUOTES_, QUOTES)):
        bits |= bit if word in words else 0
    return bits, insult if insult > 0 else 1.0


def matches(words: list[str], lexicon: dict[str, float], known: dict[str, tuple[int, float]]) -> list[tuple[int, float]]:
    """The class and weight of each match of a clause. ``known`` remembers what words are."""
    tape, any_match = [], 0
    for word in words:
        cell = known.get(word)
        if cell is None:
            cell = known[word] = read(word, lexicon)
        any_match |= cell[0]
        tape.append(cell)
    if not any_match & MATCH:
        return []
    tape = [list(cell) for cell in tape]
    for machine in CASCADE:
        machine.run(tape)
    return [(_class(bits), weight) for bits, weight in tape if bits & MATCH]


def _class(bits: int) -> int:
    if bits & REPORTED:
        return 3
    if bits & NEGATED:
        return 2
    return (4 if bits & THREATENS else 0) + (1 if bits & AIMED else 0)


def features(text: str | None, lexicon: dict[str, float], known: dict[str, tuple[int, float]]) -> tuple[np.ndarray, int]:
    """Sums of matches by class, damped by a logarithm, then the share of clauses with a match and the largest weight of
    one; and how many clauses had a match."""
    out, total, matched, most = np.zeros(CLASSES), 0, 0, 0.0
    for words in clauses(text):
        total += 1
        found = matches(words, lexicon, known)
        if found:
            matched += 1
            for kind, weight in found:
                out[kind] += weight
            most = max(most, sum(weight for _, weight in found))
    out[:6] = np.log1p(out[:6])
    out[6], out[7] = (matched / total if total else 0.0), most / 10
    return out, matched


@dataclass
class Grammar:
    lexicon: dict[str, float]
    bias: float
    weights: np.ndarray

    def score(self, text: str | None, known: dict[str, tuple[int, float]]) -> tuple[float, int]:
        """The score and the number of matched clauses."""
        found, matched = features(text, self.lexicon, known)
        raw = self.bias + float(self.weights @ found)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, raw)))), matched


def _candidates(sample: DataFrame) -> DataFrame:
    """Lexicon entries with their documents of either label, weighed against chance."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist()):
                words = {w for found in clauses(text) for w in found}
                counts[label].update({e for w in words for e in entries(w)})
        for label in (0, 1):
            for part in range(0, len(names := list(counts[label])), 50_000):
                some = names[part : part + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array([label] * len(some), pa.int32()), pa.array([counts[label][x] for x in some], pa.int64())], ["entry", "label", "n"])

    by_label = sample.mapInArrow(work, "entry string, label int, n long")
    sums = by_label.groupBy("entry").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("bad"), F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("good")
    )
    return sums.filter(F.col("bad") >= LEAST_DOCUMENTS)


def _contexts(sample: DataFrame, wanted: set[str]) -> DataFrame:
    """How many different words stand before each wanted entry: copies of one document say the same thing once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = set()
            for text in batch["text"].to_pylist():
                before = ""
                for found in clauses(text):
                    for w in found:
                        seen.update((e, before) for e in entries(w) if e in wanted)
                        before = w
            seen = sorted(seen)
            yield pa.RecordBatch.from_arrays([pa.array([e for e, _ in seen], pa.string()), pa.array([b for _, b in seen], pa.string())], ["entry", "before"])

    return sample.filter("label = 1").mapInArrow(work, "entry string, before string").groupBy("entry").agg(F.count_distinct("before").alias("contexts"))


def learn(documents: DataFrame, labels: DataFrame, label: str = "toxic", id: str = "doc_id", text: str = "text", most: int = SAMPLE_ROWS) -> Grammar:
    """Lexicon and class weights from about ``most`` labelled rows of the training side. With one label only, or no
    rows, nothing matches and every score is the smoothed share of toxic rows."""
    sample = training_sample(documents, labels, label, most, id).select(
        F.col(id).cast("long").alias("id"), F.col("_label").alias("label"), F.col(text).alias("text")
    )
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return Grammar({}, math.log((bad + 0.5) / (good + 0.5)), np.zeros(CLASSES))
    odds = F.log((F.col("bad") + 0.5) / F.lit(bad + 1.0)) - F.log((F.col("good") + 0.5) / F.lit(good + 1.0))
    strong = _candidates(sample).withColumn("odds", odds).filter(F.col("odds") >= LEAST_ODDS)
    chosen = {r["entry"]: r["odds"] for r in strong.orderBy(F.desc("odds"), "entry").collect()}
    varied = {r["entry"] for r in _contexts(sample, set(chosen)).filter(F.col("contexts") >= LEAST_CONTEXTS).collect()}
    lexicon = {e: w for e, w in chosen.items() if e in varied}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[str, tuple[int, float]] = {}
            found = [features(x, lexicon, known)[0] for x in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["id"], batch["label"], pa.array(found, pa.list_(pa.float64()))], ["id", "label", "x"])

    got = sample.mapInArrow(work, "id long, label int, x array<double>").toArrow().sort_by("id")
    x, y = np.array(got["x"].to_pylist()), got["label"].to_numpy().astype(float)
    weights = fit_logistic(np.hstack([np.ones((len(x), 1)), x]), y)
    return Grammar(lexicon, float(weights[0]), weights[1:])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 50) -> np.ndarray:
    """Newton's method; class weights other than the bias are kept from going below 0, as no match speaks for a text."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + penalty * w
        curve = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + np.diag(penalty)
        move = np.linalg.solve(curve, slope)
        w -= move * min(1.0, 4 / max(np.abs(move).max(), 1e-12))
        w[1:] = np.maximum(w[1:], 0.0)
        if np.abs(move).max() < 1e-6:
            break
    return w


def score_toxicity(documents: DataFrame, grammar: Grammar, id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The id, ``held_out``, ``score``, ``predicted`` and ``n_clauses`` (that matched) of every row.

    Null and empty texts match nothing and get the lowest score. Rows with a null id count as held out. Repeated rows
    get the same score each. Other columns are not looked at; an empty table gives no rows.
    """
    sent = documents.sparkSession.sparkContext.broadcast((grammar.lexicon, grammar.bias, grammar.weights))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, known = Grammar(*sent.value), {}
        for batch in batches:
            found = [machine.score(x, known) for x in batch["text"].to_pylist()]
            if len(known) > 500_000:
                known.clear()
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["held_out"], pa.array([s for s, _ in found], pa.float64()), pa.array([n for _, n in found], pa.int64())],
                ["id", "held_out", "score", "n_clauses"],
            )

    rows = documents.select(F.col(id).cast("long").alias("id"), held_out(F.col(id)).alias("held_out"), F.col(text).alias("text"))
    return rows.mapInArrow(work, "id long, held_out boolean, score double, n_clauses long").select(
        F.col("id").alias(id), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_clauses"
    )
