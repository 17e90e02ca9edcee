"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

    score = sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2))

The pairwise part of rank ``RANK`` is worked out by the sum-of-squares identity, in time linear in a document's
distinct words. It is fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``); every document is scored in whole.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casetrail.llm.labelled import held_out, training_sample

#: Labelled rows to fit on, at most (the bound of the sample); about 3 KB of features each reach the driver.
SAMPLE_ROWS = 6_000
WORD_PLACES, RANK, EPOCHS, BATCH = 1 << 13, 6, 8, 64
THRESHOLD = 0.3

_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
_CAPITALS, _DIGITS, _SPACE = bytes(range(65, 91)), b"0123456789", b" \t\n\r\x0b\x0c"

#: Places after the words: a constant, the statistics, and each statistic's bucket of eight.
STATISTICS = 12
PLACES = WORD_PLACES + STATISTICS * 9


def statistics(raw: bytes, words: list[bytes], counts: Counter, n_chars: float) -> list[float]:
    """Shares between 0 and 1 of the text's structure; 0 where there is nothing to divide by."""
    size, n = max(len(raw), 1), max(len(words), 1)
    letters = len(raw) - len(raw.translate(None, _LETTERS))
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    digits = len(raw) - len(raw.translate(None, _DIGITS))
    spaces = len(raw) - len(raw.translate(None, _SPACE))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    same = sum(a == b for a, b in zip(words, words[1:]))
    return [
        letters / size,
        capitals / max(letters, 1),
        digits / size,
        (size - letters - digits - spaces) / size if raw else 0.0,
        len(counts) / n if words else 0.0,
        max(counts.values(), default=0) / n,
        same / n,
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        min(sum(map(len, words)) / n / 20, 1.0),
        min(math.log1p(len(words)) / 12, 1.0),
        min(math.log1p(n_chars) / 14, 1.0),
        min(len(lines) / n, 1.0),
    ]


def features(raw: bytes | None, n_chars: float | None) -> tuple[np.ndarray, np.ndarray]:
    """(places, values) of a whole text."""
    raw = raw or b""
    words = raw.lower().split()
    counts = Counter(words)
    places = np.fromiter((xxhash.xxh3_64_intdigest(w) % WORD_PLACES for w in counts), dtype=np.int64, count=len(counts))
    weights = np.log1p(np.fromiter(counts.values(), dtype=np.float64, count=len(counts)))
    values = np.bincount(places, weights, minlength=0) if len(places) else np.empty(0)
    places = np.flatnonzero(values)
    values = values[places]
    if len(values):
        values = values / np.sqrt((values**2).sum())
    stats = np.array(statistics(raw, raw.split(), counts, float(n_chars or 0)))
    at = WORD_PLACES + np.arange(STATISTICS) * 9
    buckets = at + 1 + np.minimum((stats * 8).astype(np.int64), 7)
    return np.concatenate([places, at, buckets]), np.concatenate([values, stats, np.full(STATISTICS, 0.5)])


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, places: np.ndarray, values: np.ndarray) -> float:
        parts = self.factors[places] * values[:, None]
        pairs = 0.5 * float((parts.sum(axis=0) ** 2).sum() - (parts**2).sum())
        return _sigmoid(self.bias + float(self.weights[places] @ values) + pairs)


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rate: float = 0.1, decay: float = 1e-5, seed: int = 7) -> Machine:
    """AdaGrad on the logistic loss, both labels weighted alike. Without two labels the score is the labels' mean."""
    rng = np.random.default_rng(seed)
    model = Machine(0.0, np.zeros(PLACES), rng.normal(0, 0.02, (PLACES, RANK)))
    if len(set(labels.tolist())) < 2:
        model.bias, model.factors = (0.0 if not len(labels) else 30.0 * (2 * float(labels[0]) - 1)), np.zeros((PLACES, RANK))
        return model
    importance = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    seen_w, seen_v, seen_b = np.full(PLACES, 1e-6), np.full((PLACES, RANK), 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            sizes = np.array([len(rows[i][0]) for i in chosen])
            place = np.concatenate([rows[i][0] for i in chosen])
            value = np.concatenate([rows[i][1] for i in chosen])
            starts, row = np.concatenate([[0], np.cumsum(sizes)[:-1]]), np.repeat(np.arange(len(chosen)), sizes)
            parts = model.factors[place] * value[:, None]
            sums = np.add.reduceat(parts, starts)
            raw = model.bias + np.add.reduceat(model.weights[place] * value, starts)
            raw += 0.5 * (sums**2 - np.add.reduceat(parts**2, starts)).sum(axis=1)
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[chosen]) * importance[chosen] / len(chosen)
            step_w = np.bincount(place, error[row] * value, minlength=PLACES)
            step_v = np.empty((PLACES, RANK))
            pull = (error[row] * value)[:, None] * (sums[row] - parts)
            for f in range(RANK):
                step_v[:, f] = np.bincount(place, pull[:, f], minlength=PLACES)
            step_w += decay * model.weights
            seen_w += step_w**2
            seen_v += step_v**2
            seen_b += error.sum() ** 2
            model.weights -= rate * step_w / np.sqrt(seen_w)
            model.factors -= 0.3 * rate * step_v / np.sqrt(seen_v)
            model.bias -= rate * error.sum() / math.sqrt(seen_b)
    return model


def train(documents: DataFrame, labels: DataFrame, label: str = "quality", id: str = "doc_id", text: str = "text", n_chars: str = "n_chars", most: int = SAMPLE_ROWS) -> Machine:
    """A machine fitted on at most about ``most`` labelled rows of the training side."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(*x) for x in zip(batch["text"].to_pylist(), batch["n_chars"].to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["label"], pa.array([x for x, _ in found], pa.list_(pa.int64())), pa.array([x for _, x in found], pa.list_(pa.float64()))],
                ["id", "label", "places", "x"],
            )

    sample = training_sample(documents, labels, label, most, id).select(
        F.col(id).cast("long").alias("id"), F.col("_label").alias("label"), F.col(text).cast("binary").alias("text"), F.col(n_chars).cast("double").alias("n_chars")
    )
    got = sample.mapInArrow(work, "id long, label int, places array<long>, x array<double>").toArrow()
    order = np.lexsort([[len(x) for x in got["places"]], got["id"].to_numpy()]) if got.num_rows else []
    rows = [(got["places"][int(i)].values.to_numpy(), got["x"][int(i)].values.to_numpy()) for i in order]
    return fit(rows, got["label"].to_numpy()[order].astype(float) if got.num_rows else np.empty(0))


def score_quality(documents: DataFrame, model: Machine, id: str = "doc_id", text: str = "text", n_chars: str = "n_chars", threshold: float = THRESHOLD) -> DataFrame:
    """The id, ``held_out``, ``score`` and ``predicted`` of every row.

    Null texts count as empty, a null or missing length as 0, and rows with a null id as held out. Repeated rows get
    the same score each. Other columns are not looked at; an empty table gives no rows.
    """
    sent = documents.sparkSession.sparkContext.broadcast((model.bias, model.weights, model.factors))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine(*sent.value)
        for batch in batches:
            scores = [machine.score(*features(*x)) for x in zip(batch["text"].to_pylist(), batch["n_chars"].to_pylist())]
            yield pa.RecordBatch.from_arrays([batch["id"], batch["held_out"], pa.array(scores, pa.float64())], ["id", "held_out", "score"])

    length = F.col(n_chars).cast("double") if n_chars in documents.columns else F.lit(0.0)
    rows = documents.select(F.col(id).cast("long").alias("id"), held_out(F.col(id)).alias("held_out"), F.col(text).cast("binary").alias("text"), length.alias("n_chars"))
    return rows.mapInArrow(work, "id long, held_out boolean, score double").select(
        F.col("id").alias(id), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
