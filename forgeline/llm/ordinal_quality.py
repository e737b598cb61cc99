"""Quality grades by ordinal cumulative-link regression.

P(grade <= k) = logistic(threshold_k - z): one score z per text with ordered thresholds. z is the mean over the text's
white-space words of hashed weights (the word, its first byte, its last one and three bytes, case and symbols kept; and whether
the three words from here on come more than once in the text).
The thresholds stay in order because each adds an exponential to the one before. The
expected grade and the tail probabilities P(grade >= k) serve ranking and selection.

Grades here come from two binary labels: 0 low quality, 1 good but toxic, 2 good and not toxic. The fit takes at most `ROWS_PER_GRADE`
distinct texts per grade outside the held-out fold, chosen by hash of the id, weighted back to the labels' true shares.

Defined cases: null and empty texts and texts without words have z = 0. A grade without labels gets next to no probability (its
bounds start 1e-3 apart); without any labels the expected grade is 0. Null labels are not learnt from; a null toxic label counts as not toxic. Repeated
rows are judged one by one. An empty table gives no row. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from forgeline.llm.common import HELD_OUT, arrow_map, binary_column, id_text, slices
from forgeline.llm.hashing import SPACED, WordHasher, joined, mix
from forgeline.llm.labelled import sample_by_label

GRADE = "case when quality = 0 then 0 when quality = 1 and toxic = 1 then 1 when quality = 1 then 2 end"
GRADES = 3
ROWS_PER_GRADE = 1_000
BITS = 18
STEPS = 60
SELECT_TAIL = 1
SELECT_AT = 0.5
SLICE_BYTES = 1_000_000


@dataclass
class Model:
    """Hashed weights and ascending thresholds (one fewer than grades)."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, z: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ...: (texts, grades - 1)."""
        return _sigmoid(z[:, None] - self.thresholds[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def _features(texts: list[bytes], hasher: WordHasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, words) hashed, text number of each word, and words by text (1 at least)."""
    buffer, ends = joined(texts)
    starts, _, hashed = hasher.parts(buffer, prefixes=(1,), suffixes=(1, 3))
    doc = np.searchsorted(ends, starts, side="right")
    again = np.zeros(len(doc), np.uint64)
    if len(doc) > 2:
        run = mix(hashed[0][:-2] + mix(hashed[0][1:-1] + mix(hashed[0][2:] + doc[2:].astype(np.uint64))))
        _, which, times = np.unique(run, return_inverse=True, return_counts=True)
        again[:-2] = (times[which] > 1) & (doc[:-2] == doc[2:])
    features = np.stack([(h & np.uint64((1 << BITS) - 1)).astype(np.int64) for h in (*hashed, mix(again + np.uint64(99)))])
    return features, doc, np.maximum(np.bincount(doc, minlength=len(texts)), 1)


def scores(texts: list[bytes], weights: np.ndarray, hasher: WordHasher) -> np.ndarray:
    features, doc, words = _features(texts, hasher)
    return np.bincount(doc, weights[features].sum(axis=0), len(texts)) / words


@dataclass
class Problem:
    """The weighted likelihood of a sample: features by text, grades and the importance of each text."""

    features: np.ndarray
    doc: np.ndarray
    words: np.ndarray
    grade: np.ndarray
    importance: np.ndarray
    grades: int

    @classmethod
    def of(cls, rows: list[tuple[bytes, int]], importance: np.ndarray, grades: int) -> Problem:
        return cls(*_features([t for t, _ in rows], WordHasher(SPACED)), np.array([g for _, g in rows]), importance, grades)

    def _below(self, weights: np.ndarray, first: float, gaps: np.ndarray) -> np.ndarray:
        """P(grade < g) for g = 0 to `grades`; F(b_g - z) with b_0 = -inf and the last bound inf."""
        bounds = np.concatenate([[-np.inf], _thresholds(first, gaps), [np.inf]]).clip(-1e9, 1e9)
        z = np.bincount(self.doc, weights[self.features].sum(axis=0), len(self.grade)) / self.words
        return _sigmoid(bounds[None, :] - z[:, None])

    def likelihood(self, weights: np.ndarray, first: float, gaps: np.ndarray) -> float:
        below, at = self._below(weights, first, gaps), np.arange(len(self.grade))
        return float(self.importance @ np.log(np.maximum(below[at, self.grade + 1] - below[at, self.grade], 1e-12)))

    def gradient(self, weights: np.ndarray, first: float, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By weight (less a small penalty), and by the first bound and the logs of the gaps between bounds."""
        below = self._below(weights, first, gaps)
        slope = below * (1 - below)
        at, grade = np.arange(len(self.grade)), self.grade
        p = np.maximum(below[at, grade + 1] - below[at, grade], 1e-12)
        pull = self.importance * (slope[at, grade] - slope[at, grade + 1]) / p  # d log-likelihood / d z
        by_word = (pull / self.words)[self.doc]
        by_weight = sum(np.bincount(f, by_word, 1 << BITS) for f in self.features) - 1e-4 * weights
        by_bound = np.zeros(self.grades + 1)
        np.add.at(by_bound, grade + 1, self.importance * slope[at, grade + 1] / p)
        np.add.at(by_bound, grade, -self.importance * slope[at, grade] / p)
        later = np.cumsum(by_bound[2:self.grades][::-1])[::-1] * np.exp(gaps)
        return by_weight, np.concatenate([[by_bound[1:self.grades].sum()], later])


def _thresholds(first: float, gaps: np.ndarray) -> np.ndarray:
    return first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])


def fit(rows: list[tuple[bytes, int]], totals: dict[int, int], grades: int = GRADES, steps: int = STEPS) -> Model:
    """Weights and thresholds from a sample of (text, grade) and the numbers of labels it was drawn from."""
    weights = np.zeros(1 << BITS)
    if not rows:
        return Model(weights.astype(np.float32), np.full(grades - 1, 60.0))
    grade = np.array([g for _, g in rows])
    drawn = np.bincount(grade, minlength=grades)
    true = np.array([totals.get(g, 0) for g in range(grades)], float)
    # a grade that was not drawn starts with a gap of 1e-3 between its bounds, so next to no probability
    tail = np.cumsum(true[::-1])[::-1][1:] / true.sum()
    start = -np.log(np.clip(tail, 1e-6, 1 - 1e-6) / (1 - np.clip(tail, 1e-6, 1 - 1e-6)))
    importance = (np.where(drawn, true / np.maximum(drawn, 1), 0))[grade]
    importance /= importance.mean()
    first, gaps = start[0], np.log(np.maximum(np.diff(start), 1e-3))
    problem = Problem.of(rows, importance, grades)
    squares, squares_t = np.full(1 << BITS, 1e-8), np.full(grades - 1, 1e-6)
    for _ in range(steps):
        gradient, change = problem.gradient(weights, first, gaps)
        squares += gradient**2
        weights += 2.0 * gradient / np.sqrt(squares)
        squares_t += change**2
        step = 0.2 * change / np.sqrt(squares_t)
        first, gaps = first + step[0], gaps + step[1:]
    return Model(weights.astype(np.float32), _thresholds(first, gaps))


def graded(docs: DataFrame, labels: DataFrame, grade: str = GRADE, grades: int = GRADES, rows_per_grade: int = ROWS_PER_GRADE,
           select_tail: int = SELECT_TAIL, select_at: float = SELECT_AT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, expected_grade, tails (P(grade >= k), k = 1, ...) and selected (tail `select_tail` >= `select_at`)."""
    sample = sample_by_label(docs, labels, grade, dict.fromkeys(range(grades), rows_per_grade), "grade", id_col, text_col)
    model = docs.sparkSession.sparkContext.broadcast(fit(*sample, grades))
    rows = id_text(docs, id_col, text_col).selectExpr("doc_id", f"{HELD_OUT.format('doc_id')} as held_out", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(SPACED)
        for batch in batches:
            texts = [t or b"" for t in binary_column(batch, "text")]
            tails = [model.value.tails(scores(texts[a:b], model.value.weights, hasher))
                     for a, b in slices(np.array([len(t) for t in texts]), SLICE_BYTES)]
            tails = np.concatenate(tails) if tails else np.zeros((0, grades - 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(tails.sum(axis=1)), pa.array(tails.tolist(), pa.list_(pa.float64())),
                 pa.array(tails[:, select_tail - 1] >= select_at)],
                names=["doc_id", "held_out", "expected_grade", "tails", "selected"])

    return arrow_map(rows, judge, f"doc_id {kind}, held_out boolean, expected_grade double, tails array<double>, selected boolean")
