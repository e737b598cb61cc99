"""Toxicity by a linear-chain conditional random field.

The field has two tags, clean and toxic. A token's score for toxic sums hashed weights of its word, prefixes and suffix;
four transition scores tie neighbours. Token labels for fitting come from document labels: a token of a toxic document is
labelled toxic if its word, a prefix or its suffix is in
toxic documents of the sample more often than chance explains (`_marked`). The
field is fitted by gradient steps on the exact likelihood, from forward-backward marginals.

Scoring: forward-backward over every token of the whole text gives each token's marginal. The log of their sum is the document's
evidence; a logistic curve fitted on the sample (weighted back to the labels' true shares) makes it a score. Runs of tokens with a marginal of
`SPAN` or more are the offending spans. Chains are cut in chunks of `CHUNK` tokens; products of the 2 x 2 step
matrices carry the messages between chunks, so the marginals are exact at any length and all chunks go through numpy at once.

The sample: at most `TOXIC_ROWS` toxic and `CLEAN_ROWS` clean documents outside the held-out fold, distinct texts, chosen by hash of the id.

Defined cases: null and empty texts and texts without words have no evidence and get the lowest score. Without labels of both kinds
all texts get the share of toxic labels (0 if there are none). Null ids count as not held out. Repeated rows are scored one by one. An empty table
gives no row. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from forgeline.llm.common import HELD_OUT, arrow_map, binary_column, id_text, slices
from forgeline.llm.hashing import WordHasher, joined, mix
from forgeline.llm.labelled import sample_by_label

TOXIC_ROWS = 1_000
CLEAN_ROWS = 1_600
BITS = 20
PREFIXES, SUFFIXES = (3, 4, 5), (4,)
CHUNK = 64
STEPS = 25
SPAN = 0.5
PREDICTED = 0.3
SLICE_BYTES = 1_000_000
_FLOOR = 1e-5


class Chains:
    """Token chains of several documents, laid out in chunks: (CHUNK, chunks) arrays, chains side by side."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths
        count = -(-lengths // CHUNK)
        first = np.concatenate([[0], np.cumsum(count)])
        self.chunks = int(first[-1])
        doc = np.repeat(np.arange(len(lengths)), lengths)
        inside = np.arange(len(doc)) - np.repeat(np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
        #: place of each token in a flattened (CHUNK, chunks) array
        self.place = (inside % CHUNK) * self.chunks + first[doc] + inside // CHUNK
        self.real = np.zeros((CHUNK, self.chunks), bool)
        self.real.ravel()[self.place] = True
        order = np.argsort(-count, kind="stable")
        #: chunk numbers of round r: the r-th chunk of every chain that has one
        self.rounds = [first[order[: int(np.count_nonzero(count > r))]] + r for r in range(int(count.max(initial=0)))]

    def forward_backward(self, score: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, ...]:
        """Messages F0, F1 (forward), B0, B1 (backward), each (CHUNK, chunks), and the forward message before each chunk.

        `score` is each token's log-odds for toxic, `transition` the 2 x 2 potentials; the tag before the first token is clean.
        """
        (t00, t01), (t10, t11) = transition
        toxic = np.zeros(CHUNK * self.chunks)
        toxic[self.place] = 1.0 / (1.0 + np.exp(-np.clip(score, -30, 30)))
        toxic = toxic.reshape(CHUNK, self.chunks)
        clean = 1.0 - toxic
        real = self.real
        p00, p01, p10, p11 = np.ones(self.chunks), np.zeros(self.chunks), np.zeros(self.chunks), np.ones(self.chunks)
        for j in range(CHUNK):
            c, s, r = clean[j], toxic[j], real[j]
            p00, p01 = np.where(r, (p00 * t00 + p01 * t10) * c, p00), np.where(r, (p00 * t01 + p01 * t11) * s, p01)
            p10, p11 = np.where(r, (p10 * t00 + p11 * t10) * c, p10), np.where(r, (p10 * t01 + p11 * t11) * s, p11)
            if j % 4 == 3:
                scale = p00 + p01 + p10 + p11
                p00, p01, p10, p11 = p00 / scale, p01 / scale, p10 / scale, p11 / scale
        before = np.zeros((2, self.chunks))
        after = np.ones((2, self.chunks))
        a0, a1 = (np.ones(len(self.rounds[0])), np.zeros(len(self.rounds[0]))) if self.rounds else (None, None)
        for at in self.rounds:
            a0, a1 = a0[: len(at)], a1[: len(at)]
            before[:, at] = a0, a1
            a0, a1 = a0 * p00[at] + a1 * p10[at], a0 * p01[at] + a1 * p11[at]
            scale = a0 + a1
            a0, a1 = a0 / scale, a1 / scale
        b0 = b1 = np.zeros(0)
        for at in reversed(self.rounds):
            b0 = np.concatenate([b0, np.ones(len(at) - len(b0))])
            b1 = np.concatenate([b1, np.ones(len(at) - len(b1))])
            after[:, at] = b0, b1
            b0, b1 = p00[at] * b0 + p01[at] * b1, p10[at] * b0 + p11[at] * b1
            scale = b0 + b1
            b0, b1 = b0 / scale, b1 / scale
        f0s, f1s, b0s, b1s = (np.empty((CHUNK, self.chunks)) for _ in range(4))
        f0, f1 = before
        for j in range(CHUNK):
            c, s, r = clean[j], toxic[j], real[j]
            n0, n1 = (f0 * t00 + f1 * t10) * c, (f0 * t01 + f1 * t11) * s
            scale = n0 + n1
            f0, f1 = np.where(r, n0 / scale, f0), np.where(r, n1 / scale, f1)
            f0s[j], f1s[j] = f0, f1
        b0, b1 = after
        for j in range(CHUNK - 1, -1, -1):
            c, s, r = clean[j], toxic[j], real[j]
            b0s[j], b1s[j] = b0, b1
            n0, n1 = t00 * c * b0 + t01 * s * b1, t10 * c * b0 + t11 * s * b1
            scale = n0 + n1
            b0, b1 = np.where(r, n0 / scale, b0), np.where(r, n1 / scale, b1)
        self.toxic, self.clean = toxic, clean
        return f0s, f1s, b0s, b1s, before

    def marginals(self, score: np.ndarray, transition: np.ndarray) -> np.ndarray:
        """Each token's probability to be toxic."""
        f0, f1, b0, b1, _ = self.forward_backward(score, transition)
        return (f1 * b1 / (f0 * b0 + f1 * b1)).ravel()[self.place]

    def expected(self, score: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Marginals, and the expected numbers of the four transitions."""
        f0, f1, b0, b1, before = self.forward_backward(score, transition)
        prior = np.stack([np.concatenate([before[:1], f0[:-1]]), np.concatenate([before[1:], f1[:-1]])])
        pairs = np.stack([prior[i] * transition[i, j] * (self.clean, self.toxic)[j] * (b0, b1)[j]
                          for i in (0, 1) for j in (0, 1)])
        pairs = np.where(self.real, pairs / pairs.sum(axis=0), 0).sum(axis=(1, 2)).reshape(2, 2)
        return (f1 * b1 / (f0 * b0 + f1 * b1)).ravel()[self.place], pairs


@dataclass
class Model:
    """Weights by hashed feature, bias, transition potentials, and the logistic curve of the evidence."""

    weights: np.ndarray
    bias: float
    transition: np.ndarray
    slope: float
    intercept: float

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-(self.slope * np.log(evidence + _FLOOR) + self.intercept)))


def _tokens(texts: list[bytes], hasher: WordHasher) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, text number, (features, tokens) hashed features, and tokens by text."""
    buffer, text_ends = joined(texts)
    starts, ends, hashed = hasher.parts(buffer, PREFIXES, SUFFIXES)
    doc = np.searchsorted(text_ends, starts, side="right")
    features = np.stack([(h & np.uint64((1 << BITS) - 1)).astype(np.int32) for h in hashed])
    return starts, ends, doc, features, np.bincount(doc, minlength=len(texts))


def _families(doc: np.ndarray, word: np.ndarray, texts: int) -> np.ndarray:
    """A number per text that near copies tend to share: the least hash of three words in a row."""
    if len(word) < 3:
        return np.arange(texts)
    run = mix(word[:-2] + mix(word[1:-1] + mix(word[2:])))
    same = doc[:-2] == doc[2:]
    least = mix(np.arange(texts, dtype=np.uint64))  # texts of fewer words are families of their own
    first = np.flatnonzero(same & np.concatenate([[True], doc[1:-2] != doc[:-3]]))
    if len(first):
        run[~same] = np.uint64(2**64 - 1)
        least[doc[first]] = np.minimum.reduceat(run, first)
    return np.unique(least, return_inverse=True)[1]


def _marked(doc: np.ndarray, features: np.ndarray, toxic: np.ndarray, family: np.ndarray) -> np.ndarray:
    """Token labels: tokens of toxic documents with a feature that toxic documents have more often than chance explains.

    Families are counted, not documents: copies of one toxic document say no more than one.
    """
    n_toxic, n_clean = len(np.unique(family[toxic])), len(np.unique(family[~toxic]))
    count = lambda of: np.bincount(np.unique((features[:, of].astype(np.int64) << 24) + family[doc[of]]) >> 24, minlength=1 << BITS)
    found, other = count(toxic[doc]), count(~toxic[doc])
    # as a binomial tail bound over all features: a rare word that chance put into toxic documents only is not marked
    total = found + other
    share, usual = found / np.maximum(total, 1), n_toxic / (n_toxic + n_clean)
    with np.errstate(divide="ignore", invalid="ignore"):
        surprise = total * (share * np.log(share / usual) + np.where(share < 1, (1 - share) * np.log((1 - share) / (1 - usual)), 0))
    strong = (share > 0.8) & (surprise > np.log(max(2, np.count_nonzero(total))))
    return toxic[doc] & strong[features].any(axis=0)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a weighted, lightly penalised logistic curve (Newton steps)."""
    design = np.stack([x, np.ones_like(x)])
    beta = np.zeros(2)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-beta @ design))
        gradient = design @ (weight * (y - p)) - 1e-2 * beta
        curvature = (design * (weight * p * (1 - p))) @ design.T + 1e-2 * np.eye(2)
        step = np.linalg.solve(curvature, gradient)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def fit(rows: list[tuple[bytes, int]], totals: dict[int, int], steps: int = STEPS) -> Model:
    """The field and its curve from a sample of (text, toxic) and the numbers of labels it was drawn from."""
    weights, bias, scores = np.zeros(1 << BITS), -4.0, np.log(np.array([[0.95, 0.05], [0.7, 0.3]]))
    toxic = np.array([y == 1 for _, y in rows], bool)
    if not toxic.any() or toxic.all():
        share = totals.get(1, 0) / max(1, sum(totals.values()))
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(weights.astype(np.float32), bias, np.exp(scores), 0.0, float(np.log(share / (1 - share))))
    _, _, doc, features, lengths = _tokens([t for t, _ in rows], WordHasher())
    tag = _marked(doc, features, toxic, _families(doc, features[0].astype(np.uint64), len(rows)))
    chains = Chains(lengths)
    first = np.ones(len(doc), bool)
    first[1:] = doc[1:] != doc[:-1]
    prior = np.concatenate([[False], tag[:-1]]) & ~first
    observed = np.bincount(2 * prior + tag, minlength=4).reshape(2, 2)
    squares, squares_t, square_b = np.full(1 << BITS, 1e-6), np.full((2, 2), 1e-6), 1e-6
    for _ in range(steps):
        p, pairs = chains.expected(bias + sum(weights[f] for f in features), np.exp(scores))
        wrong = tag - p
        gradient = sum(np.bincount(f, wrong, 1 << BITS) for f in features) - 1e-3 * weights
        squares += gradient**2
        weights += 0.7 * gradient / np.sqrt(squares)
        change = observed - pairs - 1e-3 * scores
        squares_t += change**2
        scores += 0.2 * change / np.sqrt(squares_t)
        square_b += wrong.sum() ** 2
        bias += 0.2 * wrong.sum() / np.sqrt(square_b)
    p = chains.marginals(bias + sum(weights[f] for f in features), np.exp(scores))
    evidence = np.bincount(doc, p, len(rows))
    share = np.where(toxic, totals.get(1, 1) / toxic.sum(), totals.get(0, 1) / (~toxic).sum())
    slope, intercept = _logistic(np.log(evidence + _FLOOR), toxic.astype(float), share / share.mean())
    return Model(weights.astype(np.float32), bias, np.exp(scores), slope, intercept)


def tag(texts: list[bytes], model: Model, hasher: WordHasher, span: float = SPAN) -> tuple[np.ndarray, list[list[dict]]]:
    """Each text's evidence and its toxic spans: code point offsets and the largest marginal."""
    starts, ends, doc, features, lengths = _tokens(texts, hasher)
    spans: list[list[dict]] = [[] for _ in texts]
    if not len(doc):
        return np.zeros(len(texts)), spans
    p = Chains(lengths).marginals(model.bias + model.weights[features].sum(axis=0), model.transition)
    base = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    last = -2
    for i in np.flatnonzero(p >= span):
        own, text = spans[doc[i]], texts[doc[i]]
        start, end = int(starts[i] - base[doc[i]]), int(ends[i] - base[doc[i]])
        if own and last == i - 1:
            own[-1]["bytes_end"] = end
            own[-1]["score"] = max(own[-1]["score"], float(p[i]))
        else:
            own.append({"bytes_start": start, "bytes_end": end, "score": float(p[i])})
        last = i
    for own, text in zip(spans, texts):
        at = chars = 0
        for x in own:
            for name, byte in (("start", x.pop("bytes_start")), ("end", x.pop("bytes_end"))):
                chars += len(text[at:byte].decode(errors="replace"))
                at = byte
                x[name] = chars
    return np.bincount(doc, p, len(texts)), spans


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
           toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted and spans (start and end in code points, score)."""
    model = docs.sparkSession.sparkContext.broadcast(fit(*sample_by_label(
        docs, labels, f"`{label_col}`", {1: toxic_rows, 0: clean_rows}, "toxic", id_col, text_col)))
    rows = id_text(docs, id_col, text_col).selectExpr("doc_id", f"{HELD_OUT.format('doc_id')} as held_out", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            texts = [t or b"" for t in binary_column(batch, "text")]
            scores, spans = [], []
            for a, b in slices(np.array([len(t) for t in texts]), SLICE_BYTES):
                evidence, found = tag(texts[a:b], model.value, hasher)
                scores += model.value.score(evidence).tolist()
                spans += found
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()),
                 pa.array([int(s >= PREDICTED) for s in scores], pa.int32()), pa.array(spans, span_type)],
                names=["doc_id", "held_out", "score", "predicted", "spans"])

    return arrow_map(rows, judge, f"doc_id {kind}, held_out boolean, score double, predicted int, "
                                  "spans array<struct<start: bigint, end: bigint, score: double>>")
