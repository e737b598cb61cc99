"""Language identification by mixture inference.

Each language has a distribution over character trigrams, counted on a bounded
sample of documents of known language (`PER_LANGUAGE` per language, by hash of the id; the whole text of each).
A document's trigrams are taken as draws from a mixture of languages; expectation-maximisation, run for each text until a round
gains next to nothing (`TOLERANCE`), finds its proportions. The language set
is the one of the best penalised likelihood: starting with all languages, the one
with the least share is left out while the log-likelihood loses less than `PENALTY` * log(trigrams). The
largest share gives the predicted language, its share the score.

Trigrams are over bytes of the text, A-Z as a-z, in 64 classes (26 letters, one for everything between words,
37 shared by the bytes of non-ASCII letters), with a letter in the middle: 262,144 kinds, 1 MB per language.

Defined cases: null and empty texts and texts without a letter give `und` and score 0, as does every text if no document has a known
language. A text with only unseen trigrams gets the first language by name with its equal share. Equal shares go to the first
language by name. Repeated rows are judged one by one. An empty table gives no row. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.llm.common import HELD_OUT, arrow_map, binary_column, id_text, slices
from forgeline.llm.hashing import joined

PER_LANGUAGE = 2_000
MOST_LANGUAGES = 256
KINDS = 1 << 18
UNSEEN = 0.02
PENALTY = 3.0
#: Log-likelihood that a round must gain for a text to go on (a penalty is some 20).
TOLERANCE = 1e-6
SLICE_BYTES = 1_000_000

_CLASS = np.zeros(256, np.uint8)
for _b in range(26):
    _CLASS[97 + _b] = _CLASS[65 + _b] = 1 + _b
_CLASS[128:] = 27 + (np.arange(128) * 37 >> 7)  # neighbours in a block of code points fall in neighbouring classes
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(text: bytes | None) -> bool:
    if not text:
        return False
    return bool(_ASCII_LETTER.search(text)) or (not text.isascii() and any(c.isalpha() for c in text.decode()))


def trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, kind, count) of all distinct trigrams, ascending by text."""
    buffer, ends = joined(texts)
    c = np.zeros(len(buffer) + 1, np.int64)
    c[1:] = _CLASS[np.frombuffer(buffer, np.uint8)]
    at = np.flatnonzero(c[1:-1])  # the last byte parts texts, so every letter has a right neighbour
    kind = (c[at] << 12) | (c[at + 1] << 6) | c[at + 2]
    packed = np.sort((np.searchsorted(ends, at, side="right") << 18) | kind)
    new = np.ones(len(packed), bool)
    new[1:] = packed[1:] != packed[:-1]
    first = np.flatnonzero(new)
    counts = np.diff(np.concatenate([first, [len(packed)]]))
    packed = packed[first]
    return packed >> 18, packed & (KINDS - 1), counts.astype(np.float64)


def _sums(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Column sums by text; `doc` ascends."""
    out = np.zeros((n, *values.shape[1:]))
    if len(doc):
        first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        out[doc[first]] = np.add.reduceat(values, first, axis=0)
    return out


def _fit(likelihood: np.ndarray, counts: np.ndarray, doc: np.ndarray, share: np.ndarray, tolerance: float = TOLERANCE
         ) -> tuple[np.ndarray, np.ndarray]:
    """Shares at the end of expectation-maximisation, and the log-likelihood with them.

    A text is done when a round gains `tolerance` or less; the arrays are cut down to the texts that go on.
    """
    share, gained = share.copy(), np.full(len(share), -np.inf)
    on = np.arange(len(share))  # texts that go on; `doc` counts within them
    now = share
    while len(on):
        part = likelihood * now[doc]
        total = part.sum(axis=1)
        likely = _sums(counts * np.log(total), doc, len(on))
        done = likely - gained[on] <= tolerance
        share[on], gained[on] = now, likely
        if done.any():
            left = ~done[doc]
            on, now = on[~done], now[~done]
            doc = (np.cumsum(~done) - 1)[doc[left]]
            likelihood, counts, part, total = likelihood[left], counts[left], part[left], total[left]
        part *= (counts / total)[:, None]
        now = _sums(part, doc, len(on))
        now /= np.maximum(now.sum(axis=1, keepdims=True), 1e-300)
    return share, gained


def mixtures(texts: list[bytes], model: np.ndarray, penalty: float = PENALTY, tolerance: float = TOLERANCE) -> np.ndarray:
    """Shares, (texts, languages); left-out languages have 0. `model` is (kinds, languages) of probabilities."""
    doc, kind, counts = trigrams(texts)
    n, languages = len(texts), model.shape[1]
    likelihood = model[kind]
    size = _sums(counts, doc, n)
    share, gained = _fit(likelihood, counts, doc, np.full((n, languages), 1.0 / languages), tolerance)
    live = np.flatnonzero(size > 0)
    left = languages
    while len(live) and left > 1:
        number = np.full(n, -1)
        number[live] = np.arange(len(live))
        of = number[doc]
        mine = of >= 0
        now = np.where(share[live] > 0, share[live], np.inf)
        out = now.argmin(axis=1)
        reduced = share[live].copy()
        reduced[np.arange(len(live)), out] = 0
        single = np.count_nonzero(reduced, axis=1) == 1
        reduced /= np.maximum(reduced.sum(axis=1, keepdims=True), 1e-300)
        reduced, likely = _fit(likelihood[mine], counts[mine], of[mine], reduced, tolerance)
        better = gained[live] - likely <= penalty * np.log(size[live] + 1)
        share[live[better]] = reduced[better]
        gained[live[better]] = likely[better]
        live = live[better & ~single]
        left -= 1
    return share


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Languages and the (kinds, languages) table, from documents outside the held-out fold."""
    known = docs.selectExpr(f"`{id_col}` as doc_id", f"cast(`{text_col}` as string) as text", f"cast(`{lang_col}` as string) as lang"
                            ).where(f"lang is not null and not {HELD_OUT.format('doc_id')}")
    rows = known.groupBy("lang").count().orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if len(rows) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: their tables are too large to send to every worker")
    languages = [r["lang"] for r in rows]
    if not languages:
        return [], np.zeros((KINDS, 0), np.float32)
    share = F.create_map(*[F.lit(x) for r in rows for x in (r["lang"], min(1.0, per_language / r["count"]))])
    chosen = known.where(F.expr("pmod(xxhash64(doc_id, 5), 1000000) / 1000000D") < share[F.col("lang")]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), binary_column(batch, "text")
            for lang in set(langs):
                own = [t or b"" for t, x in zip(texts, langs) if x == lang]
                for a, b in slices(np.array([len(t) for t in own]), SLICE_BYTES):
                    _, kind, counts = trigrams(own[a:b])
                    table[lang] = table.get(lang, 0) + np.bincount(kind, counts, KINDS)
        for lang, counts in table.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at, pa.int64()), pa.array(counts[at])],
                                             names=["lang", "kind", "n"])

    counted = arrow_map(chosen, count, "lang string, kind bigint, n double").groupBy("lang", "kind").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros((KINDS, len(languages)))
    table[counted["kind"].to_numpy(np.int64), counted["lang"].map(languages.index).to_numpy(np.int64)] = counted["n"]
    table /= np.maximum(table.sum(axis=0), 1)
    return languages, ((1 - UNSEEN) * table + UNSEEN / KINDS).astype(np.float32)


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
               per_language: int = PER_LANGUAGE, penalty: float = PENALTY) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score and shares (of the chosen languages, largest first)."""
    languages, table = fit(docs, id_col, text_col, lang_col, per_language)
    model = docs.sparkSession.sparkContext.broadcast(table)
    rows = id_text(docs, id_col, text_col).selectExpr("doc_id", f"{HELD_OUT.format('doc_id')} as held_out", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    share_type = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = binary_column(batch, "text")
            best, score, shares = [], [], []
            for a, b in slices(np.array([len(t or b"") for t in texts]), SLICE_BYTES):
                part = [t if languages and has_letter(t) else b"" for t in texts[a:b]]
                found = mixtures(part, model.value, penalty) if languages else np.zeros((len(part), 0))
                for t, row in zip(part, found):
                    order = np.argsort(-row, kind="stable")
                    order = order[row[order] > 0] if t else order[:0]
                    best.append(languages[order[0]] if len(order) else "und")
                    score.append(min(1.0, float(row[order[0]])) if len(order) else 0.0)
                    shares.append([{"lang": languages[i], "share": float(row[i])} for i in order])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(best, pa.string()), pa.array(score, pa.float64()), pa.array(shares, share_type)],
                names=["doc_id", "held_out", "lang_pred", "score", "shares"])

    return arrow_map(rows, judge, f"doc_id {kind}, held_out boolean, lang_pred string, score double, "
                                  "shares array<struct<lang: string, share: double>>")
