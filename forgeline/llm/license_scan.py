"""License scan: winnowed template fingerprints, an inverted index, and banded alignment.

Templates are word sequences (A-Z lower-cased runs of `[0-9a-z]` and non-ASCII bytes). A candidate counts when `LEAST` of
the template's words are matched and matches are `LEAST` of the alignment. With m matches and the errors this allows, some
matches are a run of `shared_run` words (2 for a template of 4 or 5 words, 3 up to 15, 4 above). Of the hashes of a template's
windows of `GRAM` words (2 if the run is that short) every run of `shared_run - GRAM + 1` keeps its least (winnowing), which an
inverted index maps to (template, place). Every window of a document is looked up, so every text that the rule accepts meets the
index. Each diagonal with a meeting is a candidate; template and document are aligned in a band around it, as wide as the
errors allow and of `BAND` words at most, then, if the rule refuses that, in all bands of `BAND` words that hold the diagonal
(document ends free). Of overlapping matches the one with more words, then the purer, stays.

The index is built from the templates alone (a few thousand entries; their words are checked against `MOST_TEMPLATE_WORDS`) and is sent to
every task; documents are scanned where they are read, without a shuffle.

Defined cases: null, empty and word-less texts have no match. A template of fewer than `GRAM` words is refused (ValueError). Equal templates: the first
by name is reported. Repeated rows are scanned one by one. An empty table gives no row. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from forgeline.llm.common import arrow_map, binary_column, id_text, slices
from forgeline.llm.hashing import WordHasher, joined, mix
from forgeline.llm.license_texts import TEMPLATES

GRAM = 3
BAND = 6
LEAST = 0.8
MOST_TEMPLATE_WORDS = 500_000
SLICE_BYTES = 1_000_000


def _grams(words: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word windows within a text, and the number of their first word."""
    if len(words) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    count = len(words) - n + 1
    code = np.zeros(count, np.uint64)
    for j in range(n):
        code = mix(code + words[j:j + count] * np.uint64(2 * j + 3))
    at = np.flatnonzero(doc[:count] == doc[n - 1:])
    return code[at], at


def _errors(matched: int, least: float) -> int:
    """The most errors beside `matched` matches that leave them `least` of the alignment."""
    n = 0
    while matched >= least * (matched + n + 1):
        n += 1
    return n


def shared_run(size: int, least: float = LEAST) -> int:
    """Words in a row that every accepted text shares with a template of `size` words."""
    return min(-(-m // (_errors(m, least) + 1)) for m in range(1, size + 1) if m >= least * size)


@dataclass
class Index:
    """Sorted fingerprints with the (template, place) each stands for."""

    names: list[str]
    words: list[np.ndarray]
    band: int
    bands: list[int]  # of each template: the errors it allows, `band` at most
    grams: list[int]  # the window lengths in use
    hashes: np.ndarray
    template: np.ndarray
    place: np.ndarray
    seen: np.ndarray  # by the top 16 bits of a hash: whether any fingerprint has them


def build_index(templates: tuple[tuple[str, str], ...] = TEMPLATES, gram: int = GRAM, least: float = LEAST, band: int = BAND) -> Index:
    hasher = WordHasher()
    names, sequences, bands, grams, entries = [], [], [], set(), []
    for number, (name, text) in enumerate(sorted(templates)):
        _, words = hasher.hashes(text.encode() + b"\0")
        if len(words) < gram:
            raise ValueError(f"{name}: a template needs {gram} words or more")
        run = shared_run(len(words), least)
        n = min(gram, run)
        window = run - n + 1
        code, _ = _grams(words, np.zeros(len(words), np.int64), n)
        places = {i + int(code[i:i + window].argmin()) for i in range(len(code) - window + 1)}
        entries += [(int(code[p]), number, p) for p in sorted(places)]
        names.append(name)
        sequences.append(words)
        bands.append(min(band, _errors(len(words), least)))
        grams.add(n)
    if sum(map(len, sequences)) > MOST_TEMPLATE_WORDS:
        raise ValueError(f"templates of more than {MOST_TEMPLATE_WORDS} words are too large to send to every task")
    entries.sort()
    hashes = np.array([e[0] for e in entries], np.uint64)
    seen = np.zeros(1 << 16, bool)
    seen[(hashes >> np.uint64(48)).astype(np.int64)] = True
    return Index(names, sequences, band, bands, sorted(grams), hashes, np.array([e[1] for e in entries], np.int64), np.array([e[2] for e in entries], np.int64), seen)


def align(template: np.ndarray, words: np.ndarray, diagonal: int, band: int = BAND) -> tuple[int, int, int, int]:
    """(matched words, alignment length, start, end) of the best alignment of the whole template within the band.

    A match scores 2, a replaced, left out or added word -1. Places before or after the words may be used up freely, so a cut-off
    template still aligns with what is there; words of the template that meet none count in the length.
    """
    width = 2 * band + 1
    low = diagonal - band  # the column of cell b in row i is low + i + b
    # (score, matched, length, first matched word or -1, after the last matched word)
    row = [(0, 0, 0, -1, -1)] * width
    for i, want in enumerate(template.tolist()):
        new = []
        for b in range(width):
            at = low + i + b
            score, matched, length, first, last = row[b]
            if 0 <= at < len(words) and words[at] == want:
                best = (score + 2, matched + 1, length + 1, at if first < 0 else first, at + 1)
            else:
                best = (score - 1, matched, length + 1, first, last)
            if b + 1 < width:  # a template word that the text lacks
                score, matched, length, first, last = row[b + 1]
                if score - 1 > best[0]:
                    best = (score - 1, matched, length + 1, first, last)
            if b and new[b - 1][1]:  # a word of the text that the template lacks
                score, matched, length, first, last = new[b - 1]
                if score - 1 > best[0]:
                    best = (score - 1, matched, length + 1, first, last)
            new.append(best)
        row = new
    _, matched, length, first, last = max(row, key=lambda c: (c[0], c[1], -c[2]))
    return matched, length, first, last


def matches(words: np.ndarray, place: np.ndarray, template: np.ndarray, at: np.ndarray, index: Index,
            least: float = LEAST) -> list[tuple[str, float, int, int]]:
    """(license, coverage, first word, after last word) of one text, in order, without overlaps."""
    found = set()
    for t, diagonal in sorted(set(zip(template.tolist(), (place - at).tolist()))):
        size, band = len(index.words[t]), index.bands[t]
        reach = np.arange(diagonal - 2 * index.band, diagonal + 2 * index.band + 1)[:, None] + np.arange(size)
        equal = (words[reach.clip(0, len(words) - 1)] == index.words[t]) & (reach >= 0) & (reach < len(words))
        # the best score in one band may break the rule where another band's keeps it
        wide = sorted(range(diagonal - index.band, diagonal + index.band + 1), key=lambda d: abs(d - diagonal))
        for middle, width in [(diagonal, band), *((d, index.band) for d in wide)]:
            at_row = middle - diagonal + 2 * index.band
            if np.count_nonzero(equal[at_row - width:at_row + width + 1].any(axis=0)) < least * size:
                continue  # too few of the template's words are anywhere in the band
            matched, length, first, last = align(index.words[t], words, middle, width)
            if matched >= least * size and matched >= least * length:
                found.add((-matched, -matched / length, index.names[t], first, last, matched / size))
                break
    taken: list[tuple[str, float, int, int]] = []
    for _, _, name, first, last, coverage in sorted(found):
        if all(last <= a or first >= b for _, _, a, b in taken):
            taken.append((name, coverage, first, last))
    return sorted(taken, key=lambda x: x[2])


def scan(texts: list[bytes], index: Index, hasher: WordHasher) -> list[list[dict]]:
    """Matches of each text: license, coverage, and start and end in code points."""
    buffer, text_ends = joined(texts)
    starts, ends, (hashed,) = hasher.parts(buffer)
    doc = np.searchsorted(text_ends, starts, side="right")
    out: list[list[dict]] = [[] for _ in texts]
    places, entries = [], []
    for n in index.grams:
        code, first = _grams(hashed, doc, n)
        maybe = np.flatnonzero(index.seen[(code >> np.uint64(48)).astype(np.int64)])
        left = np.searchsorted(index.hashes, code[maybe], side="left")
        right = np.searchsorted(index.hashes, code[maybe], side="right")
        met = np.flatnonzero(right > left)
        places.append(np.repeat(first[maybe[met]], right[met] - left[met]))
        entries += [np.arange(left[m], right[m]) for m in met]
    if not entries:
        return out
    place, entry = np.concatenate(places), np.concatenate(entries)
    of = doc[place]
    base = np.concatenate([[0], text_ends])
    word_base = np.searchsorted(doc, np.arange(len(texts) + 1))
    for d in np.unique(of):
        mine = of == d
        a, b = word_base[d], word_base[d + 1]
        for name, coverage, start, end in matches(hashed[a:b], place[mine] - a, index.template[entry[mine]], index.place[entry[mine]], index):
            text = texts[d]
            from_byte, to_byte = int(starts[a + start] - base[d]), int(ends[a + end - 1] - base[d])
            begin = len(text[:from_byte].decode(errors="replace"))
            out[d].append({"license": name, "coverage": coverage, "start": begin,
                           "end": begin + len(text[from_byte:to_byte].decode(errors="replace"))})
    return out


def licensed(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Per row: the id and matches (license, coverage, start, end), in order of place."""
    index = docs.sparkSession.sparkContext.broadcast(build_index(templates))
    rows = id_text(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    match_type = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            texts = [t or b"" for t in binary_column(batch, "text")]
            found: list[list[dict]] = []
            for a, b in slices(np.array([len(t) for t in texts]), SLICE_BYTES):
                found += scan(texts[a:b], index.value, hasher)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, match_type)], names=["doc_id", "matches"])

    return arrow_map(rows, look, f"doc_id {kind}, matches array<struct<license: string, coverage: double, start: bigint, end: bigint>>")
