"""Benchmark decontamination with a generalised suffix automaton.

All test items, as word sequences, form one automaton (each item starts anew at
the root, so no match runs from one item into the next). A document's words are streamed through it: after each
word the state and match length tell the longest run of words, ending here, that
some item contains. A run of `window` words or more marks its words as hit and names the
items of its last window; an item shorter than the window is matched as a whole through the
suffix links. A word that no item has sends the stream back to the root.

Items are dealt by hash to blocks of about `block_words` words; tasks build one automaton a block. The documents pass
`pass_blocks` blocks at a time: these automata are sent to every worker (so a worker and the driver hold that many, about
`block_words * pass_blocks` words and one item beyond, and an item has `MOST_ITEM_WORDS` words at most), and with more blocks the
marked documents are written to the shared folder between two passes. The benchmark's size is measured before, by one count in Spark.

Words: A-Z lower-cased, then `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the whole text.

Defined cases: null and word-less texts have no words, no hit and are clean. Items without words are
ignored. Items with the same text all count. Null item ids mark hits but are not listed. Repeated rows are judged one
by one. An empty benchmark leaves every document clean; an empty table gives no row. In `removed`, columns of
the input pass through whatever they are called; a null text stays null.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgeline.llm.common import arrow_map, binary_column, materialized

WINDOW = 13
BLOCK_WORDS = 200_000
#: Blocks that documents pass at a time, and words of the longest item.
PASS_BLOCKS = 4
MOST_ITEM_WORDS = 1_000_000
#: A document is contaminated when 1 of this many of its words is hit.
COVERAGE_ONE_IN = 20

_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


class ItemAutomaton:
    """Suffix automaton of several word sequences, with the items of each window."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.steps: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        coded = [(name, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words])
                 for name, words in items if words]
        for _, word_ids in coded:
            last = 0
            for w in word_ids:
                last = self._extend(last, w)
        # items whose windows a state holds; whole items shorter than the window, by state
        self.window_items: dict[int, set] = {}
        self.short_items: dict[int, list[tuple[int, set]]] = {}
        for name, word_ids in coded:
            state = 0
            for n, w in enumerate(word_ids, 1):
                state = self.steps[state][w]
                if n >= window:
                    self.window_items.setdefault(self._holding(state, window), set()).add(name)
            if len(word_ids) < window:
                at = self._holding(state, len(word_ids))
                ends = self.short_items.setdefault(at, [])
                found = next((s for n, s in ends if n == len(word_ids)), None)
                if found is None:
                    ends.append((len(word_ids), found := set()))
                found.add(name)
        self.window_state = [self._holding(s, window) if self.length[s] >= window else -1
                             for s in range(len(self.link))]
        # nearest state on the suffix path (itself included) that holds a short item
        order = sorted(range(len(self.link)), key=self.length.__getitem__)
        self.short_state = [-1] * len(self.link)
        for s in order:
            self.short_state[s] = s if s in self.short_items else self.short_state[self.link[s]] if s else -1

    def _state(self, length: int, steps: dict[int, int], link: int) -> int:
        self.steps.append(steps)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        """A state for the part of q that p reaches by w."""
        clone = self._state(self.length[p] + 1, dict(self.steps[q]), self.link[q])
        self.link[q] = clone
        while p != -1 and self.steps[p].get(w) == q:
            self.steps[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: int) -> int:
        known = self.steps[last].get(w)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, w, known)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p != -1 and w not in self.steps[p]:
            self.steps[p][w] = new
            p = self.link[p]
        if p != -1:
            q = self.steps[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return new

    def _holding(self, state: int, length: int) -> int:
        """The state on the suffix path whose strings include the one of this length."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def matches(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Hit word ranges [start, end), merged and ascending, and the ids of the items found."""
        steps, link, length, window = self.steps, self.link, self.length, self.window
        window_state, short_state = self.window_state, self.short_state
        spans: list[tuple[int, int]] = []
        found: set = set()
        seen: set[int] = set()
        state = run = 0
        for i, w in enumerate(map(self.vocabulary.get, words)):
            if w is None:
                state = run = 0
                continue
            step = steps[state].get(w)
            if step is None:
                while state and w not in steps[state]:
                    state = link[state]
                run = length[state]
                step = steps[state].get(w, 0)
                if not step:
                    run = 0
                    state = 0
                    continue
            state = step
            run += 1
            hit = 0
            if run >= window:
                at = state if length[link[state]] < window else window_state[state]
                hit = window
                if at not in seen:
                    seen.add(at)
                    found |= self.window_items[at]
            short = short_state[state]
            while short > 0:
                for n, names in self.short_items[short]:
                    if n <= run:
                        hit = max(hit, n)
                        found |= names
                short = short_state[link[short]]
            if hit:
                start = i + 1 - hit
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i + 1))
        return spans, found


def _merged(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(a + b):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _dealt(benchmark: DataFrame, id_col: str, text_col: str, block_words: int) -> tuple[DataFrame, int]:
    """Items (block, item, text) and the number of blocks; the size is counted before anything is sent."""
    items = benchmark.select(F.col(f"`{id_col}`").cast("string").alias("item"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [len(words_of(t)) for t in binary_column(batch, "text")]
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64())], names=["n"])

    sizes = arrow_map(items.select("text"), count, "n long").selectExpr("sum(n) as words", "max(n) as longest").first()
    if (sizes["longest"] or 0) > MOST_ITEM_WORDS:
        raise ValueError(f"a benchmark item has {sizes['longest']} words; one automaton of {MOST_ITEM_WORDS} may be sent to every worker")
    n = max(1, -(-(sizes["words"] or 0) // block_words))
    return items.where("text is not null").selectExpr(f"cast(pmod(xxhash64(item, text), {n}) as int) as block", "item", "text"), n


def automata(items: DataFrame, low: int, high: int, window: int = WINDOW) -> Broadcast:
    """The automata of the blocks from `low` to below `high`, built in tasks, sent to every worker."""
    own = items.where(f"block >= {low} and block < {high}").repartition(high - low, "block").sortWithinPartitions("block")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for block, item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), binary_column(batch, "text")):
                if words := words_of(text):
                    held.setdefault(block, []).append((item, words))
        for block, found in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(ItemAutomaton(found, window))], pa.binary())], names=["automaton"])

    rows = arrow_map(own, build, "automaton binary").collect()  # at most `pass_blocks` rows
    return items.sparkSession.sparkContext.broadcast([pickle.loads(bytes(r["automaton"])) for r in rows])


_MARKS = "n_words long, items array<string>, spans array<struct<start: long, end: long>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def marked(docs: DataFrame, benchmark: DataFrame, text_col: str, item_id_col: str = "item_id", item_text_col: str = "text",
           window: int = WINDOW, block_words: int = BLOCK_WORDS, pass_blocks: int = PASS_BLOCKS) -> DataFrame:
    """`docs` with n_words, items (ids as strings, sorted) and spans ([start, end) in words) of the hits as last columns."""
    items, n = _dealt(benchmark, item_id_col, item_text_col, block_words)
    out = docs
    for low in range(0, n, pass_blocks):
        sent = automata(items, low, min(n, low + pass_blocks), window)
        out = _pass(out if low == 0 else materialized(out, "decontaminate-pass"), text_col, sent, first=low == 0)
    return out


def _pass(docs: DataFrame, text_col: str, sent: Broadcast, first: bool) -> DataFrame:
    schema = T.StructType(docs.schema.fields + T.StructType.fromDDL(_MARKS).fields) if first else docs.schema
    width = len(docs.columns) - (0 if first else 3)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = sent.value
        for batch in batches:
            before = [(set(), [])] * batch.num_rows if first else [
                (set(i), [(s["start"], s["end"]) for s in p]) for i, p in zip(batch.column(width + 1).to_pylist(), batch.column(width + 2).to_pylist())]
            n_words, items, spans = [], [], []
            for text, (found, hits) in zip(binary_column(batch, text_col), before):
                words = words_of(text)
                for automaton in blocks:
                    more, names = automaton.matches(words)
                    hits = _merged(hits, more) if hits and more else hits or more
                    found = found | names
                n_words.append(len(words))
                items.append(sorted(found - {None}))
                spans.append([{"start": s, "end": e} for s, e in hits])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:width], pa.array(n_words, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(spans, _SPANS)],
                names=[*batch.schema.names[:width], "n_words", "items", "spans"])

    return arrow_map(docs, scan, schema)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **options) -> DataFrame:
    """Per row: the id, n_words, n_hit, items (ids as strings, sorted) and spans ([start, end) in words)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return marked(rows, benchmark, "text", **options).selectExpr(
        "doc_id", "n_words", "aggregate(spans, 0L, (n, s) -> n + s.end - s.start) as n_hit", "items", "spans")


def _without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    at = [m.span() for m in _WORD.finditer(text)]
    out, kept_from = [], 0
    for start, end in spans:
        out.append(text[kept_from:at[start][0]])
        kept_from = at[end - 1][1]
    return b"".join([*out, text[kept_from:]])


def removed(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", chars_col: str | None = None,
            coverage_one_in: int = COVERAGE_ONE_IN, **options) -> DataFrame:
    """`docs` without contaminated rows; in the others hit spans are cut out of the text.

    A row is contaminated if it has hits and `coverage_one_in` * hit words >= its words. `chars_col` names a
    column that holds the text's length in code points, to be kept true.
    """
    names = list(docs.columns)
    text_at = names.index(text_col)
    chars_at = names.index(chars_col) if chars_col else None
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    found = marked(plain, benchmark, f"c{text_at}", **options)
    hit = "aggregate(spans, 0L, (n, s) -> n + s.end - s.start)"
    kept = found.where(f"not (size(spans) > 0 and {coverage_one_in} * {hit} >= n_words)").drop("n_words", "items")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, spans = list(batch.columns[:-1]), batch.column(len(names)).to_pylist()
            hit = [i for i, s in enumerate(spans) if s]
            if hit:
                texts, changed = binary_column(batch, f"c{text_at}"), {}
                for i in hit:
                    texts[i] = _without(texts[i], [(s["start"], s["end"]) for s in spans[i]])
                    changed[i] = len(texts[i].decode())
                columns[text_at] = pa.array(texts, pa.binary()).cast(columns[text_at].type)
                if chars_at is not None:
                    old = columns[chars_at]
                    columns[chars_at] = pa.array([changed.get(i, v) for i, v in enumerate(old.to_pylist())], old.type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return arrow_map(kept, cut, plain.schema).toDF(*names)


def digest(result: DataFrame, coverage_one_in: int = COVERAGE_ONE_IN) -> DataFrame:
    """The contract's columns from `contamination`'s result."""
    return result.selectExpr(
        "doc_id", "n_words", "n_hit", "cast(size(items) as bigint) as n_items",
        "sha2(array_join(items, ','), 256) as items_sha256",
        f"n_hit > 0 and {coverage_one_in} * n_hit >= n_words as contaminated")
