"""Quality rules as a short-circuit cascade.

A rule rejects a document by a bound on a measure. Measures are taken only when a rule asks for them, so
the order of the rules decides what a rejected document costs. On a sample (about `sample_rows` rows, drawn over the whole table) every measure's cost is
timed by itself, and every rule's verdict and the measures it asks for are noted. The order is built step by step: next comes the rule that
rejects most of the sample's documents still there per second, counting only measures that no rule before has taken. A document leaves
at the first rule that rejects it. The order changes the work, never the verdict.

Words are `[^\\x20\\x09-\\x0D]+` of the whole text.

Defined cases: null and empty texts have no words and fail the word count. Repeated rows are judged one by one. An empty table gives no
row (and no sample: rules stay in the order given). Columns of the input pass through `kept_rows` whatever they are called;
`judged` reads two columns only.
"""

from __future__ import annotations

import pickle
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from forgeline.llm.common import arrow_map, binary_column, id_text

SAMPLE_ROWS = 2_000
_CONTINUATION = bytes(range(0x80, 0xC0))
_SPACES = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"


class Measures:
    """Measures of one text, each taken when first asked for."""

    def __init__(self, text: bytes | None):
        self.text = text or b""

    def __getattr__(self, name: str):
        value = getattr(Measures, "_" + name)(self)
        self.__dict__[name] = value
        return value

    def _words(self) -> list[bytes]:
        return self.text.split()

    def _n_words(self) -> int:
        return len(self.words)

    def _word_chars(self) -> int:
        return len(self.text.translate(None, _CONTINUATION + _SPACES))

    def _n_symbols(self) -> int:
        return len(self.text) - len(self.text.translate(None, _SYMBOLS))

    def _n_upper(self) -> int:
        return len(self.text) - len(self.text.translate(None, bytes(range(65, 91))))

    def _lines(self) -> list[bytes]:
        return [x for x in self.text.split(b"\n") if x and not x.isspace()]

    def _n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    def _n_repeat_words(self) -> int:
        w = self.words
        windows = list(zip(w, w[1:], w[2:]))
        seen: set = set()
        often = {x for x in windows if x in seen or seen.add(x)} if len(set(windows)) < len(windows) else None
        if not often:
            return 0
        hit = bytearray(len(w))
        for i, x in enumerate(windows):
            if x in often:
                hit[i:i + 3] = b"\x01\x01\x01"
        return sum(hit)


@dataclass(frozen=True)
class Rule:
    """`rejects` is true for a document that must go."""

    name: str
    rejects: Callable[[Measures], bool]


#: Bounds of the default rules; integer arithmetic, so the verdict is exact.
BASE_RULES = (
    Rule("too_few_words", lambda m: m.n_words < 50),
    Rule("repeated_windows", lambda m: 100 * m.n_repeat_words > 50 * m.n_words),
)
DEFAULT_RULES = BASE_RULES + (
    Rule("mean_word_length", lambda m: m.word_chars < 2 * m.n_words or m.word_chars > 15 * m.n_words),
    Rule("symbols", lambda m: 10 * m.n_symbols > m.n_words),
    Rule("duplicate_lines", lambda m: 2 * m.n_dup_lines > len(m.lines)),
    Rule("capitals", lambda m: 10 * m.n_upper > 6 * m.word_chars),
)


def passes(m: Measures, rules: tuple[Rule, ...]) -> bool:
    return not any(r.rejects(m) for r in rules)


class TimedMeasures(Measures):
    """Measures that note, by name, the seconds each took without those it asked for itself."""

    def __init__(self, text: bytes | None):
        super().__init__(text)
        self.__dict__["seconds"], self.__dict__["_inner"] = {}, [0.0]

    def __getattr__(self, name: str):
        self._inner.append(0.0)
        began = time.perf_counter()
        value = super().__getattr__(name)
        took = time.perf_counter() - began
        self.seconds[name] = took - self._inner.pop()
        self._inner[-1] += took
        return value


@dataclass
class Trial:
    """What the sample shows of one text: seconds of each measure, and for each rule its verdict, own seconds and measures."""

    seconds: dict[str, float]
    rejected: list[bool]
    own: list[float]
    asked: list[set[str]]


def trial_of(text: bytes | None, rules: tuple[Rule, ...]) -> Trial:
    seconds, rejected, own, asked = {}, [], [], []
    for rule in rules:
        m = TimedMeasures(text)
        began = time.perf_counter()
        rejected.append(bool(rule.rejects(m)))
        own.append(max(0.0, time.perf_counter() - began - sum(m.seconds.values())))
        asked.append(set(m.seconds))
        for name, took in m.seconds.items():
            seconds[name] = min(took, seconds.get(name, took))
    return Trial(seconds, rejected, own, asked)


def spent(trials: list[Trial], order: list[int]) -> float:
    """Seconds that the sample takes when rules run in this order."""
    total = 0.0
    for t in trials:
        taken: set[str] = set()
        for i in order:
            total += t.own[i] + sum(t.seconds[n] for n in t.asked[i] - taken)
            taken |= t.asked[i]
            if t.rejected[i]:
                break
    return total


def best_order(trials: list[Trial], n: int) -> list[int]:
    """Rule numbers by rejections per second among the documents that are left, given what earlier rules have taken."""
    order, left, taken = [], list(trials), [set() for _ in trials]
    while len(order) < n:
        def worth(i: int) -> tuple[float, int]:
            cost = sum(t.own[i] + sum(t.seconds[m] for m in t.asked[i] - has) for t, has in zip(left, taken))
            return sum(t.rejected[i] for t in left) / max(cost, 1e-9), -i

        chosen = max((i for i in range(n) if i not in order), key=worth)
        order.append(chosen)
        stay = [(t, has | t.asked[chosen]) for t, has in zip(left, taken) if not t.rejected[chosen]]
        left, taken = [t for t, _ in stay], [has for _, has in stay]
    return order


def ordered_rules(docs: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES, sample_rows: int = SAMPLE_ROWS,
                  text_col: str = "text") -> tuple[Rule, ...]:
    """The rules in the order that a sample of about `sample_rows` rows calls for."""
    n = docs.count()
    chosen = docs.selectExpr(f"cast(`{text_col}` as string) as text").sample(min(1.0, sample_rows / max(n, 1)), 17)

    def trial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [pickle.dumps(trial_of(t, rules)) for t in binary_column(batch, "text")]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["trial"])

    trials = [pickle.loads(bytes(r["trial"])) for r in arrow_map(chosen, trial, "trial binary").collect()]
    return tuple(rules[i] for i in best_order(trials, len(rules)))


def judged(docs: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES, measures: tuple[str, ...] = (),
           id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row: the id, the `measures` asked for, base_failed and kept. `kept` short-circuits; measures asked for are always taken."""
    # the base rules' measures are part of the result, so they are taken anyway; the others are ordered
    order = ordered_rules(docs, tuple(r for r in rules if r not in BASE_RULES), sample_rows, text_col)
    rows = id_text(docs, id_col, text_col)
    schema = T.StructType([rows.schema["doc_id"]] + [T.StructField(m, T.LongType()) for m in measures]
                          + [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            taken: list[list[int]] = [[] for _ in measures]
            failed, kept = [], []
            for text in binary_column(batch, "text"):
                m = Measures(text)
                for values, name in zip(taken, measures):
                    values.append(getattr(m, name))
                failed.append(not passes(m, BASE_RULES))
                kept.append(not failed[-1] and passes(m, order))  # a text that fails the base rules is not kept
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(v, pa.int64()) for v in taken), pa.array(failed, pa.bool_()), pa.array(kept, pa.bool_())],
                names=schema.names)

    return arrow_map(rows, judge, schema)


def kept_rows(docs: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES, text_col: str = "text",
              sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """`docs` without the rows that a rule rejects, all columns as they were."""
    order = ordered_rules(docs, rules, sample_rows, text_col)
    names = list(docs.columns)
    text_at = f"c{names.index(text_col)}"
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([passes(Measures(t), order) for t in binary_column(batch, text_at)], pa.bool_()))

    return arrow_map(plain, keep, plain.schema).toDF(*names)
