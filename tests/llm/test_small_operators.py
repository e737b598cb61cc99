"""Edge rows and brute-force checks of operators 2 to 6 and 8 to 10."""

from __future__ import annotations

import collections
import os
import random
import struct
import zlib

import numpy as np
import pytest

from forgeline.llm import byte_level as B
from forgeline.llm import chunks as C
from forgeline.llm import decontaminate as D
from forgeline.llm import language_mix as L
from forgeline.llm import license_scan as S
from forgeline.llm import mixing as M
from forgeline.llm import ordinal_quality as O
from forgeline.llm import quality_rules as Q
from forgeline.llm import token_orc as K
from forgeline.llm import toxicity_crf as X
from forgeline.llm.common import documents
from forgeline.llm.hashing import WordHasher
from forgeline.sources.tables import read_table
from tests.conftest import SF_SMALL
from tests.llm.conftest import DOCS, EDGE_ROWS, prose


def auc(score, truth) -> float:
    score, truth = np.asarray(score, float), np.asarray(truth, bool)
    wins = (score[truth][:, None] > score[~truth][None, :]).mean() + 0.5 * (score[truth][:, None] == score[~truth][None, :]).mean()
    return float(wins)


# ------------------------------------------------------------------ 2 license scan

def test_license_scan_finds_whole_changed_and_cut_notices():
    index = S.build_index()
    apache = dict(S.TEMPLATES)["MIT"]
    texts = [
        f"intro words here\nReleased under the MIT License.\n{prose(20)}",
        "Été. licensed UNDER the apache license version 2 0",
        "Licensed under CC BY-NC 4.0. All rights reserved.",
        apache.replace("free of charge", "free of any charge").replace("merge, ", ""),
        "Licensed under the", prose(200), "", "...",
    ]
    found = S.scan([t.encode() for t in texts], index, WordHasher())
    assert [[m["license"] for m in f] for f in found] == [["MIT"], ["Apache-2.0"], ["CC-BY-NC-4.0", "Proprietary"], ["MIT"], [], [], [], []]
    assert texts[0][found[0][0]["start"]:found[0][0]["end"]] == "Released under the MIT License"
    assert texts[1][found[1][0]["start"]:found[1][0]["end"]] == "licensed UNDER the apache license version 2 0"
    assert 0.9 < found[3][0]["coverage"] < 1
    with pytest.raises(ValueError):
        S.build_index((("short", "two words"),))


def test_license_alignment_equals_brute_force():
    """Best matched count of a template against every window, by an unbanded table."""
    r = random.Random(4)
    for _ in range(60):
        template = np.array([r.randrange(12) for _ in range(r.randrange(4, 14))])
        words = list(template)
        for _ in range(r.randrange(0, 3)):
            at = r.randrange(len(words))
            r.choice([lambda: words.insert(at, 99), lambda: words.pop(at) if len(words) > 2 else None,
                      lambda: words.__setitem__(at, 98)])()
        words = np.array([50] * 3 + words + [60] * 3)
        n, m = len(template), len(words)
        best = np.zeros((n + 1, m + 1))
        best[1:, 0] = -np.arange(1, n + 1)
        for i in range(1, n + 1):
            for j in range(1, m + 1):
                hit = 2 if template[i - 1] == words[j - 1] else -1
                best[i, j] = max(best[i - 1, j - 1] + hit, best[i - 1, j] - 1, best[i, j - 1] - 1)
        matched, length, first, last = S.align(template, words, 3)
        assert 2 * matched - (length - matched) >= best[n].max() - 1
        assert 0 <= first < last <= m


def test_license_scan_finds_every_text_that_alignment_accepts():
    """Each template with one word replaced, added or left out, and with errors as dense as the rule allows, against all diagonals."""
    hasher, r = WordHasher(), random.Random(8)
    for name, notice in S.TEMPLATES:
        plain = notice.split()[:60]
        notice = " ".join(plain)
        texts = []
        for i in range(len(plain)):
            texts += [plain[:i] + ["zzz"] + plain[i + 1:], plain[:i] + ["zzz"] + plain[i:], plain[:i] + plain[i + 1:]]
        long = len(plain) > 15
        texts = r.sample(texts, 3) if long else texts
        for gap in (5, 6):
            for shift in range(1 if long else gap):
                texts += [["zzz" if i % gap == shift else w for i, w in enumerate(plain)],
                          [x for i, w in enumerate(plain) for x in ([w, "zzz"] if i % gap == shift else [w])]]
        texts = [" ".join(["of", "the", "mit", *t, *r.sample(plain, min(3, len(plain)))]).encode() for t in texts]
        for text, found in zip(texts, S.scan(texts, S.build_index(((name, notice),)), hasher)):
            template, words = hasher.hashes(notice.encode() + b"\0")[1], hasher.hashes(text + b"\0")[1]
            n = len(template)
            for diagonal in (3, 1, 5) if long else range(-n // 2, len(words) - n // 2):
                matched, length, _, _ = S.align(template, words, diagonal)
                if matched >= S.LEAST * max(n, length):
                    assert found, (name, text)
                    break
    texts = [b"Released under an MIT License.", b"Released under the MIT Licence.", b"All rights reserved. All rights reserved."]
    found = S.scan(texts, S.build_index(), hasher)
    assert [[m["license"] for m in f] for f in found] == [["MIT"], ["MIT"], ["Proprietary", "Proprietary"]]


def test_license_scan_tells_whole_notices_parts_and_relatives_apart():
    index, hasher = S.build_index(), WordHasher()
    texts = [f"{prose(5)} {notice} {prose(5)}" for _, notice in S.TEMPLATES]
    for (name, notice), found in zip(S.TEMPLATES, S.scan([t.encode() for t in texts], index, hasher)):
        assert [(m["license"], m["coverage"]) for m in found] == [(name, 1.0)], notice
    lgpl = next(t for n, t in S.TEMPLATES if n == "LGPL" and t.startswith("This program is free")).replace("program", "library")
    mit = max((t for n, t in S.TEMPLATES if n == "MIT"), key=len)
    rest = mit[mit.index(", and to permit"):]  # without the first sentence
    found = S.scan([t.encode() for t in (lgpl, rest, "Licensed under CC BY-ND 4.0.")], index, hasher)
    assert [[m["license"] for m in f] for f in found] == [["LGPL"], ["MIT"], ["CC-BY-ND-4.0"]]


def test_license_scan_edge_rows(spark, clashing_docs, empty_docs):
    assert S.licensed(clashing_docs).where("size(matches) > 0").count() == 0
    assert S.licensed(clashing_docs).count() == len(EDGE_ROWS)
    assert S.licensed(empty_docs).count() == 0


# ------------------------------------------------------------------ 3 toxicity

def test_chains_equal_the_plain_recursion():
    rng = np.random.default_rng(1)
    lengths = np.array([0, 1, 63, 64, 65, 300, 5])
    score, step = rng.normal(0, 4, lengths.sum()), np.array([[0.9, 0.1], [0.4, 0.8]])
    got, pairs = X.Chains(lengths).expected(score, step)
    want, want_pairs, at = [], np.zeros((2, 2)), 0
    for n in lengths:
        odds = [np.array([1.0, np.exp(s)]) for s in score[at:at + n]]
        at += n
        a, b = [np.array([1.0, 0.0])], [np.ones(2)]
        for o in odds:
            a.append(a[-1] @ step * o / (a[-1] @ step * o).sum())
        for o in odds[::-1]:
            b.append(step @ (o * b[-1]) / (step @ (o * b[-1])).sum())
        b = b[::-1]
        for i, o in enumerate(odds):
            joint = a[i][:, None] * step * (o * b[i + 1])[None, :]
            want_pairs += joint / joint.sum()
            want.append((a[i + 1] * b[i + 1])[1] / (a[i + 1] * b[i + 1]).sum())
    assert np.allclose(got, want, atol=1e-10) and np.allclose(pairs, want_pairs, atol=1e-8)


def toxic_rows(n: int, seed: int) -> list[tuple[int, str, int]]:
    r = random.Random(seed)
    out = []
    for i in range(n):
        words = prose(r.randrange(20, 120), r.randrange(10**6)).split()
        bad = r.random() < 0.25
        for _ in range(r.randrange(1, 6) if bad else 0):
            words.insert(r.randrange(len(words)), r.choice(["vileword", "nastyish", "nastyest"]))
        out.append((i, " ".join(words), int(bad)))
    return out


def test_toxicity_on_held_out_rows(spark, clashing_docs, empty_docs):
    rows = toxic_rows(600, 1)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    got = {r.doc_id: r for r in X.scored(docs, labels).collect()}
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i in got if got[i].held_out} == set(held)
    truth = {i: y for i, _, y in rows}
    assert auc([got[i].score for i in held], [truth[i] for i in held]) > 0.98
    assert sum(got[i].predicted == truth[i] for i in held) > 0.95 * len(held)
    text = {i: t for i, t, _ in rows}
    spans = [text[i][s.start:s.end] for i in held if truth[i] for s in got[i].spans]
    assert spans and all(w in ("vileword", "nastyish", "nastyest") for s in spans for w in s.split())
    edge = X.scored(clashing_docs, labels).collect()
    assert len(edge) == len(EDGE_ROWS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in edge)
    assert X.scored(empty_docs, labels).count() == 0
    none = X.scored(docs, labels.limit(0)).first()
    assert none.predicted == 0 and none.spans == []


def test_toxicity_on_the_given_tables(spark):
    from tests.helpers import duck

    sf = SF_SMALL.replace("0.001", "0.1")
    docs, labels = documents(spark, sf), read_table(spark, sf, "labels")
    got = {r.doc_id: r for r in X.scored(docs, labels).select("doc_id", "held_out", "score").collect()}
    rows = [(got[i].score, y) for i, y in duck("SELECT doc_id, toxic FROM labels", sf)[1] if got[i].held_out]
    assert auc([s for s, _ in rows], [y for _, y in rows]) > 0.93


# ------------------------------------------------------------------ 4 language

def test_language_on_held_out_rows(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    rows = L.identified(documents(spark, sf)).join(documents(spark, sf).select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)


def test_mixture_recovers_proportions():
    texts = [b"aaa aab aba abb baa " * 20, b"xyz yzx zxy xxz zyx " * 20]
    table = np.zeros((L.KINDS, 2))
    for lang, t in enumerate(texts):
        _, kind, n = L.trigrams([t])
        table[kind, lang] = n / n.sum()
    model = (1 - L.UNSEEN) * table + L.UNSEEN / L.KINDS
    share = L.mixtures([texts[0], texts[1], texts[0] * 3 + texts[1], b"", b"qqq"], model)
    assert share[0].tolist() == [1, 0] and share[1].tolist() == [0, 1]
    assert abs(share[2][0] - 0.75) < 0.03 and share[2][1] > 0
    # plain expectation-maximisation run to its end gives the same shares
    _, kind, n = L.trigrams([texts[0] * 3 + texts[1]])
    assert np.allclose(plain_em(model[kind], n, np.array([0.5, 0.5]))[0], share[2], atol=2e-3)


def plain_em(likelihood, n, pi):
    """Shares after 3,000 rounds and the log-likelihood."""
    for _ in range(3_000):
        part = likelihood * pi
        pi = (part / part.sum(axis=1, keepdims=True) * n[:, None]).sum(axis=0) / n.sum()
    return pi, float(n @ np.log(likelihood @ pi))


def test_language_set_has_the_best_penalised_likelihood_on_its_path():
    """Mixed texts of languages that share trigrams: sets and shares equal those of plain EM at convergence, step by step."""
    r = np.random.default_rng(4)
    languages = 4
    table = r.dirichlet(np.full(60, 0.4), languages)
    table[1] = 0.7 * table[0] + 0.3 * table[1]  # close relatives
    kinds = np.array([L.trigrams([f"{chr(97 + i % 26)}{chr(97 + i // 26)}q".encode()])[1][0] for i in range(60)])
    model = np.full((L.KINDS, languages), 1e-7)
    model[kinds] = table.T
    seen = set()
    for trial in range(12):
        mix = r.dirichlet(np.full(languages, 0.5))
        mix = np.where(mix < 0.1, 0, mix)
        draws = r.multinomial(300 if trial % 2 else 40, (mix @ table) / mix.sum())
        text = " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}q" for i in np.repeat(np.arange(60), draws)).encode()
        share = L.mixtures([text], model, penalty=1.0)[0]
        _, kind, n = L.trigrams([text])
        pi, likely = plain_em(model[kind], n, np.full(languages, 1 / languages))
        while np.count_nonzero(pi) > 1:
            fewer = np.where(np.arange(languages) == np.where(pi > 0, pi, np.inf).argmin(), 0, pi)
            fewer, less = plain_em(model[kind], n, fewer / fewer.sum())
            if likely - less > np.log(n.sum() + 1):
                break
            pi, likely = fewer, less
        assert ((share > 0) == (pi > 0)).all() and np.allclose(share, pi, atol=0.02)
        seen.add(int(np.count_nonzero(pi)))
    assert len(seen) > 1


def test_shares_do_not_depend_on_other_texts_of_the_slice():
    r = np.random.default_rng(2)
    model = r.dirichlet(np.full(L.KINDS, 0.01), 3).T + 1e-9
    texts = [prose(n, n).encode() for n in (3, 50, 400, 7)]
    together = L.mixtures(texts, model)
    assert np.allclose(together, [L.mixtures([t], model)[0] for t in texts], atol=1e-12)


def test_language_edge_rows(spark, clashing_docs, empty_docs):
    got = {r.doc_id: r for r in L.identified(clashing_docs).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 11)] == ["und"] * 4 and got[11].score == 0
    assert all(0 <= r.score <= 1 for r in got.values()) and got[10].lang_pred in ("en", "de", "fr")
    assert L.identified(empty_docs).count() == 0
    unknown = L.identified(clashing_docs.withColumn("lang", clashing_docs.lang.substr(1, 0)).selectExpr(
        "doc_id", "text", "cast(null as string) as lang"))
    assert {r.lang_pred for r in unknown.collect()} == {"und"}


# ------------------------------------------------------------------ 5 quality rules

def brute_measures(text: str | None) -> tuple:
    import regex

    text = text or ""
    w = regex.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if regex.search(r"[^\x20\x09-\x0D]", x)]
    windows = collections.Counter(zip(w, w[1:], w[2:]))
    hit = {i + j for i, x in enumerate(zip(w, w[1:], w[2:])) if windows[x] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def test_rules_on_edge_rows(spark, clashing_docs, empty_docs):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = collections.Counter(tuple(r[n] for n in names) + (r.kept,) for r in Q.judged(clashing_docs, measures=names).collect())
    want = collections.Counter()
    for row in EDGE_ROWS:
        m = brute_measures(row[1])
        want[(*m, Q.passes(Q.Measures((row[1] or "").encode()), Q.DEFAULT_RULES))] += 1
    assert got == want
    kept = Q.kept_rows(clashing_docs)
    assert kept.columns == clashing_docs.columns and kept.count() == sum(n for k, n in want.items() if k[-1])
    assert Q.judged(empty_docs).count() == 0 and Q.kept_rows(empty_docs).count() == 0


@pytest.mark.parametrize("text", ["", "a a a a a a", "x\ny\nx\n\n \nx", "é é é é", "a b c a b c d", "|<> # $"])
def test_measures_equal_brute_force(text):
    m = Q.Measures(text.encode())
    assert (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words) == brute_measures(text)


def test_rule_order_puts_cheap_rejections_first_and_keeps_the_verdict(spark):
    def slow(m):
        for _ in range(300):
            m.text.split()
        return m.n_words > 10**9

    rules = (Q.Rule("slow", slow), Q.Rule("few", lambda m: m.n_words < 50))
    docs = documents(spark, SF_SMALL)
    assert [r.name for r in Q.ordered_rules(docs, rules)] == ["few", "slow"]
    assert Q.kept_rows(docs, rules).count() == Q.kept_rows(docs, rules[::-1]).count()


def test_order_is_the_cheapest_on_the_sample():
    """Against all orders, with made-up costs: a shared measure is paid once, a rejection counts among the documents still there."""
    import itertools

    # rule 0 asks for a dear measure that rule 2 shares; rule 1 is cheap and rejects half of what 0 rejects
    def sample(rejected):
        return Q.Trial({"dear": 10.0, "cheap": 1.0, "other": 4.0}, rejected, [0.1, 0.1, 0.1], [{"dear"}, {"cheap"}, {"dear", "other"}])

    trials = [sample([i % 4 == 0, i % 8 < 3, i % 5 == 0]) for i in range(40)]
    order = Q.best_order(trials, 3)
    assert Q.spent(trials, order) == min(Q.spent(trials, list(o)) for o in itertools.permutations(range(3)))
    assert order[0] == 1


def test_timed_measures_count_shared_work_once():
    m = Q.TimedMeasures(b"a b c " * 20_000)
    assert m.n_words == 60_000 and m.n_repeat_words == 60_000
    assert set(m.seconds) == {"n_words", "words", "n_repeat_words"} and m.seconds["words"] > m.seconds["n_words"]
    trial = Q.trial_of(b"a b c " * 2_000, Q.DEFAULT_RULES)
    assert trial.rejected == [r.rejects(Q.Measures(b"a b c " * 2_000)) for r in Q.DEFAULT_RULES]
    assert "words" in trial.asked[0] and "words" in trial.asked[1]


# ------------------------------------------------------------------ 6 mixing

def test_mix_follows_its_targets(spark):
    r = random.Random(3)
    rows = [(i, prose(r.randrange(1, 60), i), None, "hot" if i % 3 == 0 else f"s{i % 5}" if i % 7 else None, 0) for i in range(900)]
    docs = spark.createDataFrame(rows, DOCS)
    got = M.copies_frame(docs).collect()
    by_source = collections.defaultdict(list)
    for x in got:
        by_source[x.source].append(x)
        assert x.size == len(x.text.split()) and 0 <= x.taken <= 2 * x.size
    total = sum(x.size for x in got)
    assert abs(sum(v[0].target for v in by_source.values()) - 1.5 * total) < 1e-6 * total
    order = sorted((s for s in by_source if s is not None)) + [None]
    level = [by_source[s][0].target / (3, 1, 2)[i % 3] for i, s in enumerate(order) if by_source[s][0].target < 2 * by_source[s][0].source_size]
    assert max(level) - min(level) < 1e-6 * max(level)
    for s, v in by_source.items():
        assert sum(x.size for x in v) == v[0].source_size
        assert abs(sum(x.taken for x in v) - v[0].target) <= max(x.size for x in v)
    again = M.copies_frame(docs.repartition(11)).collect()
    assert sorted((x.doc_id, x.taken) for x in again) == sorted((x.doc_id, x.taken) for x in got)
    mixed = M.emit(docs).collect()
    assert collections.Counter(x.doc_id for x in mixed) == collections.Counter({x.doc_id: x.copies for x in got if x.copies})


def test_mix_edge_rows(spark, clashing_docs, edge_docs, empty_docs):
    mixed = M.emit(clashing_docs)
    assert mixed.columns == clashing_docs.columns
    assert sorted(str(x.doc_id) for x in mixed.collect()) == sorted(str(x.doc_id) for x in M.emit(edge_docs).collect())
    assert M.copies_frame(clashing_docs).count() == len(EDGE_ROWS)
    assert M.copies_frame(empty_docs).count() == 0 and M.emit(empty_docs).count() == 0
    blank = spark.createDataFrame([(1, None, None, "a", 0), (2, " ", None, None, 0)], DOCS)
    assert [x.taken for x in M.copies_frame(blank).collect()] == [0, 0]


# ------------------------------------------------------------------ 8 decontamination

def brute_hits(text: str | None, items: list[tuple[str, str]]) -> tuple[set[int], set[str]]:
    w = D.words_of((text or "").encode())
    hit, found = set(), set()
    for name, item in items:
        v = D.words_of(item.encode())
        n = min(len(v), D.WINDOW)
        windows = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if v else set()
        for i in range(len(w) - n + 1 if windows else 0):
            if tuple(w[i:i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(name)
    return hit, found


def test_mix_with_columns_of_any_name(spark, edge_docs):
    """Names of inner columns, of outputs, and names that need quoting."""
    names = ("_size", "_src", "_bucket", "_number", "_before", "_target", "f_src", "src", "bucket", "before", "number", "rate", "u", "g_src", "c0", "c1",
             "Copies", "a b", "x.y")
    wide = edge_docs.selectExpr("*", *[f"{i} as `{n}`" for i, n in enumerate(names)])
    got = M.copies_frame(wide)
    assert got.columns == [c for c in wide.columns if c != "Copies"] + ["size", "source_size", "target", "copies", "taken"]
    pick = ["doc_id", "size", "source_size", "target", "taken"]
    assert sorted(map(str, got.select(*pick).collect())) == sorted(map(str, M.copies_frame(edge_docs).select(*pick).collect()))
    assert M.emit(wide).columns == wide.columns


@pytest.mark.parametrize("seed", range(8))
def test_automaton_equals_brute_force(seed):
    """A three-letter alphabet, so that states are cloned and windows repeat; items shorter than the window too."""
    r = random.Random(seed)
    items = [(str(i), " ".join(r.choice("abc") for _ in range(r.choice([1, 3, 8, 12, 13, 14, 30])))) for i in range(12 if seed % 2 else 3)]
    items += [("empty", "..."), ("twin", items[0][1])]
    texts = [" ".join(r.choice("abcabcabcd") for _ in range(r.randrange(0, 80))) for _ in range(30)]
    texts += [f"x {items[1][1]} y {items[2][1]}"]
    automaton = D.ItemAutomaton([(n, D.words_of(t.encode())) for n, t in items])
    for t in texts:
        spans, found = automaton.matches(D.words_of(t.encode()))
        hit, names = brute_hits(t, items)
        assert {i for a, b in spans for i in range(a, b)} == hit and found == names
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


@pytest.mark.parametrize("block_words", [25, 10**6])
def test_contamination_in_blocks_and_removal(spark, block_words):
    """One pass, or several over blocks of the benchmark with the marked documents written between."""
    items = [(i, prose(20 + i, 50 + i)) for i in range(6)] + [(6, "three small words"), (7, None), (None, prose(15, 90))]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = [(1, prose(200)), (2, prose(200) + " " + items[0][1]), (3, items[1][1].upper()), (4, None), (5, ""),
            (6, prose(400, 2) + "\nThree, SMALL words! " + prose(100, 4)), (7, items[8][1])]
    docs = spark.createDataFrame([(i, t, None, None, len(t or "")) for i, t in rows], DOCS)
    named = [(str(i), t or "") for i, t in items]
    for r in D.contamination(docs, bench, block_words=block_words).collect():
        hit, names = brute_hits(dict(rows)[r.doc_id], named)
        assert r.n_hit == len(hit) and r.items == sorted(names - {"None"})
    left = {r.doc_id: r for r in D.removed(docs, bench, chars_col="n_chars", block_words=block_words).collect()}
    assert sorted(left) == [1, 4, 5, 6] and left[4].text is None
    assert left[1].text == rows[0][1] and "SMALL" not in left[6].text and left[6].n_chars == len(left[6].text)
    assert left[6].text == prose(400, 2) + "\n! " + prose(100, 4)
    assert D.removed(docs, bench.limit(0)).count() == len(rows)


def test_a_benchmark_beyond_the_bounds(spark, monkeypatch):
    bench = spark.createDataFrame([(1, prose(30, 2)), (2, prose(500, 3))], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, prose(40, 9) + " " + prose(30, 2))], "doc_id bigint, text string")
    monkeypatch.setattr(D, "MOST_ITEM_WORDS", 400)
    with pytest.raises(ValueError, match="500 words"):
        D.contamination(docs, bench)
    monkeypatch.setattr(D, "MOST_ITEM_WORDS", 1_000)
    sent = []
    build = D.automata
    monkeypatch.setattr(D, "automata", lambda items, low, high, window: sent.append((low, high)) or build(items, low, high, window))
    assert D.contamination(docs, bench, block_words=60, pass_blocks=3).first().n_hit == 30
    assert sent == [(0, 3), (3, 6), (6, 9)]


def test_decontamination_edge_rows(spark, clashing_docs, empty_docs):
    bench = read_table(spark, SF_SMALL, "benchmark")
    assert D.removed(clashing_docs, bench).columns == clashing_docs.columns
    assert D.removed(clashing_docs, bench).count() == len(EDGE_ROWS)
    assert D.digest(D.contamination(clashing_docs, bench)).where("contaminated or n_hit > 0").count() == 0
    assert D.contamination(empty_docs, bench).count() == 0 and D.removed(empty_docs, bench).count() == 0


# ------------------------------------------------------------------ 9 ordinal quality

def test_grades_are_ordered_and_found_on_held_out_rows(spark, clashing_docs, empty_docs):
    r = random.Random(7)
    rows = []
    for i in range(900):
        g = r.randrange(3)
        words = [w + ("###" if g == 0 and r.random() < 0.5 else "!" if g == 1 and r.random() < 0.4 else "") for w in prose(60, i).split()]
        rows.append((i, " ".join(words), g))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(g > 0), int(g == 1)) for i, _, g in rows], "doc_id bigint, quality int, toxic int")
    got = {x.doc_id: x for x in O.graded(docs, labels).collect()}
    held = [(got[i], g) for i, _, g in rows if got[i].held_out]
    for k in (1, 2):
        assert auc([x.expected_grade for x, _ in held], [g >= k for _, g in held]) > 0.97
    assert all(x.tails[0] >= x.tails[1] and abs(sum(x.tails) - x.expected_grade) < 1e-9 for x in got.values())
    assert O.graded(clashing_docs, labels).count() == len(EDGE_ROWS)
    assert O.graded(empty_docs, labels).count() == 0
    assert O.graded(docs, labels.limit(0)).where("expected_grade > 0.001").count() == 0


def test_ordinal_gradient_raises_the_likelihood():
    rows = [(b"good fine words", 2), (b"odd words", 1), (b"bad ### words", 0)] * 30
    few, many = (O.fit(rows, {0: 30, 1: 30, 2: 30}, steps=s) for s in (1, 60))
    grade = np.array([g for _, g in rows])

    def likelihood(m):
        tails = m.tails(O.scores([t for t, _ in rows], m.weights, WordHasher(O.SPACED)))
        p = np.column_stack([1 - tails[:, 0], tails[:, 0] - tails[:, 1], tails[:, 1]])
        return np.log(p[np.arange(len(rows)), grade]).mean()

    assert likelihood(many) > likelihood(few) and likelihood(many) > -0.2 and np.all(np.diff(many.thresholds) > 0)


def test_ordinal_scores_equal_a_plain_cumulative_link():
    """Expected grade and tails of each text from its own features, one by one."""
    rows = [(prose(30, i).encode() + b" ###" * (i % 3), i % 3) for i in range(60)]
    m = O.fit(rows, {0: 20, 1: 20, 2: 20})
    texts = [t for t, _ in rows] + [b"", b"  ", b"one", prose(2_000, 9).encode()]
    tails = m.tails(O.scores(texts, m.weights, WordHasher(O.SPACED)))
    for text, tail in zip(texts, tails):
        features, doc, _ = O._features([text], WordHasher(O.SPACED))
        words = max(len(text.split()), 1)
        z = sum(float(m.weights[f[j]]) for j in range(len(doc)) for f in features) / words
        want = [1 - 1 / (1 + np.exp(-(b - z))) for b in m.thresholds]
        assert np.allclose(tail, want, atol=1e-5)


def test_ordinal_gradient_equals_differences():
    """The gradient of weights and bounds against numeric differences of the penalised log-likelihood."""
    r = np.random.default_rng(3)
    rows = [(prose(12, i).encode(), i % 3) for i in range(9)]
    problem = O.Problem.of(rows, r.uniform(0.5, 2, 9), 3)
    used = np.unique(problem.features)
    weights = np.zeros(1 << O.BITS)
    weights[used] = r.normal(0, 0.5, len(used))
    first, gaps = -0.3, np.array([0.2])
    by_weight, by_bound = problem.gradient(weights, first, gaps)

    def value(w, f, g):
        return problem.likelihood(w, f, g) - 0.5e-4 * float((w**2).sum())

    for at in r.choice(used, 12, replace=False):
        step = np.zeros_like(weights)
        step[at] = 1e-5
        assert abs((value(weights + step, first, gaps) - value(weights - step, first, gaps)) / 2e-5 - by_weight[at]) < 1e-5
    e = 1e-5
    assert abs((value(weights, first + e, gaps) - value(weights, first - e, gaps)) / (2 * e) - by_bound[0]) < 1e-5
    assert abs((value(weights, first, gaps + e) - value(weights, first, gaps - e)) / (2 * e) - by_bound[1]) < 1e-5


def test_quality_on_the_given_tables(spark):
    from tests.helpers import duck

    sf = SF_SMALL.replace("0.001", "0.1")
    got = {r.doc_id: r for r in O.graded(documents(spark, sf), read_table(spark, sf, "labels")).collect()}
    rows = [(got[i].expected_grade, q) for i, q in duck("SELECT doc_id, quality FROM labels", sf)[1] if got[i].held_out]
    assert auc([s for s, _ in rows], [q for _, q in rows]) > 0.97


# ------------------------------------------------------------------ 10 token ids

TRICKY = ["", " a", "a  b", "a  ", "don't we'll 's x's", "a <|endoftext|> b", "x\n y", "tail ", " ", "a, b; c?! d.e f5 5. été, ñ!",
          "\n", "a 'tis, ...", "漢字 текст  x", "a　 b", "it's' \"q\" (p) [x] a_b _c c_ d'", "é. é' ß, ¿qué?", "x\ty z"]


def test_chunks_equal_whole_texts(spark, monkeypatch):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(B.vocabulary_path())
    texts = TRICKY + [prose(n, n) for n in range(1, 60)] + ["", "a b" + "\u2003 c \u2581 d\u00a0 e"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    for known in (200_000, 20):  # all frequent chunks in the table, or few
        monkeypatch.setattr("forgeline.llm.chunks.KNOWN", known)
        got = {r.doc_id: r for r in K.token_index(docs).collect()}
        for i, t in enumerate(texts):
            ids = [*tokenizer.encode(t, add_special_tokens=False).ids, K.END_ID]
            assert (got[i].n_tokens, got[i].ids_crc32) == (len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))), t


@pytest.mark.parametrize("change", [{"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "Whitespace"}}])
def test_other_vocabularies_are_encoded_whole(spark, tmp_dir, change):
    import json

    from tokenizers import Tokenizer

    with open(B.vocabulary_path(), encoding="utf-8") as f:
        text = json.dumps(json.load(f) | change)
    path = f"{tmp_dir}/other-{list(change)[0]}.json"
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    assert not C.byte_level_cuts(text) and not B.ByteLevel(text).cut and not C.byte_level_cuts("[]")
    tokenizer = Tokenizer.from_str(text)
    docs = spark.createDataFrame(list(enumerate(TRICKY)), "doc_id bigint, text string")
    got = {r.doc_id: r.ids_crc32 for r in K.token_index(docs, tokenizer_path=path).collect()}
    for i, t in enumerate(TRICKY):
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, K.END_ID]
        assert got[i] == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def test_stripes_and_row_groups_are_skipped(spark, tmp_dir, monkeypatch):
    """A lookup reads a part of the rows, or none; repeated runs of ids take next to no room."""
    import glob

    from pyarrow import orc

    monkeypatch.setitem(K.ORC_OPTIONS, "orc.stripe.size", "65536")
    monkeypatch.setitem(K.ORC_OPTIONS, "orc.rows.between.memory.checks", "500")
    rows = [(2 * i, prose(150, i)) for i in range(6_000)]
    path = f"{tmp_dir}/striped"
    K.write_ids(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), path)
    files = [orc.ORCFile(f) for f in glob.glob(f"{path}/*.orc")]
    assert max(f.nstripes for f in files) > 1
    listed = K.find(spark, path, [200])
    assert [r.doc_id for r in listed.collect()] == [200]
    # rows that the scan hands on: a row group or a batch of the one stripe; none where the Bloom filter and the index rule an id out
    def scanned(df):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan()
        while not plan.nodeName().startswith("Scan"):
            plan = (plan.executedPlan() if plan.nodeName().startswith("Adaptive") else plan.children().head())
        return plan.metrics().get("numOutputRows").get().value()

    assert scanned(K.find(spark, path, [200])) < len(rows) / 2
    assert scanned(K.find(spark, path, [20_000])) == 0
    run = max(os.path.getsize(f) for f in glob.glob(f"{path}/*.orc"))
    same = f"{tmp_dir}/same"
    K.write_ids(spark.createDataFrame([(i, "the " * 150) for i in range(6_000)], "doc_id bigint, text string"), same)
    assert max(os.path.getsize(f) for f in glob.glob(f"{same}/*.orc")) < run / 10


def test_token_files_round_trip(spark, clashing_docs, empty_docs, tmp_dir):
    from pyarrow import orc
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(B.vocabulary_path())
    rows = [(i, t) for i, t, *_ in EDGE_ROWS] + [(100 + i, t) for i, t in enumerate(TRICKY)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    path = f"{tmp_dir}/ids"
    got = K.token_index(docs, path).orderBy("start").collect()
    want, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, K.END_ID]
        want.append((i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    assert [tuple(r) for r in got] == want
    found = K.find(spark, path, [104, 8])
    assert sorted(r.doc_id for r in found.collect()) == [8, 104] and K.find(spark, path, []).count() == 0
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().executedPlan().toString()
    import glob

    files = [orc.ORCFile(f) for f in glob.glob(f"{path}/*.orc")]
    assert files and all(f.nstripes >= 1 for f in files if f.nrows)
    assert K.token_index(clashing_docs).count() == len(EDGE_ROWS)
    assert K.token_index(empty_docs).count() == 0


def test_token_ids_are_made_a_part_of_a_batch_at_a_time():
    """What a worker holds follows the slice, not the batch it was sent."""
    import pyarrow as pa

    encoder = B.byte_level(B.vocabulary_text())
    texts = [*(prose(900, i % 7) for i in range(2_000)), None, "", prose(150_000, 8), "a b"]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([0] * len(texts), pa.int32()), pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["part", "doc_id", "text"])
    segments = C.Segments(lambda c: B.id_rows(encoder.ids(c)))
    got, at, rows = [], 0, 0
    for out in K.id_batches(iter([batch]), segments, encoder.cut, K.END_ID):
        size = [len((texts[i] or "").encode()) for i in out.column(1).to_pylist()]
        assert out.num_rows == 1 or sum(size) <= K.EXPANDED_BYTES
        assert out.column(1).to_pylist() == list(range(rows, rows + out.num_rows)) and out.column(2)[0].as_py() == at
        got += [ids.values.to_numpy() for ids in out.column(4)]
        at, rows = out.column(3)[-1].as_py(), rows + out.num_rows
    assert rows == len(texts) and at == sum(map(len, got))
    for i in (0, 6, 1_999, 2_000, 2_001, 2_002, 2_003):
        assert np.array_equal(got[i], [*encoder.tokenizer.encode(texts[i] or "", add_special_tokens=False).ids, K.END_ID])
    # a part of the texts of a slice equals that part of all
    chunked = C.Chunked(pa.array(["a b", "", "c a", "b"]), True)
    values, ends = np.arange(100), np.arange(0, 100, 3)
    whole, bounds = chunked.ragged(values, ends)
    for a, b in ((0, 2), (1, 1), (1, 4), (3, 4)):
        some, inner = chunked.ragged(values, ends, a, b)
        assert np.array_equal(some, whole[bounds[a]:bounds[b]]) and np.array_equal(inner, bounds[a:b + 1] - bounds[a])
