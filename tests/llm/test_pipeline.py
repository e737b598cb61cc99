"""The pipeline against a plain Python version of its stages."""

from __future__ import annotations

import hashlib
import math
import struct
import zlib

import corpus_pipeline as C
from forgeline.llm import byte_level as B
from forgeline.llm import decontaminate as D
from forgeline.llm import mixing as M
from forgeline.llm import quality_rules as Q
from forgeline.llm import token_orc as K
from forgeline.llm.common import documents
from forgeline.sources.tables import read_table
from tests.conftest import SF_SMALL
from tests.llm.conftest import DOCS, EDGE_ROWS
from tests.llm.test_probminhash import brute_groups
from tests.llm.test_small_operators import brute_hits


def plain_pipeline(docs: list[tuple], bench: list[tuple]) -> list[tuple]:
    """(doc_id, start, n_tokens, ids_crc32) for (doc_id, text, source) rows."""
    from tokenizers import Tokenizer

    rows = [r for r in docs if Q.passes(Q.Measures((r[1] or "").encode()), Q.DEFAULT_RULES)]
    group = brute_groups([(i, t) for i, t, _ in rows])
    rows = sorted({r for r in rows if group[r[0], r[1]] == r[0]}, key=str)
    items = [(str(i), t or "") for i, t in bench]
    cut = []
    for i, t, s in rows:
        hit, _ = brute_hits(t, items)
        if not hit:
            cut.append((i, t, s))
        elif 20 * len(hit) < len(D.words_of(t.encode())):
            text, spans = t.encode(), []
            for at in sorted(hit):
                if spans and spans[-1][1] == at:
                    spans[-1] = (spans[-1][0], at + 1)
                else:
                    spans.append((at, at + 1))
            cut.append((i, D._without(text, spans).decode(), s))
    size = lambda t: len(t.encode().split())
    sources = sorted({s for *_, s in cut if s is not None}) + ([None] if any(s is None for *_, s in cut) else [])
    total = {s: sum(size(t) for _, t, x in cut if x == s) for s in sources}
    weight = {s: M.WEIGHTS[k % 3] for k, s in enumerate(sources)}
    capped: set = set()
    while True:
        level = (1.5 * sum(total.values()) - sum(2 * total[s] for s in capped)) / sum(w for s, w in weight.items() if s not in capped)
        over = {s for s in sources if s not in capped and level * weight[s] > 2 * total[s]}
        if not over:
            break
        capped |= over
    tokenizer, out = Tokenizer.from_file(B.vocabulary_path()), []
    for s in sources:
        rate = (2.0 * total[s] if s in capped else level * weight[s]) / total[s]
        u = int(hashlib.md5((M.SEED + (s or "")).encode()).hexdigest()[:4], 16) / 65536
        bucket = lambda i: int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) % M.BUCKETS
        for k, (i, t, _) in enumerate(sorted((r for r in cut if r[2] == s), key=lambda r: (size(r[1]), bucket(r[0]), r[0])), 1):
            copies = math.floor(u + rate * k) - math.floor(u + rate * (k - 1))
            ids = [*tokenizer.encode(t, add_special_tokens=False).ids, K.END_ID]
            out += [(i, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))] * copies
    start, rows = 0, []
    for i, n, crc in sorted(out):
        rows.append((i, start, n, crc))
        start += n
    return rows


def test_pipeline_equals_the_plain_version(spark):
    docs = [(r.doc_id, r.text, r.source) for r in documents(spark, SF_SMALL).collect()]
    bench = [(r.item_id, r.text) for r in read_table(spark, SF_SMALL, "benchmark").collect()]
    got = C.run(spark, SF_SMALL).select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("start").collect()
    want = plain_pipeline(docs, bench)
    assert len(want) > 50 and [tuple(r) for r in got] == want


def test_stages_keep_columns_and_take_edge_rows(spark, clashing_docs, empty_docs):
    assert [n for n, _ in C.STAGES] == ["quality_rules", "near_dedup", "decontaminate", "mix", "token_orc"]
    for docs in (clashing_docs, empty_docs):
        names = docs.columns
        for _, stage in C.STAGES[:-1]:
            docs = stage(spark, docs, SF_SMALL)
            assert docs.columns == names
        assert C.STAGES[-1][1](spark, docs, SF_SMALL).count() == docs.count()


def test_every_stage_takes_effect(spark):
    rows = [r for r in EDGE_ROWS if r[0] is not None]
    docs = spark.createDataFrame(rows, DOCS)
    kept = C.apply_quality_rules(spark, docs, SF_SMALL)
    assert sorted(r.doc_id for r in kept.collect()) == [4, 5, 6, 6, 10]
    one = C.drop_near_duplicates(spark, kept, SF_SMALL)
    assert sorted(r.doc_id for r in one.collect()) == [4, 6, 10]
