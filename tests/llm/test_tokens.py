"""Operators 12 and 13 against the libraries and a plain alignment."""

from __future__ import annotations

import collections
import hashlib
import random

import pytest
from tokenizers import Tokenizer

from forgeline.llm import byte_level as B
from forgeline.llm import chunks as C
from forgeline.llm import sentence_pieces as S
from forgeline.llm import token_alignment as T
from tests.llm.conftest import EDGE_ROWS, prose

PARTS = [" ", "  ", "a", "b", "▁", "\n", "\t", "é", "日", "　", " ", " ", ".", "<0x41>", "<s>", "</s>", "<unk>", "\x00", "\U0001F600",
         "xyzzy", "the", "\x85", "​", "1", "�", "́", "'s", "'", "<|endoftext|>", "====", "unbelievable", "ß", "ж", "!?"]


def odd_texts(n: int, seed: int) -> list[str | None]:
    r = random.Random(seed)
    return ["".join(r.choice(PARTS) for _ in range(r.randrange(13))) for _ in range(n)] + [None, "", " ", "  ", "▁", "▁▁ ", "=" * 3000, prose(300)]


@pytest.fixture(scope="module")
def odd_docs(spark):
    texts = odd_texts(1500, 5)
    return texts, spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4).cache()


# ------------------------------------------------------------------ 13 sentence pieces

@pytest.mark.parametrize("known", [200_000, 30])
def test_ids_and_texts_equal_the_library(odd_docs, monkeypatch, known):
    monkeypatch.setattr("forgeline.llm.chunks.KNOWN", known)
    monkeypatch.setattr("forgeline.llm.chunks.SLICE_BYTES", 1000)
    texts, docs = odd_docs
    library = S.processor_of(S.model_bytes())
    got = {r.doc_id: r for r in S.decoded(S.encoded(docs)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = library.encode(t or "")
        assert (got[i].ids, got[i].text) == (ids, library.decode(ids)), t


def test_any_ids_decode_as_in_the_library(spark):
    r = random.Random(3)
    common = [0, 1, 2, 3, 68, 230, 198, 259, 260, 29871, 31999, 32005, -3]
    lists = [[r.choice([*common, r.randrange(32_000), r.randrange(3, 259)]) for _ in range(r.randrange(7))] for _ in range(3000)] + [None, []]
    rows = spark.createDataFrame(list(enumerate(lists)), "doc_id bigint, ids array<int>").repartition(3)
    library = S.processor_of(S.model_bytes())
    for x in S.decoded(rows).collect():
        assert x.text == library.decode([i for i in lists[x.doc_id] or [] if 0 <= i < 32_000])


def test_a_model_whose_pieces_may_cross_is_segmented_whole(odd_docs, tmp_dir):
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto.FromString(S.model_bytes())
    model.pieces[300].piece = "e▁t"
    path = f"{tmp_dir}/crossing.model"
    with open(path, "wb") as f:
        f.write(model.SerializeToString())
    assert C.front_mark_cuts(S.model_bytes()) and not C.front_mark_cuts(S.model_bytes(path))
    library = SentencePieceProcessor(model_file=path)
    texts, docs = odd_docs
    for r in S.encoded(docs, path).collect():
        assert r.ids == library.encode(texts[r.doc_id] or "")


def test_piece_digest_edge_rows(clashing_docs, empty_docs):
    library = S.processor_of(S.model_bytes())
    got = sorted(S.digest(S.decoded(S.encoded(clashing_docs))).collect(), key=str)
    want = []
    for i, t, *_ in EDGE_ROWS:
        ids = library.encode(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert [tuple(r) for r in got] == sorted(want, key=lambda w: f"Row(doc_id={w[0]}, n_tokens={w[1]}, ids_sha256='{w[2]}'")
    assert S.digest(S.decoded(S.encoded(empty_docs))).count() == 0


# ------------------------------------------------------------------ 12 alignment of two tokenizers

def plain_groups(texts: list[str | None]) -> list[list[tuple[list[int], list[int]]]]:
    """Per text the groups between offsets where tokens of both end."""
    tokenizer, library = Tokenizer.from_file(B.vocabulary_path()), S.processor_of(S.model_bytes())
    tokenizer.encode_special_tokens = True
    bytes_a = B.ByteLevel(B.vocabulary_text(), True).token_bytes()
    out = []
    for t in texts:
        out.append([])
        a, b = (tokenizer.encode(f" {t}", add_special_tokens=False).ids, library.encode(t)) if t else ([], [])
        parts = [bytes_a[i] for i in a], [bytes([int(library.id_to_piece(i)[3:5], 16)]) if library.is_byte(i) else
                                          library.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not t or any(b"".join(p) != f" {t}".encode() for p in parts):
            continue
        ends = [[sum(map(len, p[:i + 1])) for i in range(len(p))] if len(p) < 2000 else None for p in parts]
        for k, p in enumerate(parts):
            if ends[k] is None:
                total, ends[k] = 0, []
                for x in p:
                    total += len(x)
                    ends[k].append(total)
        last = [0, 0]
        both = set(ends[1])
        for end in [e for e in ends[0] if e in both]:
            to = ends[0].index(end, last[0]) + 1, ends[1].index(end, last[1]) + 1
            out[-1].append((a[last[0]:to[0]], b[last[1]:to[1]]))
            last = to
    return out


def plain_report(texts: list[str | None]) -> list[tuple]:
    groups = plain_groups(texts)
    held = collections.Counter()
    for g in groups:
        held.update({(x, y) for a, b in g for x in a for y in b})
    best = collections.Counter()
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for g in groups:
        links = [(x, y) for a, b in g for x in a for y in b]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(links), sum(held[p] == best[p[0]] for p in links),
                    sum(held[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return out


def test_divide_and_conquer_finds_every_shared_cut():
    r = random.Random(1)
    for n in [1, 2, 3, 10, 60, 400]:
        for share in (0.0, 0.1, 0.5, 1.0):
            a = sorted(r.sample(range(2 * n + 2), n))
            b = sorted({x for x in a if r.random() < share} | set(r.sample(range(2 * n + 2), max(1, n // 2))))
            a, b = [*a, 3 * n + 5], [*b, 3 * n + 5]
            got = T.groups_of(a, b)
            shared = sorted(set(a) & set(b))
            assert [a[g[1] - 1] for g in got] == shared == [b[g[3] - 1] for g in got]
            assert got[0][::2] == (0, 0) and all(x[1] == y[0] and x[3] == y[2] for x, y in zip(got, got[1:]))


@pytest.mark.parametrize("sent", [500_000, 300, 0])
def test_link_report_equals_a_plain_one(odd_docs, sent):
    """All counts sent, a part of them, or none: the rest by a shuffle."""
    texts, docs = odd_docs
    want = plain_report(texts)
    got = T.link_report(docs, sent_pairs=sent).collect()
    assert len(got) == len(texts) and all(tuple(r)[1:] == want[r.doc_id] for r in got)


def test_groups_spell_the_text(odd_docs):
    texts, docs = odd_docs
    library = S.processor_of(S.model_bytes())
    for r in T.aligned(docs).collect():
        if r.n_a:
            groups = [g.split("|") for g in r.groups.split(";")]
            ids = [int(i) for _, b in groups for i in b.split(",")]
            assert len(groups) == r.n_groups and library.decode(ids) == texts[r.doc_id]
            assert sum(r.times) == r.n_links == sum(len(a.split(",")) * len(b.split(",")) for a, b in groups)
            assert len(set(r.pairs)) == len(r.pairs)
        else:
            assert r.groups == "" and r.pairs == [] and (not texts[r.doc_id] or "▁" in texts[r.doc_id])


def test_alignment_edge_rows(clashing_docs, empty_docs):
    want = plain_report([t for _, t, *_ in EDGE_ROWS])
    got = T.link_report(clashing_docs).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(r[0], *w) for r, w in zip(EDGE_ROWS, want)], key=str)
    assert T.link_report(empty_docs).count() == 0
