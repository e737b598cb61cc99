from __future__ import annotations

import collections
import random

import numpy as np
import pytest

from forgeline.llm import probminhash as P
from forgeline.llm.common import documents
from forgeline.llm.components import components
from forgeline.llm.hashing import ALNUM, WordHasher
from tests.conftest import SF_SMALL
from tests.llm.conftest import DOCS, prose

FOLD = bytes(x if x else 32 for x in ALNUM.tolist())


def shingle_counts(text: str) -> collections.Counter:
    w = text.encode().translate(FOLD).split()
    return collections.Counter(zip(*(w[i:] for i in range(5)))) if len(w) >= 5 else collections.Counter([tuple(w)] if w else [])


def j_p(a, b) -> float:
    union = set(a) | set(b)
    return sum(1 / sum(max(a.get(k, 0) / a[d], b.get(k, 0) / b[d]) for k in union) for d in a if d in b)


def brute_groups(rows) -> dict:
    """{(doc_id, text): least id of the group} by all pairs and union-find."""
    keys = sorted({(i is None, i, t or "") for i, t in rows}, key=lambda x: (x[0], x[1] or 0, x[2]))
    sets = [shingle_counts(t) for _, _, t in keys]
    root = list(range(len(keys)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(keys)):
        for y in range(x):
            a, b = sets[x], sets[y]
            if a and b and find(x) != find(y) and len(a.keys() & b.keys()) * 3 > min(len(a), len(b)) and j_p(a, b) >= 0.8:
                lo, hi = sorted((find(x), find(y)))
                root[hi] = lo
    return {(k[1], k[2]): keys[find(x)][1] for x, k in enumerate(keys)}


def variants(n: int, seed: int) -> list[str]:
    """A chain of near copies: each changes a few words of one before."""
    r = random.Random(seed)
    out = [prose(150, seed)]
    while len(out) < n:
        w = r.choice(out[-4:]).split()
        for _ in range(r.randrange(1, 5)):
            w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_estimates_probability_jaccard():
    r = random.Random(5)
    pairs = []
    for s in range(25):
        w = prose(200, s).split()
        w += w[: r.randrange(0, 80)]  # counts above one
        v = list(w)
        for _ in range(r.randrange(0, 16)):
            v[r.randrange(len(v))] = f"y{r.randrange(10**6)}"
        pairs.append((" ".join(w), " ".join(v)))
    error = []
    for a, b in pairs:
        x, y = P.sketch([a.encode(), b.encode()])
        estimate = np.mean(np.frombuffer(x, np.uint16) == np.frombuffer(y, np.uint16))
        exact = j_p(shingle_counts(a), shingle_counts(b))
        error.append(estimate - exact)
        assert bool(P.exact_links([a.encode(), b.encode()], WordHasher())) == (exact >= 0.8)
    assert abs(np.mean(error)) < 0.02 and np.std(error) < 0.06


def test_sketch_does_not_depend_on_the_batch():
    texts = [prose(n, n).encode() for n in (3, 7, 60, 500)] + [None, b"", b" ..!"]
    one_by_one = [P.sketch([t])[0] for t in texts]
    assert P.sketch(texts) == one_by_one
    assert one_by_one[4:] == [None, None, None]


@pytest.mark.parametrize("blocks", [{}, {"bucket_block": 7, "component_block": 5}])
def test_groups_equal_brute_force(spark, blocks):
    texts = [t for s in range(3) for t in variants(25, s)] + [prose(80, 40 + i) for i in range(15)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, texts[i]) for i in range(0, 60, 7)] + [(3, texts[3])]
    rows += [(2000, None), (2001, ""), (2002, ""), (2003, "a b"), (2004, "A, b!"), (None, texts[5])]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    want = brute_groups(rows)
    got = P.groups(docs, **blocks).collect()
    assert len(got) == len(rows)
    by_id = {i: t or "" for i, t in rows}
    assert {(r.doc_id, by_id[r.doc_id]): r.class_id for r in got} == want
    size = collections.Counter(want[i, t or ""] for i, t in rows)
    assert all(r.class_rows == size[r.class_id] for r in got if r.doc_id not in (2000, 2001, 2002))
    kept = P.deduplicated(docs, **blocks).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(want.values()))


def test_whole_small_table_equals_brute_force(spark):
    docs = documents(spark, SF_SMALL)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute_groups(rows)
    assert {r.doc_id: r.class_id for r in P.groups(docs).collect()} == {i: c for (i, _), c in want.items()}


def test_edge_rows(spark, edge_docs, clashing_docs, empty_docs):
    got = P.groups(edge_docs).collect()
    assert len(got) == edge_docs.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[5].class_id == 4 and not by_id[5].kept and by_id[1].kept and by_id[2].kept
    assert by_id[None].class_id is None and by_id[None].kept
    kept = P.deduplicated(clashing_docs)
    assert kept.columns == clashing_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "4", "6", "None", "8", "9", "10", "11"])
    assert P.groups(empty_docs).count() == 0 and P.deduplicated(empty_docs).count() == 0


def test_copies_of_texts_without_words_are_grouped(spark):
    rows = [(1, "... --- ..."), (2, "... --- ..."), (3, "--- ..."), (2, "... --- ..."), (4, " \t"), (5, " \t"), (6, ""), (7, None), (8, "")]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    got = {(r.doc_id, r.class_id, r.class_rows) for r in P.groups(docs).collect()}
    assert got == {(1, 1, 3), (2, 1, 3), (3, 3, 1), *((i, i, 1) for i in (4, 5, 6, 7, 8))}
    assert sorted(r.doc_id for r in P.deduplicated(docs).collect()) == [1, 3, 4, 5, 6, 7, 8]


def test_copies_are_dropped_before_the_text_shuffle(spark):
    rows = spark.range(0, 4000, 1, 4).selectExpr("unhex(md5(cast(id % 3 as string))) as k", "cast(id % 3 as string) as text")
    got = P.once_per_task(rows).collect()
    assert len(got) == 4 * 3 and {(bytes(r.k), r.text) for r in got} == {(bytes(r.k), r.text) for r in rows.distinct().collect()}


def test_blocks_of_texts_follow_their_bytes(spark, monkeypatch):
    """Texts that go to one comparing task stay near two blocks of bytes, and no link is lost."""
    texts = variants(40, 6)
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    total, dealt = sum(map(len, texts)), []
    per_task = P._per_task
    monkeypatch.setattr(P, "_per_task", lambda members, value, link: (dealt.append((members, value)), per_task(members, value, link))[1])
    got = {r.doc_id: r.class_id for r in P.groups(docs, component_bytes=total // 10).collect()}
    assert got == {i: c for (i, _), c in brute_groups(list(enumerate(texts))).items()}
    (content,) = [m for m, value in dealt if value == "text"]
    most = content.groupBy("task").agg({"text": "count"}).selectExpr("max(`count(text)`)").first()[0]
    assert most <= 24


def test_components_equal_union_find(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(r.randrange(100, 400), r.randrange(100, 400)) for _ in range(150)] + [(7, 7)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        lo, hi = sorted((find(a), find(b)))
        root[hi] = lo
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "a bigint, b bigint"), "test").collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


def test_hot_nodes_and_classes_give_the_same(spark, monkeypatch):
    """Stars and classes above the bound go by broadcast; a path, a star and pairs."""
    import forgeline.llm.components as K

    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 - i) for i in range(1, 80)] + [(2000 + i, 2001 + i) for i in range(0, 40, 2)]
    want = {n: 0 for n in range(61)} | {1000 - i: 921 for i in range(80)} | {2000 + i: 2000 + i - i % 2 for i in range(40)}
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    for degree, nodes in ((1000, 10_000), (5, 10_000), (1, 10_000), (5, 20)):
        monkeypatch.setattr(K, "HOT_DEGREE", degree)
        monkeypatch.setattr(K, "HOT_NODES", nodes)
        assert {r.node: r.root for r in components(df, "hot").collect()} == want
    monkeypatch.setattr(P, "HOT_DEGREE", 3)
    texts = variants(30, 4) + [prose(100, 77)] * 12 + [prose(60, i) for i in range(100, 110)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {(r.doc_id, texts[r.doc_id]): r.class_id for r in P.groups(docs).collect()} == brute_groups(list(enumerate(texts)))
