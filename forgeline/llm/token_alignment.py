"""Links between the tokens of two tokenizers over the same text, and how many documents hold each link.

A text with a space in front is encoded by a byte-level BPE file (A) and by a SentencePiece model (B, which adds that space itself). Byte offsets
where tokens of both end are shared cuts; between two neighbouring cuts lies a group, and every A token of a group is linked to
every B token of it. `groups_of` finds them by divide and conquer: it looks for a common end near the middle by bisection, goes
on with both halves, and an interval without a cut is a leaf, which is a group. The spaces before which both tokenizers always end a token
(`chunks`) are shared cuts known beforehand, so the first divisions fall there, and each distinct chunk between them is
encoded and divided once: the frequent ones once for all workers, the others once in their slice of about 4 MB.

Corpus-wide counts: each document gives its distinct (A id, B id) pairs with their number of links; the pairs are counted over
documents with map-side combining. Counts come back to the documents by a join on the pair: the most frequent ones (`SENT_PAIRS` rows at
most, a bound by count) by broadcast, all rarer ones by a shuffle, in which no pair is hot because the frequent ones have left.

Defined cases: null and empty texts, and texts whose tokens do not give back the bytes (a literal U+2581) have no tokens: zeros and an
empty `groups`. Repeated ids and rows stay rows of their own and count as documents of their own. An empty table gives no row. Very long texts are cut like others;
a stretch without a shared cut is one group, held as its distinct pairs. Other columns of the input are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.llm.byte_level import byte_level, vocabulary_text
from forgeline.llm.chunks import SLICE_BYTES, Chunked, Segments, byte_level_cuts, frequent, front_mark_cuts, stacked, text_slices
from forgeline.llm.common import arrow_map, id_text, materialized
from forgeline.llm.sentence_pieces import chunk_ids, model_bytes, processor_of

SENT_PAIRS = 500_000


def groups_of(a: list[int], b: list[int]) -> list[tuple[int, int, int, int]]:
    """Groups (from A token, to A token, from B token, to B token) of two ascending lists of ends with the same last value."""
    out, open_ = [], [(0, len(a), 0, len(b))]
    while open_:
        a0, a1, b0, b1 = open_.pop()
        cut = None
        if a1 - a0 > 1 and b1 - b0 > 1:
            # outwards from the middle; the last end of an interval is its edge, not a cut in it
            middle, last = (a0 + a1 - 1) // 2, a1 - 2
            for step in range(max(middle - a0, last - middle) + 1):
                for i in (middle + step, middle - step) if step else (middle,):
                    if a0 <= i <= last:
                        j = bisect_left(b, a[i], b0, b1 - 1)
                        if j < b1 - 1 and b[j] == a[i]:
                            cut = i + 1, j + 1
                            break
                if cut:
                    break
        if cut:
            open_.append((cut[0], a1, cut[1], b1))
            open_.append((a0, cut[0], b0, cut[1]))
        else:
            out.append((a0, a1, b0, b1))
    return out


class Aligner:
    """Rows of chunks: tokens of A and B, groups, links, the groups as text, pairs and how often each is linked."""

    schema = "fits boolean, n_a int, n_b int, n_groups int, n_links long, groups string, pairs array<long>, times array<long>"

    def __init__(self, vocabulary: str, model: bytes, cut: bool):
        self.a = byte_level(vocabulary, plain_special=True)
        self.b = chunk_ids(model, cut)
        library = processor_of(model)
        self.width = library.get_piece_size()
        self.bytes_a = self.a.token_bytes()
        self.bytes_b = [bytes([int(library.id_to_piece(i)[3:5], 16)]) if library.is_byte(i) else library.id_to_piece(i).replace("▁", " ").encode()
                        for i in range(self.width)]
        self.cut = cut

    def _aligned(self, chunk: bytes, a: list[int], b: list[int]):
        """One row; `pairs` may repeat a pair, each time with its own number of links."""
        parts_a, parts_b = [self.bytes_a[i] for i in a], [self.bytes_b[i] for i in b]
        if b"".join(parts_a) != chunk or b"".join(parts_b) != chunk:
            return False, 0, 0, 0, 0, "", [], []
        width = self.width
        if parts_a == parts_b:
            text = ";".join([f"{x}|{y}" for x, y in zip(a, b)])
            return True, len(a), len(a), len(a), len(a), text, [x * width + y for x, y in zip(a, b)], [1] * len(a)
        groups = groups_of(list(accumulate(map(len, parts_a))), list(accumulate(map(len, parts_b))))
        texts, pairs, times, links = [], [], [], 0
        for a0, a1, b0, b1 in groups:
            n = (a1 - a0) * (b1 - b0)
            links += n
            if n == 1:
                pairs.append(a[a0] * width + b[b0])
                times.append(1)
                texts.append(f"{a[a0]}|{b[b0]}")
                continue
            left, right = a[a0:a1], b[b0:b1]
            texts.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
            if n < 16:
                pairs += [x * width + y for x in left for y in right]
                times += [1] * n
            else:
                right = Counter(right).items()
                for x, m in Counter(left).items():
                    pairs += [x * width + y for y, _ in right]
                    times += [m * k for _, k in right]
        return True, len(a), len(b), len(groups), links, ";".join(texts), pairs, times

    def __call__(self, chunks: list[str]) -> pa.RecordBatch:
        """A chunk has its space in front; whole texts (no cuts) have it too."""
        whole = self.b(chunks if self.cut else [c[1:] for c in chunks])
        rows = [self._aligned(c.encode(), a, b) for c, a, b in zip(chunks, self.a.ids(chunks), whole)]
        columns = list(zip(*rows)) if rows else [()] * 8
        pairs, ends = stacked(columns[6], np.int64)
        times, _ = stacked(columns[7], np.int64)
        ends = pa.array(ends, pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.bool_()), *(pa.array(c, pa.int32()) for c in columns[1:4]), pa.array(columns[4], pa.int64()),
             pa.array(columns[5], pa.string()), pa.ListArray.from_arrays(ends, pa.array(pairs)), pa.ListArray.from_arrays(ends, pa.array(times))],
            names=["fits", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"])


def _texts_of(chunked: Chunked, rows: pa.RecordBatch, fits: np.ndarray) -> pa.Array:
    """The groups of each text, chunk by chunk, parted by semicolons; empty for texts that do not fit."""
    groups = rows.column("groups")
    n = len(groups)
    table = pa.concat_arrays([pc.binary_join_element_wise(";", groups, "") if n else groups, groups])
    codes, bounds = chunked.codes.astype(np.int64), chunked.bounds
    codes[bounds[:-1][np.diff(bounds) > 0]] += n
    spread = np.repeat(fits, np.diff(bounds))
    to = np.concatenate([[0], np.cumsum(spread)])[bounds]
    joined = table.take(pa.array(codes[spread]))
    ends = np.frombuffer(joined.buffers()[1], np.int32)[:len(joined) + 1][to] if len(joined) else to
    return pa.StringArray.from_buffers(len(fits), pa.py_buffer(ends.astype(np.int32)), joined.buffers()[2] or pa.py_buffer(b""))


def _pairs_of(chunked: Chunked, rows: pa.RecordBatch, fits: np.ndarray) -> tuple[pa.ListArray, pa.ListArray]:
    """Distinct pairs of each text and how often each is linked."""
    lists = rows.column("pairs")
    ends = lists.offsets.to_numpy()
    pairs, bounds = chunked.ragged(lists.values.to_numpy(), ends)
    times, _ = chunked.ragged(rows.column("times").values.to_numpy(), ends)
    text = np.repeat(np.arange(len(fits)), np.diff(bounds))
    keep = fits[text]
    pairs, times, text = pairs[keep], times[keep], text[keep]
    key = text * (pairs.max(initial=0) + 1) + pairs
    order = np.argsort(key)
    pairs, times, text, key = pairs[order], times[order], text[order], key[order]
    new = np.ones(len(pairs), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    to = pa.array(np.searchsorted(text[at], np.arange(len(fits) + 1)), pa.int32())
    summed = np.add.reduceat(times, at) if len(at) else times
    return pa.ListArray.from_arrays(to, pa.array(pairs[at])), pa.ListArray.from_arrays(to, pa.array(summed))


def aligned(docs: DataFrame, vocabulary: str | None = None, model: str | None = None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times).

    `groups` is the alignment as text (`a1,a2|b1;a3|b2,b3`), `pairs` the distinct linked pairs (A id times the size of B's vocabulary, plus B id),
    `times` how many links each has.
    """
    text, file = vocabulary_text(vocabulary), model_bytes(model)
    cut = byte_level_cuts(text) and front_mark_cuts(file)
    context = docs.sparkSession.sparkContext
    sent = context.broadcast((text, file))
    texts = id_text(docs, id_col, text_col)

    def make() -> Aligner:
        return Aligner(*sent.value, cut)

    known = context.broadcast(frequent(texts, cut, " ", make, Aligner.schema))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments = Segments(make(), known.value)
        for batch in batches:
            for rows, some in text_slices(batch, "text", SLICE_BYTES // 2):
                marked = pc.if_else(pc.equal(some, ""), "", pc.binary_join_element_wise(" ", some, ""))
                chunked = Chunked(marked, cut)
                found = segments.of(chunked)
                fits = chunked.sums((~found.column("fits").to_numpy(zero_copy_only=False)).astype(np.int64)) == 0
                numbers = [pa.array(np.where(fits, chunked.sums(found.column(c).to_numpy().astype(np.int64)), 0))
                           for c in ("n_a", "n_b", "n_groups", "n_links")]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), *numbers, _texts_of(chunked, found, fits), *_pairs_of(chunked, found, fits)],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"])

    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_map(texts, align, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, "
                                   "pairs array<long>, times array<long>")


def link_counts(rows: DataFrame, width: int) -> DataFrame:
    """(pair, n, best): documents that hold each pair linked, and whether no pair of the same A id has more."""
    counts = rows.selectExpr("explode(pairs) as pair").groupBy("pair").agg(F.count("*").alias("n"))
    counts = materialized(counts, "link-counts")
    # one row for each A id at most, so as many as the vocabulary has
    highest = counts.selectExpr(f"pair div {width} as a", "n").groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(highest), F.expr(f"pair div {width} = a")).selectExpr("pair", "n", "n = most as best")


def link_sums(rows: DataFrame, counts: DataFrame, row: str, sent_pairs: int = SENT_PAIRS) -> DataFrame:
    """(row, n_best, count_sum) of each row with pairs: links whose count is the highest of their A id, and the sum of counts over links."""
    sizes = {r["size"]: r["count"] for r in counts.groupBy(F.expr("length(bin(n))").alias("size")).count().collect()}  # 64 rows at most
    least, kept = 65, 0
    while least > 1 and kept + sizes.get(least - 1, 0) <= sent_pairs:
        least -= 1
        kept += sizes.get(least, 0)
    links = rows.selectExpr(f"`{row}` as row", "inline(arrays_zip(pairs, times)) as (pair, times)")
    often = F.broadcast(counts.where(f"length(bin(n)) >= {least}"))

    def summed(joined: DataFrame) -> DataFrame:
        return joined.groupBy("row").agg(F.expr("sum(if(best, times, 0))").alias("n_best"), F.expr("sum(times * n)").alias("count_sum"))

    if sum(sizes.values()) == kept:
        return summed(links.join(often, "pair"))
    rare = links.join(often.select("pair"), "pair", "left_anti").join(counts.where(f"length(bin(n)) < {least}").hint("merge"), "pair")
    return summed(links.join(often, "pair")).unionByName(summed(rare)).groupBy("row").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def link_report(docs: DataFrame, sent_pairs: int = SENT_PAIRS, **options) -> DataFrame:
    """Per document its alignment's numbers, n_best and count_sum, and `groups_sha256`, the hash of its groups ('' without tokens)."""
    rows = aligned(docs, **options)
    width = processor_of(model_bytes(options.get("model"))).get_piece_size()
    # the written rows fix the numbers that stand for rows
    rows = materialized(rows.selectExpr(
        "monotonically_increasing_id() as row", "doc_id", "n_a", "n_b", "n_groups", "n_links",
        "if(n_a = 0, '', sha2(groups, 256)) as groups_sha256", "pairs", "times"), "links")
    sums = link_sums(rows, link_counts(rows, width), "row", sent_pairs)
    return rows.drop("pairs", "times").join(sums, "row", "left").selectExpr(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "coalesce(n_best, 0) as n_best", "coalesce(count_sum, 0) as count_sum", "groups_sha256")
