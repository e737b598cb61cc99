"""Hard negatives by angular triangle filtering and integer scores.

A row is an id, a label and a vector; component x counts as the integer floor(scale * x). The score of two rows is their integer inner product.
An anchor's positives are its first `n_positives` other rows of its label (higher score first, ties by smaller id); for each positive,
its negatives are the first `n_negatives` rows of other labels whose score lies between `least_share` percent of the positive's and the positive's.

Filter: every row stores its angles to a few reference directions. For two rows the triangle inequality bounds their angle from both sides for each
reference; the cosines of the tightest bounds, times both norms and widened by more than all rounding, bound the score. Rows of the anchor's label whose
upper bound is under the anchor's fifth best lower bound cannot be positives, and rows of other labels whose interval meets no positive's window cannot be
negatives; only the others get integer scores. References (farthest-first among `REFERENCE_ROWS` rows with the smallest hashes) decide what
is skipped, never a result.

Work is dealt as a grid: blocks of rows (by hash, so a hot label or a group of equal vectors spreads) by blocks of anchors. A
task holds one block of rows and lets the anchors of the cell pass in batches, so memory follows the block; it returns at most
`n_positives` (then `n_positives * n_negatives`) rows an anchor, and a window over these picks the first ones.

Defined cases: rows with a null id, a null label, a null vector or a null or non-finite component take no part. Vectors of different lengths count as if
filled up with zeros; an empty vector has score 0 with all. Repeated ids are rows of their own (ties between them in the order of the written rows, and each
anchor row gives its own results). Components beyond 2**62 count as that, scores beyond a long as its end. An anchor without
other rows of its label, and a positive without rows in its window, give no row; a negative score has an empty window. An empty table gives no row.
Labels are whole numbers.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.llm.common import arrow_map, materialized

SCALE, N_POSITIVES, N_NEGATIVES, LEAST_SHARE = 256, 5, 5, 80
N_REFERENCES, REFERENCE_ROWS = 8, 1_000
#: Bytes of one block of rows (as 8-byte numbers), and anchors of one block.
BLOCK_BYTES, BLOCK_ANCHORS = 16 << 20, 65_536
_TILE = 256, 4_096
#: Angles are off by less (arccos near 1 turns 1e-15 into 5e-8).
_SLACK = 1e-6
_LONG = 2**63 - 1


def references(vectors: np.ndarray, n: int = N_REFERENCES) -> np.ndarray:
    """Unit directions, each the farthest in angle from those before; first the longest vector."""
    norms = np.linalg.norm(vectors, axis=1)
    unit = vectors[norms > 0] / norms[norms > 0][:, None]
    if not len(unit):
        return np.zeros((0, vectors.shape[1]))
    chosen = [int(np.argmax(norms[norms > 0]))]
    nearest = unit @ unit[chosen[0]]
    while len(chosen) < min(n, len(unit)) and nearest.min() < 1 - 1e-9:
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    return unit[chosen]


def dense(lists: pa.ListArray, width: int) -> np.ndarray:
    """Rows of a list column as a matrix, short ones filled up with zeros."""
    ends = lists.offsets.to_numpy()
    values = lists.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]]
    lengths = np.diff(ends)
    if len(lengths) and np.all(lengths == width):
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), values.dtype)
    out[np.arange(width) < lengths[:, None]] = values
    return out


@dataclass
class Block:
    """Rows of one cell: keys, ids, labels, integer vectors, norms and angles to the references."""

    row: np.ndarray
    id: np.ndarray
    label: np.ndarray
    vectors: np.ndarray
    norm: np.ndarray
    angles: np.ndarray

    @classmethod
    def of(cls, batches: list[pa.RecordBatch], width: int) -> Block:
        table = pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
        get = lambda c: table.column(c).to_numpy(zero_copy_only=False)
        return cls(get("row"), get("id"), get("label"), dense(table.column("q"), width), get("norm"),
                   dense(table.column("angles"), N_REFERENCES))

    def part(self, at) -> Block:
        return Block(self.row[at], self.id[at], self.label[at], self.vectors[at], self.norm[at], self.angles[at])


def bounds(a: Block, x: Block) -> tuple[np.ndarray, np.ndarray]:
    """No score of `a` by `x` is under the first matrix or over the second."""
    low = np.zeros((len(a.row), len(x.row)))
    high = np.full(low.shape, np.pi)
    for p, q in zip(a.angles.T, x.angles.T):
        np.maximum(low, np.abs(p[:, None] - q), out=low)
        total = p[:, None] + q
        np.minimum(high, np.minimum(total, 2 * np.pi - total), out=high)
    norms = a.norm[:, None] * x.norm
    rounding = norms * 1e-9 + 1
    # scores end at the ends of a long
    return (np.minimum(norms * np.cos(np.minimum(high + _SLACK, np.pi)) - rounding, float(_LONG)),
            np.maximum(norms * np.cos(np.maximum(low - _SLACK, 0)) + rounding, -float(_LONG)))


def scores(a: Block, x: Block, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index in a, index in x, integer score) where wanted."""
    i, j = np.nonzero(wanted)
    if not len(i):
        return i, j, np.empty(0, np.int64)
    if a.norm.max() * x.norm.max() < 2**52:  # then all sums are exact in doubles
        if len(i) > wanted.size / 16:
            return i, j, (a.vectors.astype(float) @ x.vectors.astype(float).T)[i, j].astype(np.int64)
        return i, j, np.einsum("ij,ij->i", a.vectors[i], x.vectors[j])
    left, right = a.vectors.astype(object), x.vectors.astype(object)
    return i, j, np.array([min(max(int(left[m] @ right[n]), -_LONG - 1), _LONG) for m, n in zip(i, j)], np.int64)


def first(group: np.ndarray, score: np.ndarray, id_: np.ndarray, row: np.ndarray, most: int) -> np.ndarray:
    """Positions of the first `most` of each group: higher score, then smaller id, then earlier row."""
    order = np.lexsort((row, id_, ~score, group))
    g = group[order]
    begin = np.searchsorted(g, g)
    return order[np.arange(len(g)) - begin < most]


def _tiles(n: int, most: int) -> Iterator[slice]:
    return (slice(a, min(a + most, n)) for a in range(0, n, most))


def positives_of(a: Block, x: Block, most: int) -> list[np.ndarray]:
    """Columns (anchor row, row, id, score): the first `most` rows of each anchor's label in this block. Both are ordered by label."""
    found = [[], [], [], []]
    for label in np.unique(a.label):
        mine, same = (b.part(slice(np.searchsorted(b.label, label), np.searchsorted(b.label, label, "right"))) for b in (a, x))
        for at in _tiles(len(mine.row), _TILE[0]):
            anchors, best = mine.part(at), [np.empty(0, np.int64)] * 4
            for to in _tiles(len(same.row), _TILE[1]):
                rows = same.part(to)
                low, high = bounds(anchors, rows)
                other = anchors.row[:, None] != rows.row
                low[~other] = -np.inf
                if low.shape[1] > most:
                    other &= high >= np.partition(low, -most, axis=1)[:, -most][:, None]
                i, j, s = scores(anchors, rows, other)
                best = [np.concatenate(p) for p in zip(best, (anchors.row[i], rows.row[j], rows.id[j], s))]
                kept = first(best[0], best[3], best[2], best[1], most)
                best = [b[kept] for b in best]
            for column, b in zip(found, best):
                column.append(b)
    return [np.concatenate([np.empty(0, np.int64), *c]) for c in found]


def negatives_of(a: Block, windows: tuple[np.ndarray, np.ndarray], x: Block, most: int) -> list[np.ndarray]:
    """Columns (anchor's place in a, positive's place, row, id, score): the first `most` rows of other labels in each window of this block.

    `windows` are the least and the highest score of each (anchor, positive).
    """
    out = []
    for at in _tiles(len(a.row), _TILE[0]):
        anchors, least, most_score = a.part(at), windows[0][at], windows[1][at]
        best = [np.empty(0, np.int64)] * 4  # place (anchor, positive), row, id, score
        n = least.shape[1]
        for to in _tiles(len(x.row), _TILE[1]):
            rows = x.part(to)
            low, high = bounds(anchors, rows)
            wanted = np.zeros(low.shape, bool)
            for p in range(n):
                wanted |= (low <= most_score[:, p, None]) & (high >= least[:, p, None])
            wanted &= anchors.label[:, None] != rows.label
            i, j, s = scores(anchors, rows, wanted)
            for p in range(n):
                inside = (s >= least[i, p]) & (s <= most_score[i, p])
                best = [np.concatenate(q) for q in zip(best, (i[inside] * n + p, rows.row[j[inside]], rows.id[j[inside]], s[inside]))]
            kept = first(best[0], best[3], best[2], best[1], most)
            best = [b[kept] for b in best]
        out.append([at.start + best[0] // n, best[0] % n, *best[1:]])
    return [np.concatenate(c) for c in zip(*out)]


def prepared(rows: DataFrame, anchor: str, id_col: str, label_col: str, vector_col: str, scale: int) -> tuple[DataFrame, int]:
    """The rows that take part, written: row, id, label, is_anchor, q, norm, angles; and the longest vector's length."""
    taking = rows.selectExpr(
        f"cast(`{id_col}` as bigint) as id", f"cast(`{label_col}` as bigint) as label", f"cast(`{vector_col}` as array<double>) as v",
        f"cast({anchor} as boolean) as is_anchor").where(
        "id is not null and label is not null and v is not null and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('inf'))")
    sample = [r["v"] for r in taking.orderBy(F.expr("xxhash64(id)"), "id").limit(REFERENCE_ROWS).select("v").collect()]
    width = taking.agg(F.max(F.expr("size(v)"))).first()[0] or 0
    chosen = references(np.array([_whole(np.array([*v, *[0.0] * (width - len(v))]), scale) for v in sample], float).reshape(len(sample), width))

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            ends = lists.offsets
            start = ends[0].as_py()
            whole = _whole(lists.values.to_numpy(zero_copy_only=False)[start:ends[-1].as_py()], scale)
            q = pa.ListArray.from_arrays(pa.array(ends.to_numpy() - start, pa.int32()), pa.array(whole))
            v = dense(q, width).astype(float)
            norm = np.linalg.norm(v, axis=1)
            cosines = v @ chosen.T / np.where(norm > 0, norm, 1)[:, None]
            angles = np.full((len(v), N_REFERENCES), np.pi / 2)
            angles[:, :len(chosen)] = np.arccos(np.clip(cosines, -1, 1))
            # without a reference in a place, nothing is known there: an angle of a quarter turn to all would be false
            angles[:, len(chosen):] = angles[:, :1] if len(chosen) else np.pi / 2
            stored = pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1) * N_REFERENCES, pa.int32()), pa.array(angles.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), q, pa.array(norm), stored],
                                             names=["id", "label", "is_anchor", "q", "norm", "angles"])

    out = arrow_map(taking, prepare, "id long, label long, is_anchor boolean, q array<long>, norm double, angles array<double>")
    return materialized(out.selectExpr("monotonically_increasing_id() as row", "*"), "vectors"), width


def _whole(v: np.ndarray, scale: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(v * scale), -(2.0**62), 2.0**62).astype(np.int64)


def dealt(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, width: int) -> DataFrame:
    """Both sides by cell of the grid, the rows of a cell before its anchors, each ordered by label."""
    parallelism = rows.sparkSession.sparkContext.defaultParallelism
    down = max(-(-n_rows * max(width, 1) * 8 // BLOCK_BYTES), min(2 * parallelism, -(-n_rows // 1_024)), 1)
    across = max(-(-n_anchors // BLOCK_ANCHORS), 1)
    own = rows.selectExpr("0 as kind", f"pmod(xxhash64(row), {down}) * {across} as base", "row", "id", "label", "q", "norm", "angles",
                          "cast(null as array<bigint>) as scores").selectExpr(f"explode(sequence(base, base + {across - 1})) as cell", "*")
    met = anchors.selectExpr("1 as kind", f"pmod(xxhash64(row), {across}) as base", "row", "id", "label", "q", "norm", "angles",
                             "scores").selectExpr(f"explode(transform(sequence(0, {down - 1}), d -> d * {across} + base)) as cell", "*")
    return own.unionByName(met).drop("base").repartition(down * across, "cell").sortWithinPartitions("cell", "kind", "label", "row")


def per_cell(cells: DataFrame, width: int, meet, schema: str) -> DataFrame:
    """`meet(anchors, batch, rows)` for each batch of anchors of a cell and the cell's rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, block = None, [], None
        for batch in batches:
            key = batch.column("cell").to_numpy() * 2 + batch.column("kind").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if key[a] // 2 != cell:
                    cell, held, block = key[a] // 2, [], None
                if key[a] % 2 == 0:
                    held.append(part)
                elif held:
                    block = block or Block.of(held, width)
                    for at in range(0, b - a, 1_024):
                        some = part.slice(at, 1_024)
                        yield meet(Block.of([some], width), some, block)

    return arrow_map(cells, run, schema)


def mined(rows: DataFrame, anchor: str, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", scale: int = SCALE,
          n_positives: int = N_POSITIVES, n_negatives: int = N_NEGATIVES, least_share: int = LEAST_SHARE) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score); `anchor` is an SQL condition for anchors."""
    vectors, width = prepared(rows, anchor, id_col, label_col, vector_col, scale)
    anchors = vectors.where("is_anchor")
    n_rows, n_anchors = vectors.count(), anchors.count()

    def meet_same(a: Block, batch: pa.RecordBatch, x: Block) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in positives_of(a, x, n_positives)], names=["anchor", "row", "id", "score"])

    near = per_cell(dealt(vectors, anchors.selectExpr("*", "cast(null as array<bigint>) as scores"), n_rows, n_anchors, width), width, meet_same,
                    "anchor long, row long, id long, score long")
    near = near.selectExpr("*", "row_number() over (partition by anchor order by score desc, id, row) as place").where(f"place <= {n_positives}")
    near = materialized(near, "positives")
    lists = near.groupBy("anchor").agg(F.expr("array_sort(collect_list(struct(place, id, score)))").alias("p")).selectExpr(
        "anchor", "p.id as ids", "p.score as scores")

    def meet_other(a: Block, batch: pa.RecordBatch, x: Block) -> pa.RecordBatch:
        lists = batch.column("scores")
        held = np.diff(lists.offsets.to_numpy())[:, None] > np.arange(n_positives)
        best = dense(lists, n_positives)
        # the least whole score s with 100 * s >= share * best, in whole numbers; a place without a positive has an empty window
        least = best - (best * (100 - least_share) // 100 if abs(best).max(initial=0) < 2**55 else _parts(best, 100 - least_share))
        least, most = np.where(held, least, _LONG), np.where(held, best, -_LONG)
        i, p, row, id_, s = negatives_of(a, (least, most), x, n_negatives)
        return pa.RecordBatch.from_arrays(
            [pa.array(a.row[i]), pa.array(p, pa.int32()), pa.array(row), pa.array(id_), pa.array(s)],
            names=["anchor", "place", "row", "id", "score"])

    asked = anchors.join(lists, F.col("row") == F.col("anchor")).drop("anchor", "ids")
    far = per_cell(dealt(vectors, asked, n_rows, n_anchors, width), width, meet_other, "anchor long, place int, row long, id long, score long")
    far = far.selectExpr("*", "row_number() over (partition by anchor, place order by score desc, id, row) as rank").where(f"rank <= {n_negatives}")
    names = anchors.selectExpr("row as anchor", "id as anchor_id").join(lists, "anchor")
    return far.join(names, "anchor").selectExpr(
        "anchor_id", "ids[place] as positive_id", "rank", "id as negative_id", "scores[place] as positive_score", "score as negative_score")


def _parts(best: np.ndarray, share: int) -> np.ndarray:
    """share percent of large numbers, rounded down."""
    return np.array([[int(x) * share // 100 for x in row] for row in best.tolist()], np.int64).reshape(best.shape)
