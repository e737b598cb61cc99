"""Near-duplicate groups by ProbMinHash, banding and verification.

A text's weighted set are its word shingles with their counts. Words are A-Z lower-cased runs of
`[0-9a-z]` and non-ASCII bytes; a text of fewer than `SHINGLE_WORDS` words has one shingle. Similarity is the
probability Jaccard index of the counts; texts with `SIMILARITY` or more are linked, and groups are the connected components
of all links.

Sketch: each shingle's arrivals are a Poisson process of rate its count; an arrival at time x takes a random register if it
is earlier than what the register has. A shingle stops as soon as its time passes the latest register of its text
(early termination). A register's shingle is equal in two texts with probability J_P.

1. Every row is sketched (`sketches`) and exact copies collapse to one text by 128-bit digest.
2. `BANDS` bands of `ROWS` registers; at similarity 0.8 a pair misses all bands with probability 6e-5. Within
   a band's bucket a search over sketches links texts of estimated similarity `LOOSE` (4.8 standard errors below 0.8) or
   more; a bucket of n texts gives at most n - 1 links. Their components hold every candidate pair.
3. Within such a component texts are compared exactly: the sum of the smaller shares bounds J_P from above, and from below
   by s / (2 - s); pairs between the bounds get J_P itself. Again n texts give n - 1 links at most. The components
   of these links are the groups.

Buckets and components larger than a block are dealt to tasks by pairs of blocks, so no pair is lost and no task holds more than two
blocks. Blocks of texts are bounded by their number and by their bytes (on average, as texts are dealt by hash; one text at least). Nothing of the size of the corpus is collected or broadcast; lineage is cut by tables in the shared folder.

Defined cases: null, empty and white-space texts are groups of their own; other texts without a word are grouped by digest, as exact copies. Rows that repeat an id and a text are one
document to `groups` (all have `kept`), and one of them stays in `deduplicated`. A null id is the largest; a group of null ids only has a null
class. An empty table gives no row. Columns of the input pass through `deduplicated` whatever they are called.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.llm.common import SPACED_WORD, arrow_map, binary_column, id_text, materialized, slices
from forgeline.llm.components import HOT_DEGREE, HOT_NODES, components
from forgeline.llm.hashing import U64, WordHasher, joined, mix

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS = 32
ROWS = 6
REGISTERS = BANDS * ROWS
LOOSE = 0.66
BUCKET_BLOCK = 4096
COMPONENT_BLOCK = 512
COMPONENT_BYTES = 4_000_000
SLICE_BYTES = 1_000_000

def shingles(texts: list[bytes], words: WordHasher, n: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle hash, count) of all distinct shingles, ascending; at most 65,536 texts."""
    buffer, text_ends = joined(texts)
    starts, hashed = words.hashes(buffer)
    doc = np.searchsorted(text_ends, starts, side="right")
    total = len(doc)
    padded_doc = np.concatenate([doc, np.full(n - 1, -1)])
    padded = np.concatenate([hashed, np.zeros(n - 1, np.uint64)])
    code = np.zeros(total, np.uint64)
    for j in range(n):
        same = padded_doc[j:j + total] == doc
        code = (code + np.where(same, padded[j:j + total], U64(j + 1))) * U64(0xDA942042E4DD58B5)
    first = np.ones(total, bool)
    first[1:] = doc[1:] != doc[:-1]
    code = mix(code)[first | same]
    doc = doc[first | same]
    # a text shorter than a shingle keeps only its first word's window, which holds all its words
    packed = np.sort((doc.astype(np.uint64) << U64(48)) | (code >> U64(16)))
    new = np.ones(len(packed), bool)
    new[1:] = packed[1:] != packed[:-1]
    at = np.flatnonzero(new)
    counts = np.diff(np.concatenate([at, [len(packed)]]))
    packed = packed[at]
    return (packed >> U64(48)).astype(np.int64), packed & U64(2**48 - 1), counts.astype(np.float64)


def registers(n_texts: int, doc: np.ndarray, element: np.ndarray, weight: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """ProbMinHash registers, (texts, m) 16-bit hashes of the winning elements."""
    earliest = np.full(n_texts * m, np.inf)
    winner = np.zeros(n_texts * m, np.uint64)
    ident = mix(element + U64(0x2545F4914F6CDD1D))
    live, time = np.arange(len(doc)), np.zeros(len(doc))
    drawn, step = 0, 1
    while len(live):
        # the next `step` arrivals of every live element
        number = np.arange(drawn + 1, drawn + step + 1, dtype=np.uint64) * U64(0xA24BAED4963EE407)
        random = mix(ident[live][:, None] + number[None, :])
        gap = -np.log(((random >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53)
        times = time[live][:, None] + np.cumsum(gap, axis=1) / weight[live][:, None]
        register = (mix(random ^ U64(0x8CB92BA72F3D8DD7)) % U64(m)).astype(np.int64)
        at = (doc[live][:, None] * m + register).ravel()
        flat = times.ravel()
        sooner = np.flatnonzero(flat < earliest[at])
        at, flat = at[sooner], flat[sooner]
        np.minimum.at(earliest, at, flat)
        won = flat == earliest[at]
        winner[at[won]] = np.repeat(ident[live], step)[sooner[won]]
        time[live] = times[:, -1]
        latest = earliest.reshape(n_texts, m).max(axis=1)
        live = live[time[live] < latest[doc[live]]]
        drawn += step
        step = min(2 * step, 256)
    return (winner >> U64(48)).astype(np.uint16).reshape(n_texts, m)


def sketch(texts: list[bytes | None], words: WordHasher | None = None) -> list[bytes | None]:
    """Registers of each text as bytes; None for a text without words."""
    words = words or WordHasher()
    out: list[bytes | None] = []
    plain = [t or b"" for t in texts]
    for a, b in slices(np.array([len(t) for t in plain]), SLICE_BYTES):
        for c in range(a, b, 4096):
            some = plain[c:min(b, c + 4096)]
            doc, element, weight = shingles(some, words)
            table = registers(len(some), doc, element, weight)
            filled = np.bincount(doc, minlength=len(some)) > 0
            out += [row.tobytes() if ok else None for row, ok in zip(table, filled)]
    return out


def probability_jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """J_P of two weight vectors over the same elements."""
    both = (x > 0) & (y > 0)
    if not both.any():
        return 0.0
    ratio = np.divide(x, y, out=np.full(len(x), np.inf), where=y > 0)
    order = np.argsort(ratio, kind="stable")
    ratio, x, y = ratio[order], x[order], y[order]
    above = np.concatenate([np.cumsum(x[::-1])[::-1], [0.0]])
    below = np.concatenate([[0.0], np.cumsum(y)])
    at = np.flatnonzero((x > 0) & (y > 0))
    cut = np.searchsorted(ratio, ratio[at], side="left")  # from here on x / x_d is the larger
    return float(np.sum(1.0 / (above[cut] / x[at] + below[cut] / y[at])))


def search(n: int, similar: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """(first of the component, other member) for all components of the graph that `similar(i, others)` spans."""
    left, links = np.arange(n), []
    while len(left):
        root, left = int(left[0]), left[1:]
        queue = [root]
        while queue and len(left):
            near = similar(queue.pop(), left)
            new = left[near]
            links += [(root, int(j)) for j in new]
            queue += new.tolist()
            left = left[~near]
    return links


def loose_links(tables: list[bytes], least: float = LOOSE) -> list[tuple[int, int]]:
    """Links between sketches of estimated similarity `least` or more."""
    table = np.frombuffer(b"".join(tables), np.uint16).reshape(len(tables), -1)
    needed = least * table.shape[1]
    return search(len(tables), lambda i, others: np.count_nonzero(table[others] == table[i], axis=1) >= needed)


def exact_links(texts: list[bytes], words: WordHasher, least: float = SIMILARITY) -> list[tuple[int, int]]:
    """Links between texts of probability Jaccard `least` or more."""
    doc, element, weight = shingles(texts, words)
    _, local = np.unique(element, return_inverse=True)
    first = np.searchsorted(doc, np.arange(len(texts) + 1))
    share = weight / np.maximum(np.bincount(doc, weight, len(texts)), 1.0)[doc]
    size = int(local.max()) + 1 if len(local) else 0

    def similar(i: int, others: np.ndarray) -> np.ndarray:
        mine = slice(first[i], first[i + 1])
        dense = np.zeros(size)
        dense[local[mine]] = share[mine]
        smaller = np.concatenate([[0.0], np.cumsum(np.minimum(dense[local], share))])
        common = smaller[first[others + 1]] - smaller[first[others]]
        near = common / (2 - common) >= least + 1e-9
        for at in np.flatnonzero((common >= least - 1e-9) & ~near):
            theirs = slice(first[others[at]], first[others[at] + 1])
            union = np.union1d(local[mine], local[theirs])
            x, y = np.zeros(len(union)), np.zeros(len(union))
            x[np.searchsorted(union, local[mine])] = weight[mine]
            y[np.searchsorted(union, local[theirs])] = weight[theirs]
            near[at] = probability_jaccard(x, y) >= least - 1e-12
        return near

    return search(len(texts), similar)


# ------------------------------------------------------------------ whole tables

def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, k (128-bit digest of the text), filled (not null or white space), bytes, sketch (null without words)."""
    rows = id_text(docs, id_col, text_col).selectExpr(
        "doc_id", "unhex(md5(coalesce(text, ''))) as k", f"coalesce(text rlike '{SPACED_WORD}', false) as filled",
        "cast(octet_length(coalesce(text, '')) as bigint) as bytes", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHasher()
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(sketch(binary_column(batch, "text"), words), pa.binary())],
                names=["doc_id", "k", "filled", "bytes", "sketch"])

    return arrow_map(rows, take, f"doc_id {kind}, k binary, filled boolean, bytes bigint, sketch binary")


def _in_blocks(members: DataFrame, group: str, sizes: DataFrame, block: int, block_bytes: int | None = None) -> DataFrame:
    """Members with the task they go to; groups above `block` members, or `block_bytes`, go to every pair of their blocks."""
    blocks = f"ceil(n / {block})" if block_bytes is None else f"greatest(ceil(n / {block}), ceil(bytes / {block_bytes}))"
    n = sizes.selectExpr(f"{group} as _g", f"cast({blocks} as int) as _blocks")
    dealt = members.join(n, members[group] == n._g).selectExpr("*", "cast(pmod(xxhash64(t, 11), _blocks) as int) as _own")
    return dealt.selectExpr(
        "*", f"explode(transform(sequence(0, _blocks - 1), j -> xxhash64({group}, least(_own, j), greatest(_own, j)))) as task"
    ).drop("_g", "_blocks", "_own")


def _per_task(members: DataFrame, value: str, link: Callable[[list[bytes]], list[tuple[int, int]]]) -> DataFrame:
    """Edges (a, b) that `link` finds among the values of each task."""

    def found(parts: list[pa.RecordBatch]) -> list[tuple[int, int]]:
        t = [x for p in parts for x in p.column(1).to_pylist()]
        values = [v for p in parts for v in p.column(2).to_pylist()]
        return [(t[i], t[j]) for i, j in link(values)] if len(values) > 1 else []

    def batch_of(edges: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([e[i] for e in edges], pa.int64()) for i in (0, 1)], names=["a", "b"])

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, task, parts = [], None, []
        for batch in batches:
            ids = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
            for start, end in zip(cuts, cuts[1:]):
                if start == end:
                    continue
                if parts and task != ids[start]:
                    out += found(parts)
                    parts = []
                task = ids[start]
                parts.append(batch.slice(start, end - start))
            if len(out) > 10_000:
                yield batch_of(out)
                out = []
        yield batch_of(out + found(parts))

    # a fixed number of partitions: comparing costs far more than the few bytes that partitions are merged by
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = members.select("task", "t", F.col(value).cast("binary")).repartition(parts, "task").sortWithinPartitions("task")
    return arrow_map(dealt, edges, "a bigint, b bigint")


def once_per_task(rows: DataFrame) -> DataFrame:
    """(k, text) rows without the repeats of a k within a task; a task remembers the digests of its own rows."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            new = []
            for k in batch.column(0).to_pylist():
                new.append(k not in seen)
                seen.add(k)
            yield batch.filter(pa.array(new, pa.bool_()))

    return arrow_map(rows, first, rows.schema)


def key_groups(docs: DataFrame, sketched: DataFrame, text_col: str = "text", similarity: float = SIMILARITY,
               bucket_block: int = BUCKET_BLOCK, component_block: int = COMPONENT_BLOCK,
               component_bytes: int = COMPONENT_BYTES) -> DataFrame:
    """(k, root) for every text that is linked to a different text; texts get numbers here, as the written table fixes them."""
    distinct = sketched.where("sketch is not null").select("k", "bytes", "sketch").dropDuplicates(["k"])
    texts = materialized(distinct.selectExpr("monotonically_increasing_id() as t", "*"), "near-texts")
    bands = texts.selectExpr(
        "t", f"explode(transform(sequence(0, {BANDS - 1}), b -> xxhash64(b, substring(sketch, {2 * ROWS} * b + 1, {2 * ROWS})))) as band")
    full = bands.groupBy("band").count().where("count > 1").selectExpr("band", "count as n")
    members = bands.join(full.select("band").withColumnRenamed("band", "_b"), F.col("band") == F.col("_b")).drop("_b")
    dealt = _in_blocks(members, "band", full, bucket_block)
    loose = components(_per_task(dealt.join(texts.select("t", "sketch"), "t"), "sketch", loose_links), "near-loose")
    numbered = loose.join(texts.selectExpr("t as node", "k", "bytes"), "node")
    sizes = numbered.groupBy("root").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    named = numbered.selectExpr("k", "node as t", "root")
    wanted = docs.selectExpr(f"cast(`{text_col}` as string) as text").where("text is not null").selectExpr("unhex(md5(text)) as k", "text")
    # shuffled at any size: the number of linked texts grows with the corpus; copies go before, so no digest has more rows than there are tasks
    content = once_per_task(wanted).join(named.hint("merge"), "k").dropDuplicates(["k"])

    def link(values: list[bytes]) -> list[tuple[int, int]]:
        return exact_links(values, WordHasher(), similarity)

    linked = components(_per_task(_in_blocks(content, "root", sizes, component_block, component_bytes), "text", link), "near-links")
    return linked.join(texts.selectExpr("t as node", "k"), "node").select("k", "root")


def document_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per distinct (doc_id, k): class_id (least id of the group), class_rows, rows (that repeat id and text), stays."""
    sketched = materialized(sketches(docs, id_col, text_col), "near-sketches")
    grouped = key_groups(docs, sketched, text_col, **options)
    each = sketched.groupBy("doc_id", "k").agg(F.count("*").alias("rows"), F.expr("max(filled) as filled"))
    # null, empty and white-space texts are groups of their own
    # a linked text's group goes by its root's number, any other by its digest
    rooted = each.where("filled").join(grouped, "k", "left").selectExpr(
        "doc_id", "k", "rows", "coalesce(cast(root as string), hex(k)) as root")
    rooted = materialized(rooted, "near-rooted")
    per_class = rooted.groupBy("root").agg(
        F.expr("min(struct(doc_id is null as last, doc_id, k)) as first"), F.sum("rows").alias("class_rows"), F.count("*").alias("n")
    ).withColumnRenamed("root", "r")
    # the rows of a large class would meet in one task; of `HOT_NODES` classes at most (sizes sum up to the rows) the class goes to the rows instead
    hot_from = max(HOT_DEGREE, -(-sketched.count() // HOT_NODES))
    hot = F.broadcast(per_class.where(f"n > {hot_from}"))
    cold = rooted.join(hot.select("r"), F.expr("root = r"), "left_anti").join(per_class.where(f"n <= {hot_from}").hint("merge"), F.expr("root = r"))
    classed = rooted.join(hot, F.expr("root = r")).unionByName(cold).selectExpr(
        "doc_id", "k", "rows", "first.doc_id as class_id", "class_rows", "doc_id <=> first.doc_id and k = first.k as stays")
    alone = each.where("not filled").selectExpr("doc_id", "k", "rows", "doc_id as class_id", "1L as class_rows", "true as stays")
    return classed.unionByName(alone)


def groups(docs: DataFrame, **options) -> DataFrame:
    """One row per row of `docs`: doc_id, class_id, class_rows (rows of the group), kept."""
    many = 100_000  # repeats of one row are counted out in arrays of at most this length
    return document_classes(docs, **options).selectExpr(
        "*", f"explode(sequence(0, (rows - 1) div {many})) as part").selectExpr(
        "doc_id", "class_id", "class_rows", "stays as kept",
        f"explode(sequence(1, least({many}, rows - part * {many}))) as copy").drop("copy")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """`docs` with one row of each group: that of the least id (then text digest)."""
    names = list(docs.columns)
    id_at, text_at = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    decided = materialized(document_classes(plain, id_at, text_at, **options).where("class_rows > 1").selectExpr(
        "doc_id as _id", "k as _k", "rows as _rows", "stays as _stays"), "near-decided")
    keyed = plain.withColumn("k", F.expr(f"unhex(md5(coalesce(cast({text_at} as string), '')))"))
    met = keyed.join(decided.hint("merge"), (F.col("k") == F.col("_k")) & F.col(id_at).eqNullSafe(F.col("_id")), "left")
    once = met.where("_stays is null or (_stays and _rows = 1)")
    if decided.where("_stays and _rows > 1").limit(1).count():
        # rows that repeat id and text: one of them
        once = once.unionByName(met.where("_stays and _rows > 1").dropDuplicates(["k", id_at]))
    return once.select(plain.columns).toDF(*names)
