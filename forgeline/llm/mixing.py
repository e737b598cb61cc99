"""Mix sources to target weights by systematic sampling.

A source's rate is target / size, the expected copies of each of its documents.
Documents of a source stand in order of size (then a bucket of the id, the id
and the text's hash). With k the running number of a document and u one random offset of the source, the
document is emitted once per integer in (u + rate * (k - 1), u + rate * k], so
copies differ by at most one within a source. The order by size makes
the sample even over sizes: a source's words miss its target by about its longest document at most.

Targets: sources by code point, null last, get `weights` in turn. They share
`share` times all sizes by weight; a target stops at `most_copies` times its source's
size and the excess goes to the others by weight, until none is above. That is one water level:
target = least(level * weight, most_copies * size).

The running number needs no sort of a whole source: counts per (source, size,
bucket) give each bucket's first number, `row_number` within the bucket the rest. Buckets are
taken by hash of the id, so neither a hot source nor a hot size lands in one task.

Defined cases: null or word-less texts have size 0 and words taken 0 (they are still sampled at their
source's rate; a source of size 0 has rate 0). A null source is a source of its own. Rows that repeat id, source
and size are interchangeable; each is numbered. An empty table gives no row. Columns of the
input that are named like outputs are replaced in `copies_frame` and kept in `emit`; any other name passes through. An id that stands for many rows of one size and source has
them numbered in one task (rows of different sizes are apart). `targets` numbers the sources in one task: a row a source, far below the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from forgeline.llm.common import SPACED_WORD

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2
BUCKETS = 256
SEED = "mix-1"


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
            most_copies: int = MOST_COPIES, seed: str = SEED) -> DataFrame:
    """One row per source: source, source_size, target, rate, u. `sizes` has (source, source_size), one row per source."""
    w = ", ".join(str(int(x)) for x in weights)
    return sizes.selectExpr(
        "source", "source_size",
        f"array({w})[(row_number() over (order by source nulls last) - 1) % {len(weights)}] as weight",
    ).selectExpr(
        "*", f"cast({most_copies} * source_size as double) as cap",
        f"cast({share} as double) * sum(source_size) over () as total", "sum(weight) over () as all_weight",
    ).selectExpr(
        "*", "cap / weight as fills_at",
        "coalesce(sum(source_size) over (order by cap / weight, source nulls last"
        " rows between unbounded preceding and 1 preceding), 0) as size_before",
        "coalesce(sum(weight) over (order by cap / weight, source nulls last"
        " rows between unbounded preceding and 1 preceding), 0) as weight_before",
    ).selectExpr(
        "*", f"(total - {most_copies} * size_before) / (all_weight - weight_before) as level_here",
    ).selectExpr(
        "*", "min(if(level_here <= fills_at, struct(fills_at, source is null as last, source, level_here), null))"
             " over () as first_free",
    ).selectExpr(
        "source", "source_size", "least(coalesce(first_free.level_here * weight, cap), cap) as target",
    ).selectExpr(
        "*", "if(source_size = 0, 0D, target / source_size) as rate",
        f"cast(conv(substr(md5(concat('{seed}', coalesce(source, ''))), 1, 4), 16, 10) as double) / 65536 as u",
    )


def copies_frame(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                 buckets: int = BUCKETS, **target_options) -> DataFrame:
    """`docs` with size, source_size, target, copies and taken for each row; reruns agree."""
    # columns of the input go by position, so no name of theirs meets an own one
    own = ("size", "source_size", "target", "copies", "taken")
    names = list(docs.columns)
    at = {n.lower(): f"c{i}" for i, n in enumerate(names)}
    id_at, text_at, source_at = (at[c.lower()] for c in (id_col, text_col, source_col))
    kept = [f"c{i}" for i, n in enumerate(names) if n.lower() not in own]
    sized = docs.toDF(*[f"c{i}" for i in range(len(names))]).selectExpr(
        "*", f"cast({source_at} as string) as src",
        f"cast(coalesce(regexp_count({text_at}, '{SPACED_WORD}'), 0) as bigint) as size",
        f"pmod(cast(conv(substr(md5(coalesce(cast({id_at} as string), '')), 1, 8), 16, 10) as bigint), {buckets}) as bucket",
    )
    counts = sized.groupBy("src", "size", "bucket").count()
    # numbers before a size (windows hold one row per size of a source), then before a bucket of it
    sizes = counts.groupBy("src", "size").agg({"count": "sum"}).toDF("s_src", "s_size", "n").selectExpr(
        "s_src", "s_size", "coalesce(sum(n) over (partition by s_src order by s_size"
                           " rows between unbounded preceding and 1 preceding), 0) as s_before")
    inside = counts.selectExpr(
        "src as f_src", "size as f_size", "bucket as f_bucket",
        "coalesce(sum(count) over (partition by src, size order by bucket"
        " rows between unbounded preceding and 1 preceding), 0) as b_before")
    first = inside.join(sizes, inside.f_src.eqNullSafe(sizes.s_src) & (inside.f_size == sizes.s_size)).selectExpr(
        "f_src", "f_size", "f_bucket", "s_before + b_before as before")
    per_source = counts.selectExpr("src", "size * count as words").groupBy("src").sum("words")
    goals = targets(per_source.toDF("source", "source_size"), **target_options)
    goals = goals.selectExpr("source as g_src", "source_size", "target", "rate", "u")
    plan = first.join(goals, first.f_src.eqNullSafe(goals.g_src)).drop("g_src")
    numbered = sized.selectExpr(
        "*", f"row_number() over (partition by src, size, bucket order by {id_at}, xxhash64({text_at})) as number")
    on = (numbered.src.eqNullSafe(plan.f_src) & (numbered["size"] == plan.f_size) & (numbered.bucket == plan.f_bucket))
    return numbered.join(plan, on).selectExpr(
        *kept, "size", "source_size", "target",
        "cast(least(floor(u + rate * (before + number)) - floor(u + rate * (before + number - 1)), ceil(rate))"
        " as int) as copies",
    ).selectExpr("*", "copies * size as taken").toDF(*[names[int(c[1:])] for c in kept], *own)


def emit(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of `docs` as often as it is taken, with the columns of `docs`."""
    names = list(docs.columns)
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at = {n.lower(): f"c{i}" for i, n in enumerate(names)}
    mixed = copies_frame(inner, id_col=at[options.pop("id_col", "doc_id")], text_col=at[options.pop("text_col", "text")],
                         source_col=at[options.pop("source_col", "source")], **options)
    return mixed.where("copies > 0").selectExpr("*", "explode(sequence(1, copies)) as _copy").selectExpr(
        *[f"c{i} as `{n}`" for i, n in enumerate(names)])
