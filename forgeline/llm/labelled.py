"""Bounded samples of labelled documents for fitting, outside the held-out fold.

The bounds are parameters: rows of each label, and bytes of text of each label. Rows are taken by the hash of their id until either is
reached; the row that crosses the bytes is taken whole, so a sample holds at most the bytes and one text beyond. No text is left out for its
length. Of an id that stands for several texts the one of the smallest MD5 counts, so no id brings more than one text, and reruns agree.

Defined cases: rows without id, label or text, and labels that are not asked for, take no part; empty texts do. Ids with several labels give one row a label.
Empty tables give an empty sample. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.llm.common import HELD_OUT

#: Bytes of text of each label that a sample may hold.
SAMPLE_BYTES = 16_000_000


def sample_by_label(docs: DataFrame, labels: DataFrame, label: str, per_label: dict[int, int], salt: str,
                    id_col: str = "doc_id", text_col: str = "text", sample_bytes: int = SAMPLE_BYTES
                    ) -> tuple[list[tuple[bytes, int]], dict[int, int]]:
    """([(text, label)], {label: rows of that label in all}): at most per_label[label] distinct texts of each label.

    `label` is an SQL expression over `labels`. Ids are chosen by hash before any text is read, so the join broadcasts
    at most the sum of `per_label` ids.
    """
    known = labels.selectExpr(f"`{id_col}` as _id", f"cast({label} as int) as _label").where(
        f"_id is not null and _label is not null and not {HELD_OUT.format('_id')}")
    totals = {r["_label"]: r["count"] for r in known.groupBy("_label").count().where(
        F.col("_label").isin(list(per_label))).collect()}
    order = F.expr(f"md5(concat('{salt}', cast(_id as string)))")
    chosen = reduce(DataFrame.unionByName, (
        known.where(F.col("_label") == value).distinct().orderBy(order).limit(most) for value, most in per_label.items()))
    found = docs.selectExpr(f"`{id_col}` as doc_id", f"cast(cast(`{text_col}` as string) as binary) as text").where("text is not null").join(
        F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    # one row for each chosen id and label from here on
    each = found.groupBy("_id", "_label").agg(F.expr("min(struct(md5(text) as digest, text)).text as text")).withColumn("_order", order)
    before = "sum(octet_length(text)) over (partition by _label order by _order, _id rows between unbounded preceding and 1 preceding)"
    rows = each.withColumn("_before", F.expr(f"coalesce({before}, 0)")).where(F.col("_before") < sample_bytes)
    return sorted({(bytes(r["text"]), r["_label"]) for r in rows.select("text", "_label").collect()}), totals
