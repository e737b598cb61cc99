"""Upsert of a serving table (gold -> mart), with exact change detection.

``MERGE INTO`` needs a table format that supports it (Parquet does not), so the
upsert is expressed as a join and a rewrite:

* one full outer join of the current mart and the fresh rows on the key
  (both sides are shuffled once on the key; AQE splits a skewed key range);
* a row is ``insert`` when only fresh, ``update`` when both exist and any value
  differs (null-safe ``<=>`` on every column -- exact, no hash collisions),
  ``unchanged`` when all values are equal, ``retained`` when only in the mart
  (an upsert never deletes);
* the merged frame is written to a new version folder; sinks that take
  changes only (JDBC staging tables, message topics) get the
  ``insert``/``update`` rows from :func:`changes`.

In a stream the same function runs per micro-batch in ``foreachBatch``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OP_COLUMN = "change_op"


def _all_equal(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(f"_new.{c}").eqNullSafe(F.col(f"_old.{c}"))
    return cond


def upsert_frame(current: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merged table with a ``change_op`` column (see module doc)."""
    value_cols = [c for c in fresh.columns if c not in keys]
    new_present = F.col("_new_present").isNotNull()
    old_present = F.col("_old_present").isNotNull()
    joined = (fresh.withColumn("_new_present", F.lit(1)).alias("_new")
              .join(current.withColumn("_old_present", F.lit(1)).alias("_old"), list(keys), "full_outer"))
    op = (F.when(new_present & ~old_present, "insert")
          .when(~new_present & old_present, "retained")
          .when(_all_equal(value_cols), "unchanged")
          .otherwise("update"))
    picked = [F.when(new_present, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c) for c in value_cols]
    return joined.select(*keys, *picked, op.alias(OP_COLUMN))


def changes(merged: DataFrame) -> DataFrame:
    """Only the rows a change-based sink must receive."""
    return merged.filter(F.col(OP_COLUMN).isin("insert", "update"))


def write_version(merged: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Persist the merged table as a new immutable version (readers switch atomically)."""
    merged.drop(OP_COLUMN).write.mode("overwrite").format(fmt).option("compression", "zstd").save(path)


def write_jdbc_staging(rows: DataFrame, url: str, table: str, properties: dict | None = None) -> None:
    """Append changed rows to a staging table of a relational mart (the mart merges
    from staging on its side). Requires the JDBC driver on the classpath."""
    rows.write.mode("append").jdbc(url, table, properties=properties or {})
