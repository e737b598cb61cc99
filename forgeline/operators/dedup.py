"""Latest version per key (``row_number() ... = 1``).

Spark plans ``row_number() over (partition by keys order by ...) = 1`` with a
partial ``WindowGroupLimit`` before the exchange: every map task keeps one row
per key, so a key holding a third of all rows ships at most one row per task.
The final sort after the shuffle sees (number of map tasks) rows per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgeline.functions.columns import col_


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
              rn_col: str = "_rn") -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (give ``desc`` columns).

    ``order`` should end in a column that is unique within a key, so that the
    choice is deterministic (the reference orders by ``fetched_at`` alone).
    """
    w = Window.partitionBy(*keys).orderBy(*[col_(c) for c in order])
    return df.withColumn(rn_col, F.row_number().over(w)).filter(F.col(rn_col) == 1).drop(rn_col)


def latest_by_fetch(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Latest by ``fetched_at desc`` with the landing sequence as tie-break."""
    return latest_by(df, keys, [F.col("fetched_at").desc_nulls_last(), F.col("ingest_seq").desc_nulls_last()])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once (partial aggregation before the shuffle)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)
