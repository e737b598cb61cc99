"""Join helpers with an explicit, checked broadcast decision.

A side is broadcast only when its size is bounded by construction (a limit)
or measured below a threshold from Catalyst's statistics; otherwise the join
is left to the planner (sort-merge, AQE may still convert it at run time with
real sizes, and splits skewed partitions).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_rows(df: DataFrame) -> int | None:
    """A row bound proven by the plan (e.g. ``limit``), if Catalyst knows one."""
    opt = df._jdf.queryExecution().optimizedPlan().maxRows()
    return int(opt.get()) if opt.isDefined() else None


def maybe_broadcast(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Mark ``df`` for broadcast only when the plan proves a small row bound.

    Without such a bound the decision stays with Spark: the planner's
    ``autoBroadcastJoinThreshold`` on estimated size, and AQE on the measured
    size of the materialised shuffle at run time.
    """
    rows = bounded_rows(df)
    if rows is not None and rows <= max_rows:
        return F.broadcast(df)
    return df


def semi_join_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key appears in ``keys`` (keys de-duplicated by the join itself)."""
    return df.join(maybe_broadcast(keys), list(on), "left_semi")


def anti_join_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(maybe_broadcast(keys), list(on), "left_anti")
