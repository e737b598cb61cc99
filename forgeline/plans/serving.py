"""Serving queries over the gold tables (what the dashboard reads).

Results stay DataFrames; a caller collects only the final, small result.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forgeline.functions.columns import ntz_literal, parse_target_list
from forgeline.operators.joins import semi_join_keys

SERIES_METRICS = ("commits", "prs_opened", "issues_opened")


def dashboard_kpis(health: DataFrame) -> DataFrame:
    """One row: repos tracked, total stars, trailing commits and PRs (one aggregation pass)."""
    return health.agg(
        F.count(F.lit(1)).alias("repos_tracked"),
        F.sum("stargazers_count").cast("bigint").alias("total_stars"),
        F.sum("recent_commits_28d").cast("bigint").alias("recent_commits_28d"),
        F.sum("recent_prs_28d").cast("bigint").alias("recent_prs_28d"),
    )


def health_by_stars(health: DataFrame) -> DataFrame:
    """The overview list, most-starred first (name breaks ties; NULL stars last)."""
    return health.orderBy(F.col("stargazers_count").desc_nulls_last(), F.col("repo_full_name").asc())


def top_repos(health: DataFrame, k: int = 5) -> DataFrame:
    """Default selection: the ``k`` most-starred repos, with their rank.

    ``orderBy().limit(k)`` plans as ``TakeOrderedAndProject``: each task keeps
    its own top ``k`` and only those reach the final merge. The rank is
    numbered after the limit, over at most ``k`` rows.
    """
    top = health_by_stars(health).limit(k).select("repo_full_name", "stargazers_count")
    w = Window.orderBy(F.col("stargazers_count").desc_nulls_last(), F.col("repo_full_name").asc())
    return top.withColumn("star_rank", F.row_number().over(w).cast("bigint"))


def select_repos(df: DataFrame, repos: str | Sequence[str] | DataFrame, column: str = "repo_full_name") -> DataFrame:
    """``repo_full_name IN (...)`` for a user selection.

    A text value is parsed like the target list (comma split, trim, drop
    blanks). Lists become an ``isin`` pushed to the scan; a DataFrame of keys
    becomes a semi join (broadcast only when its size is known to be small).
    """
    if isinstance(repos, DataFrame):
        return semi_join_keys(df, repos.select(F.col(repos.columns[0]).alias(column)), [column])
    names = parse_target_list(repos) if isinstance(repos, str) else [r for r in repos if r]
    return df.filter(F.col(column).isin(names))


def activity_series(daily: DataFrame, repos: str | Sequence[str] | DataFrame, ordered: bool = True) -> DataFrame:
    """Daily counts of the selected repos, melted to ``(repo, day, metric, count)``,
    in day order for the chart (the order is presentation; the selection is small)."""
    picked = select_repos(daily, repos).select("repo_full_name", "day", *SERIES_METRICS)
    melted = picked.unpivot(["repo_full_name", "day"], list(SERIES_METRICS), "metric", "count")
    return melted.orderBy("day", "repo_full_name", "metric") if ordered else melted


def default_activity_series(daily: DataFrame, health: DataFrame, k: int = 5) -> DataFrame:
    """The dashboard's default chart: series of the top-``k`` repos by stars."""
    return activity_series(daily, top_repos(health, k).select("repo_full_name"))


def updated_since(df: DataFrame, since, column: str = "updated_at") -> DataFrame:
    """Rows changed at or after ``since`` (a UTC instant; default look-back applied by the caller)."""
    return df.filter(F.col(column) >= ntz_literal(since))


def look_back_start(as_of, days: int = 7) -> _dt.datetime:
    """``as_of`` minus ``days`` at midnight (the ingest default is seven days)."""
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return _dt.datetime.combine(as_of - _dt.timedelta(days=days), _dt.time())


def of_targets(records: DataFrame, targets: DataFrame, condition: str = "true") -> DataFrame:
    """Records of the repositories in a target table (owner, repo), over Bronze partitioned by owner and repo.

    ``condition`` picks targets: a comparison over columns of the target table (Spark prunes for those, not for a bare boolean column). The join is on the partition columns, so Spark evaluates the small side first and reads only
    the folders of its repositories (dynamic partition pruning); a target table too large to broadcast is joined by shuffle.
    """
    wanted = targets.where(condition).select("owner", "repo")
    return records.join(wanted, ["owner", "repo"], "left_semi")
