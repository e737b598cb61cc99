"""The whole Bronze -> staging -> silver -> gold chain as lazy DataFrames.

Nothing runs until an action: Catalyst sees each requested model as one plan,
prunes unused columns down to the Parquet scan and pushes filters as far as
the window functions allow. Frames are built on first use only (building a
DataFrame analyses it on the driver, which is not free).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from forgeline.plans import gold, silver, staging
from forgeline.sources import fixtures, tables

STAGING_MODELS = ("stg_repo_metadata", "stg_issue_or_pr", "stg_commit")
SILVER_MODELS = ("dim_repos", "fct_issues", "fct_pull_requests", "fct_commits")
GOLD_MODELS = ("repo_daily_metrics", "repo_daily_metrics_joined", "activity_spine", "repo_health_snapshot")

BRONZE_OF = {"stg_repo_metadata": "repo_metadata", "stg_issue_or_pr": "issue_or_pr", "stg_commit": "commit"}
STAGING_FN = {"stg_repo_metadata": staging.stg_repo_metadata, "stg_issue_or_pr": staging.stg_issue_or_pr,
               "stg_commit": staging.stg_commit}
_SILVER_FN = {"dim_repos": ("stg_repo_metadata", silver.dim_repos),
              "fct_issues": ("stg_issue_or_pr", silver.fct_issues),
              "fct_pull_requests": ("stg_issue_or_pr", silver.fct_pull_requests),
              "fct_commits": ("stg_commit", silver.fct_commits)}


class Models:
    """Lazily built model frames over one Bronze input (three record kinds).

    ``as_of`` ends the trailing window of the health table; None is the current date.
    """

    def __init__(self, bronze: dict[str, DataFrame] | Callable[[str], DataFrame], as_of=None):
        self._bronze_src = bronze
        self.as_of = as_of
        self._cache: dict[str, DataFrame] = {}

    @classmethod
    def from_events(cls, spark: SparkSession, sf_dir: str, as_of=None) -> Models:
        events: list[DataFrame] = []

        def bronze(kind: str) -> DataFrame:
            if not events:  # one scan definition shared by the three record kinds
                events.append(tables.events(spark, sf_dir))
            return fixtures.bronze_from_events_kind(events[0], kind)
        return cls(bronze, as_of)

    def _memo(self, key: str, build: Callable[[], DataFrame]) -> DataFrame:
        if key not in self._cache:
            self._cache[key] = build()
        return self._cache[key]

    def bronze(self, kind: str) -> DataFrame:
        src = self._bronze_src
        return self._memo("bronze:" + kind, lambda: src[kind] if isinstance(src, dict) else src(kind))

    def stg(self, name: str) -> DataFrame:
        return self._memo(name, lambda: STAGING_FN[name](self.bronze(BRONZE_OF[name])))

    def silver(self, name: str) -> DataFrame:
        stg_name, fn = _SILVER_FN[name]
        return self._memo(name, lambda: fn(self.stg(stg_name)))

    def facts(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return self.silver("fct_issues"), self.silver("fct_pull_requests"), self.silver("fct_commits")

    def activity(self) -> DataFrame:
        """Narrow activity rows from the one-pass issue/PR dedup plus commits."""
        return self._memo("activity", lambda: gold.activity_combined(
            silver.issue_or_pr_latest(self.stg("stg_issue_or_pr")), self.silver("fct_commits")))

    def repo_daily_metrics(self) -> DataFrame:
        return gold.daily_metrics_from_activity(self.activity())

    def repo_daily_metrics_joined(self) -> DataFrame:
        """The daily metrics as three aggregates joined to the keys of all activity."""
        return gold.daily_metrics_joined(*self.facts())

    def activity_spine(self) -> DataFrame:
        """Distinct (repo, day) keys of the one-pass activity rows."""
        return self.activity().select("repo_full_name", "day").distinct()

    def repo_health_snapshot(self, as_of=None) -> DataFrame:
        recent = gold.recent_from_activity(self.activity(), as_of or self.as_of)
        return gold.health_from_recent(self.silver("dim_repos"), recent)

    def table(self, name: str) -> DataFrame:
        if name in STAGING_FN:
            return self.stg(name)
        if name in _SILVER_FN:
            return self.silver(name)
        return getattr(self, name)()
