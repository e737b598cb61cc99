"""Staging -> silver: current-state dimension and fact tables.

Each model filters first (the ``is_pull_request`` predicate must stay below
the window: a key whose flag flips between versions then appears in both
facts, as in the reference), keeps the latest version per key and selects the
published columns. ``raw_payload`` is never selected, so the scan prunes it
and it does not ride through the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from forgeline.operators.dedup import latest_by_fetch

DIM_REPOS_COLUMNS = [
    "repo_full_name", "repo_name", "owner_login", "description", "stargazers_count", "forks_count",
    "open_issues_count", "watchers_count", "default_branch", "language", "license_spdx", "archived",
    "disabled", "is_fork", "repo_created_at", "repo_updated_at", "last_pushed_at", "snapshot_at",
]
FCT_ISSUES_COLUMNS = [
    "repo_full_name", "issue_number", "state", "title", "author_login", "locked", "labels", "assignees",
    "comments", "created_at", "updated_at", "closed_at", "fetched_at",
]
FCT_PRS_COLUMNS = [c if c != "issue_number" else "pr_number" for c in FCT_ISSUES_COLUMNS if c != "locked"]
FCT_COMMITS_COLUMNS = [
    "repo_full_name", "sha", "message", "author_login", "author_email", "authored_date",
    "committer_login", "committer_email", "committed_date", "parent_count", "fetched_at",
]


def dim_repos(stg_repo: DataFrame) -> DataFrame:
    return dim_repos_of(latest_by_fetch(stg_repo, ["repo_full_name"]))


def dim_repos_of(latest: DataFrame) -> DataFrame:
    return latest.selectExpr(
        "repo_full_name", "repo_name", "owner_login", "description", "stargazers_count", "forks_count",
        "open_issues_count", "watchers_count", "default_branch", "language", "license_spdx", "archived",
        "disabled", "fork AS is_fork", "created_at AS repo_created_at", "updated_at AS repo_updated_at",
        "pushed_at AS last_pushed_at", "fetched_at AS snapshot_at",
    )


def issue_or_pr_latest(stg_issue_or_pr: DataFrame) -> DataFrame:
    """Latest version per (repo, number) *within each kind*, both kinds in one pass.

    Keying the window by ``is_pull_request`` as well is the same as filtering
    first and deduplicating each kind (the reference's plan), but needs one
    scan and one shuffle for both facts. Rows with a NULL flag form their own
    group and belong to neither fact.
    """
    return latest_by_fetch(stg_issue_or_pr, ["repo_full_name", "number", "is_pull_request"])


def _issue_like(stg: DataFrame, is_pr: bool) -> DataFrame:
    # a predicate on a window partition key: Catalyst evaluates it below the window
    return issue_or_pr_latest(stg).where(f"is_pull_request = {str(is_pr).lower()}")


def fct_issues(stg_issue_or_pr: DataFrame) -> DataFrame:
    return fct_issues_of(_issue_like(stg_issue_or_pr, False))


def fct_issues_of(latest: DataFrame) -> DataFrame:
    return latest.where("NOT is_pull_request").selectExpr(
        "repo_full_name", "number AS issue_number", "state", "title", "user_login AS author_login", "locked",
        "labels", "assignees", "comments", "created_at", "updated_at", "closed_at", "fetched_at",
    )


def fct_pull_requests(stg_issue_or_pr: DataFrame) -> DataFrame:
    return fct_pull_requests_of(_issue_like(stg_issue_or_pr, True))


def fct_pull_requests_of(latest: DataFrame) -> DataFrame:
    return latest.where("is_pull_request").selectExpr(
        "repo_full_name", "number AS pr_number", "state", "title", "user_login AS author_login",
        "labels", "assignees", "comments", "created_at", "updated_at", "closed_at", "fetched_at",
    )


def fct_commits(stg_commit: DataFrame) -> DataFrame:
    return fct_commits_of(latest_by_fetch(stg_commit, ["repo_full_name", "sha"]))


def fct_commits_of(latest: DataFrame) -> DataFrame:
    return latest.selectExpr(
        "repo_full_name", "sha", "message", "author_login", "author_email", "authored_date",
        "committer_login", "committer_email", "committed_date", "cardinality(parents) AS parent_count",
        "fetched_at",
    )


def silver(stg: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "dim_repos": dim_repos(stg["stg_repo_metadata"]),
        "fct_issues": fct_issues(stg["stg_issue_or_pr"]),
        "fct_pull_requests": fct_pull_requests(stg["stg_issue_or_pr"]),
        "fct_commits": fct_commits(stg["stg_commit"]),
    }


def from_latest(latest: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The same tables from the latest versions, by record kind (those kinds that are there)."""
    out = {}
    if "repo_metadata" in latest:
        out["dim_repos"] = dim_repos_of(latest["repo_metadata"])
    if "issue_or_pr" in latest:
        out["fct_issues"] = fct_issues_of(latest["issue_or_pr"])
        out["fct_pull_requests"] = fct_pull_requests_of(latest["issue_or_pr"])
    if "commit" in latest:
        out["fct_commits"] = fct_commits_of(latest["commit"])
    return out
