"""Bronze -> staging: type casts and renames (lazy views, nothing persisted).

``cast(x as timestamp)`` of the reference becomes ``timestamp_ntz``: Bronze
timestamps are naive UTC wall-clock values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def _ts(c: str) -> str:
    return f"CAST({c} AS TIMESTAMP_NTZ) AS {c}"


STG_REPO_METADATA = [
    "full_name AS repo_full_name", "name AS repo_name",
    "owner_login", "description", "stargazers_count", "forks_count", "open_issues_count",
    "watchers_count", "subscribers_count", "network_count", "default_branch", "language",
    "license_spdx", "archived", "disabled", "fork",
    _ts("created_at"), _ts("updated_at"), _ts("pushed_at"), _ts("fetched_at"),
    "raw_payload", "ingest_seq",
]

STG_ISSUE_OR_PR = [
    "repo_full_name", "number", "state", "title", "user_login", "is_pull_request", "locked",
    "labels", "assignees", "comments",
    _ts("created_at"), _ts("updated_at"), _ts("closed_at"), _ts("fetched_at"),
    "raw_payload", "ingest_seq",
]

STG_COMMIT = [
    "repo_full_name", "sha", "message", "author_login", "author_email", _ts("authored_date"),
    "committer_login", "committer_email", _ts("committed_date"), "parents", _ts("fetched_at"),
    "raw_payload", "ingest_seq",
]


def stg_repo_metadata(bronze: DataFrame) -> DataFrame:
    return bronze.selectExpr(*STG_REPO_METADATA)


def stg_issue_or_pr(bronze: DataFrame) -> DataFrame:
    return bronze.selectExpr(*STG_ISSUE_OR_PR)


def stg_commit(bronze: DataFrame) -> DataFrame:
    return bronze.selectExpr(*STG_COMMIT)


def staging(bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "stg_repo_metadata": stg_repo_metadata(bronze["repo_metadata"]),
        "stg_issue_or_pr": stg_issue_or_pr(bronze["issue_or_pr"]),
        "stg_commit": stg_commit(bronze["commit"]),
    }
