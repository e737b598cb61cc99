"""Declared schemas: raw payloads, Bronze records, silver and gold tables.

Bronze keeps timestamps as ISO strings (as landed); staging casts them.
``ingest_seq`` is our addition: a landing sequence number that breaks ties
between two versions of a key fetched at the same instant.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------- raw payloads
# Field types of the wire format; from_json ignores keys not listed here.
RAW_REPO_DDL = (
    "full_name string, name string, owner struct<login: string>, description string, "
    "stargazers_count bigint, forks_count bigint, open_issues_count bigint, watchers_count bigint, "
    "subscribers_count bigint, network_count bigint, default_branch string, language string, "
    "license struct<spdx_id: string>, archived boolean, disabled boolean, fork boolean, "
    "created_at string, updated_at string, pushed_at string"
)

RAW_ISSUE_DDL = (
    "number bigint, state string, title string, user struct<login: string>, "
    "locked boolean, labels array<struct<name: string>>, assignees array<struct<login: string>>, "
    "comments bigint, created_at string, updated_at string, closed_at string, pull_request variant"
)

RAW_COMMIT_DDL = (
    "sha string, author struct<login: string>, committer struct<login: string>, "
    "parents array<struct<sha: string>>, "
    "commit struct<message: string, author: struct<email: string, date: string>, "
    "committer: struct<email: string, date: string>>"
)

# ---------------------------------------------------------------- Bronze records
REPO_METADATA = T.StructType([
    T.StructField("full_name", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("owner_login", T.StringType(), False),
    T.StructField("description", T.StringType(), True),
    T.StructField("stargazers_count", T.LongType(), True),
    T.StructField("forks_count", T.LongType(), True),
    T.StructField("open_issues_count", T.LongType(), True),
    T.StructField("watchers_count", T.LongType(), True),
    T.StructField("subscribers_count", T.LongType(), True),
    T.StructField("network_count", T.LongType(), True),
    T.StructField("default_branch", T.StringType(), True),
    T.StructField("language", T.StringType(), True),
    T.StructField("license_spdx", T.StringType(), True),
    T.StructField("archived", T.BooleanType(), True),
    T.StructField("disabled", T.BooleanType(), True),
    T.StructField("fork", T.BooleanType(), True),
    T.StructField("created_at", T.StringType(), True),
    T.StructField("updated_at", T.StringType(), True),
    T.StructField("pushed_at", T.StringType(), True),
    T.StructField("fetched_at", T.StringType(), False),
    T.StructField("raw_payload", T.StringType(), True),
    T.StructField("ingest_seq", T.LongType(), True),
])

ISSUE_OR_PR = T.StructType([
    T.StructField("repo_full_name", T.StringType(), False),
    T.StructField("number", T.LongType(), False),
    T.StructField("state", T.StringType(), False),
    T.StructField("title", T.StringType(), False),
    T.StructField("user_login", T.StringType(), True),
    T.StructField("is_pull_request", T.BooleanType(), False),
    T.StructField("locked", T.BooleanType(), True),
    T.StructField("labels", T.ArrayType(T.StringType()), True),
    T.StructField("assignees", T.ArrayType(T.StringType()), True),
    T.StructField("comments", T.LongType(), True),
    T.StructField("created_at", T.StringType(), False),
    T.StructField("updated_at", T.StringType(), False),
    T.StructField("closed_at", T.StringType(), True),
    T.StructField("fetched_at", T.StringType(), False),
    T.StructField("raw_payload", T.StringType(), True),
    T.StructField("ingest_seq", T.LongType(), True),
])

COMMIT = T.StructType([
    T.StructField("repo_full_name", T.StringType(), False),
    T.StructField("sha", T.StringType(), False),
    T.StructField("message", T.StringType(), False),
    T.StructField("author_login", T.StringType(), True),
    T.StructField("author_email", T.StringType(), True),
    T.StructField("authored_date", T.StringType(), True),
    T.StructField("committer_login", T.StringType(), True),
    T.StructField("committer_email", T.StringType(), True),
    T.StructField("committed_date", T.StringType(), True),
    T.StructField("parents", T.ArrayType(T.StringType()), True),
    T.StructField("fetched_at", T.StringType(), False),
    T.StructField("raw_payload", T.StringType(), True),
    T.StructField("ingest_seq", T.LongType(), True),
])

BRONZE_SCHEMAS = {
    "repo_metadata": REPO_METADATA,
    "issue_or_pr": ISSUE_OR_PR,
    "commit": COMMIT,
}

# Repo key column of each Bronze record kind (used for owner/repo partitions).
REPO_KEY = {"repo_metadata": "full_name", "issue_or_pr": "repo_full_name", "commit": "repo_full_name"}

# The accepted issue / pull request states.
ACCEPTED_STATES = ("open", "closed")

# Defaults applied when a key is absent from a payload.
REPO_DEFAULTS = {
    "stargazers_count": 0, "forks_count": 0, "open_issues_count": 0, "watchers_count": 0,
    "subscribers_count": 0, "network_count": 0, "default_branch": "main",
    "archived": False, "disabled": False, "fork": False,
}
ISSUE_DEFAULTS = {"locked": False, "comments": 0}
COMMIT_DEFAULTS = {"message": ""}


def nullable(schema: T.StructType) -> T.StructType:
    """Same fields, all nullable (Parquet readers report nullable columns)."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
