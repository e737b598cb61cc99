"""Edge rows for dedup and gold arithmetic (hand-made Bronze frames)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Row

from forgeline import schemas
from forgeline.plans import gold
from forgeline.plans.medallion import Models


def _issue(repo, number, *, is_pr=False, state="open", created="2024-01-10T10:00:00Z", closed=None,
           fetched="2024-01-10T12:00:00Z", seq=1, user="u1"):
    return Row(repo_full_name=repo, number=number, state=state, title=f"t{number}", user_login=user,
               is_pull_request=is_pr, locked=False, labels=[], assignees=[], comments=0, created_at=created,
               updated_at=created, closed_at=closed, fetched_at=fetched, raw_payload="{}", ingest_seq=seq)


def _commit(repo, sha, *, author="a", committed="2024-01-10T09:00:00Z", fetched="2024-01-10T12:00:00Z", seq=1,
            parents=("p",)):
    return Row(repo_full_name=repo, sha=sha, message="m", author_login=author, author_email=None,
               authored_date=committed, committer_login=None, committer_email=None, committed_date=committed,
               parents=list(parents) if parents is not None else None, fetched_at=fetched, raw_payload="{}",
               ingest_seq=seq)


def _repo(full, stars, fetched, seq=1):
    return Row(full_name=full, name=full.split("/")[1], owner_login=full.split("/")[0], description=None,
               stargazers_count=stars, forks_count=0, open_issues_count=0, watchers_count=0,
               subscribers_count=0, network_count=0, default_branch="main", language=None, license_spdx=None,
               archived=False, disabled=False, fork=False, created_at=None, updated_at=None, pushed_at=None,
               fetched_at=fetched, raw_payload="{}", ingest_seq=seq)


def _models(spark, repos=(), issues=(), commits=(), as_of="2024-01-31"):
    def frame(rows, kind):
        schema = schemas.nullable(schemas.BRONZE_SCHEMAS[kind])
        return spark.createDataFrame(list(rows), schema)
    return Models({"repo_metadata": frame(repos, "repo_metadata"), "issue_or_pr": frame(issues, "issue_or_pr"),
                   "commit": frame(commits, "commit")}, as_of=as_of)


def test_latest_version_and_tie_break(spark):
    m = _models(spark, repos=[_repo("o/a", 1, "2024-01-01T00:00:00Z", 1), _repo("o/a", 2, "2024-01-02T00:00:00Z", 2),
                              _repo("o/a", 3, "2024-01-02T00:00:00Z", 3)])
    rows = m.silver("dim_repos").collect()
    assert len(rows) == 1 and rows[0]["stargazers_count"] == 3  # same fetched_at: higher ingest_seq wins


def test_pr_flag_flip_lands_in_both_facts(spark):
    m = _models(spark, issues=[_issue("o/a", 7, is_pr=False, fetched="2024-01-10T00:00:00Z", seq=1),
                               _issue("o/a", 7, is_pr=True, fetched="2024-01-11T00:00:00Z", seq=2)])
    assert m.silver("fct_issues").count() == 1
    assert m.silver("fct_pull_requests").count() == 1


def test_closed_same_day_midnight_boundaries(spark):
    m = _models(spark, issues=[
        _issue("o/a", 1, created="2024-01-10T00:00:00Z", closed="2024-01-10T23:59:59Z", seq=1),
        _issue("o/a", 2, created="2024-01-10T00:00:00Z", closed="2024-01-11T00:00:00Z", seq=2),
        _issue("o/a", 3, created="2024-01-10T05:00:00Z", closed=None, seq=3),
    ])
    row = m.repo_daily_metrics().collect()[0]
    assert (row["issues_opened"], row["issues_closed_same_day"]) == (3, 1)


def test_single_pass_equals_joined_plan(spark):
    m = _models(spark,
                issues=[_issue("o/a", 1, seq=1), _issue("o/a", 2, is_pr=True, state="closed", seq=2),
                        _issue("o/b", 3, created="2024-01-12T01:00:00Z", seq=3)],
                commits=[_commit("o/a", "s1", seq=1), _commit("o/a", "s2", author=None, seq=2),
                         _commit("o/c", "s3", committed=None, seq=3), _commit("o/c", "s4", seq=4)])
    a = sorted(map(tuple, m.repo_daily_metrics().collect()))
    b = sorted(map(tuple, m.repo_daily_metrics_joined().select(*gold.DAILY_COLUMNS).collect()))
    assert a == b
    by_key = {(r[0], r[1]): r for r in a}
    assert by_key[("o/a", dt.date(2024, 1, 10))][6:] == (2, 1)  # NULL author ignored by distinct count
    assert ("o/c", None) not in by_key  # commit without a date has no spine row


def test_health_window_is_inclusive_without_upper_bound(spark):
    m = _models(spark,
                repos=[_repo("o/a", 5, "2024-01-30T00:00:00Z"), _repo("o/quiet", 1, "2024-01-30T00:00:00Z")],
                commits=[_commit("o/a", "edge", committed="2024-01-03T00:00:00Z", seq=1),
                         _commit("o/a", "before", committed="2024-01-02T23:59:59Z", seq=2),
                         _commit("o/a", "future", committed="2024-02-05T00:00:00Z", seq=3),
                         _commit("o/nometa", "x", committed="2024-01-20T00:00:00Z", seq=4)])
    rows = {r["repo_full_name"]: r for r in m.repo_health_snapshot().collect()}
    assert set(rows) == {"o/a", "o/quiet"}          # activity without metadata drops out
    assert rows["o/a"]["recent_commits_28d"] == 2   # edge (inclusive) + future (no upper bound)
    assert rows["o/quiet"]["recent_commits_28d"] == 0
    daily = {r["repo_full_name"] for r in m.repo_daily_metrics().collect()}
    assert "o/nometa" in daily                      # ... but stays in the daily table


def test_parent_count_null_array(spark):
    m = _models(spark, commits=[_commit("o/a", "s", parents=None), _commit("o/a", "t", parents=(), seq=2)])
    counts = {r["sha"]: r["parent_count"] for r in m.silver("fct_commits").collect()}
    assert counts == {"s": None, "t": 0}


def test_published_column_order(spark):
    """Silver and gold columns, in the order the reference models select them."""
    from forgeline.plans import silver
    from forgeline.plans.medallion import Models
    from tests.conftest import SF_SMALL

    m = Models.from_events(spark, SF_SMALL)
    assert m.silver("dim_repos").columns == silver.DIM_REPOS_COLUMNS
    assert m.silver("fct_issues").columns == silver.FCT_ISSUES_COLUMNS
    assert m.silver("fct_pull_requests").columns == silver.FCT_PRS_COLUMNS
    assert m.silver("fct_commits").columns == silver.FCT_COMMITS_COLUMNS
    assert m.repo_daily_metrics().columns == gold.DAILY_COLUMNS
    assert m.repo_daily_metrics_joined().columns == gold.DAILY_COLUMNS
    assert m.repo_health_snapshot().columns == gold.HEALTH_COLUMNS


def test_report_columns(spark):
    from forgeline.operators import quality as dq

    df = spark.createDataFrame([("a",)], "k string")
    assert dq.quality_report({"t": df}, [dq.not_null("t", "k")]).columns == dq.REPORT_COLUMNS
