"""Incremental runs equal the full rebuild and touch only their buckets and days."""

from __future__ import annotations

import glob
import os

import pytest

from forgeline import catalog, schemas
from forgeline.plans import gold, incremental, silver, staging
from tests.conftest import SF_SMALL
from tests.helpers import rows_of
from tests.test_models_edges import _commit, _issue, _repo


def _staged(spark, issues=(), commits=(), repos=()):
    frames = {"issue_or_pr": (issues, schemas.ISSUE_OR_PR, staging.stg_issue_or_pr), "commit": (commits, schemas.COMMIT, staging.stg_commit),
              "repo_metadata": (repos, schemas.REPO_METADATA, staging.stg_repo_metadata)}
    return {k: fn(spark.createDataFrame(list(rows), schemas.nullable(schema))) for k, (rows, schema, fn) in frames.items()}


def _full_daily(staged):
    return rows_of(gold.repo_daily_metrics(*[silver.silver({"stg_" + k: v for k, v in staged.items()})[t]
                                            for t in ("fct_issues", "fct_pull_requests", "fct_commits")]))


def _files(root: str) -> dict[str, set[str]]:
    """Data files by partition folder."""
    out: dict[str, set[str]] = {}
    for f in glob.glob(f"{root}/*/*=*/*.parquet"):
        out.setdefault(os.path.relpath(os.path.dirname(f), root), set()).add(os.path.basename(f))
    return out


OLD = dict(
    issues=[_issue("o/a", 1, created="2024-01-05T10:00:00Z", fetched="2024-01-05T10:00:00Z", seq=1),
            _issue("o/a", 2, created="2024-01-06T10:00:00Z", fetched="2024-01-06T10:00:00Z", seq=2)],
    commits=[_commit("o/a", "s1", committed="2024-01-06T11:00:00Z", fetched="2024-01-06T11:00:00Z", seq=3),
             _commit("o/a", "s2", committed="2024-01-03T11:00:00Z", fetched="2024-01-06T11:00:00Z", seq=3)])
# the only activity of 2024-01-05 moves on; a closed state changes an old day; a commit loses its date; one record is older than what is held
NEW = dict(
    issues=[_issue("o/a", 1, created="2024-01-07T09:00:00Z", fetched="2024-01-08T00:00:00Z", seq=4),
            _issue("o/a", 2, state="closed", created="2024-01-06T10:00:00Z", fetched="2024-01-08T00:00:00Z", seq=5),
            _issue("o/a", 2, created="2024-01-01T10:00:00Z", fetched="2024-01-02T00:00:00Z", seq=1)],
    commits=[_commit("o/b", "s9", committed="2024-01-06T12:00:00Z", fetched="2024-01-08T00:00:00Z", seq=6),
             _commit("o/a", "s2", committed=None, fetched="2024-01-08T00:00:00Z", seq=7)])


def test_day_that_loses_all_activity_is_dropped(spark, tmp_dir):
    root = os.path.join(tmp_dir, "inc")
    incremental.apply_batch(spark, _staged(spark, **OLD), root, 0)
    assert os.path.isdir(f"{root}/repo_daily_metrics/day=2024-01-05") and os.path.isdir(f"{root}/day_authors/day=2024-01-03")
    incremental.apply_batch(spark, _staged(spark, **NEW), root, 1)
    both = _staged(spark, **{k: OLD[k] + NEW[k] for k in OLD})
    assert rows_of(incremental.read_daily(spark, root)) == _full_daily(both)
    for table in ("activity", "repo_daily_metrics", "day_authors"):
        assert not glob.glob(f"{root}/{table}/day=2024-01-05") and not glob.glob(f"{root}/{table}/day=2024-01-03")
    state = incremental.facts(spark, root)
    want = silver.silver({"stg_" + k: v for k, v in both.items()})
    for name in ("fct_issues", "fct_pull_requests", "fct_commits"):
        assert rows_of(state[name]) == rows_of(want[name])


@pytest.mark.parametrize("fails_at", ["activity", "repo_daily_metrics", "day_authors", "commit_state"])
def test_a_failed_run_is_repeated(spark, tmp_dir, monkeypatch, fails_at):
    root = os.path.join(tmp_dir, f"again-{fails_at}")
    incremental.apply_batch(spark, _staged(spark, **OLD), root, 0)
    write = incremental._replace

    def failing(df, path, partition):
        if path.endswith(fails_at):
            raise OSError("lost")
        write(df, path, partition)

    monkeypatch.setattr(incremental, "_replace", failing)
    with pytest.raises(OSError):
        incremental.apply_batch(spark, _staged(spark, **NEW), root, 1)
    monkeypatch.setattr(incremental, "_replace", write)
    for _ in range(2):
        incremental.apply_batch(spark, _staged(spark, **NEW), root, 1)
    assert rows_of(incremental.read_daily(spark, root)) == _full_daily(_staged(spark, **{k: OLD[k] + NEW[k] for k in OLD}))


def test_a_small_batch_rewrites_its_buckets_and_days_only(spark, tmp_dir):
    root = os.path.join(tmp_dir, "small")
    m = catalog.Models.from_events(spark, SF_SMALL)
    staged = {k: m.stg("stg_" + k) for k in incremental.STATE_KEYS}
    incremental.apply_batch(spark, staged, root, 0, buckets=64)
    before = _files(root)
    # one in a hundred records, landed again a day later
    again = {k: df.where("ingest_seq % 100 = 3").withColumn("fetched_at", df.fetched_at + __import__("datetime").timedelta(days=1))
             for k, df in staged.items()}
    incremental.apply_batch(spark, again, root, 1, buckets=64)
    after = _files(root)
    changed = {p for p in before.keys() | after.keys() if before.get(p) != after.get(p)}
    for kind, df in again.items():
        touched = {r["bucket"] for r in incremental._bucketed(df, kind, 64).select("bucket").distinct().collect()}
        assert {p for p in changed if p.startswith(f"{kind}_state/")} == {f"{kind}_state/bucket={b}" for b in touched}
        assert kind == "repo_metadata" or len(touched) < 64
    days = {str(r["day"]) for r in spark.read.parquet(f"{root}/changes/v1").select("day").distinct().collect()}
    for table in ("activity", "repo_daily_metrics", "day_authors"):
        assert {p for p in changed if p.startswith(f"{table}/")} <= {f"{table}/day={d}" for d in days}
    assert all(len(files) == 1 for files in after.values())


def test_health_reads_the_days_of_its_window(spark, tmp_dir):
    root = os.path.join(tmp_dir, "window")
    repos = [_repo("o/a", 5, fetched="2024-01-05T10:00:00Z", seq=1), _repo("o/z", 9, fetched="2024-01-05T10:00:00Z", seq=1)]
    incremental.apply_batch(spark, _staged(spark, **OLD, repos=repos), root, 0)
    for as_of in ("2024-01-31", "2024-02-02", "2024-02-03", "2024-03-30"):  # the window's start passes the days
        df = incremental.health(spark, root, as_of)
        staged = _staged(spark, **OLD, repos=repos)
        s = silver.silver({"stg_" + k: v for k, v in staged.items()})
        assert rows_of(df) == rows_of(gold.repo_health_snapshot(s["dim_repos"], s["fct_issues"], s["fct_pull_requests"], s["fct_commits"], as_of))
        assert "PartitionFilters: [isnotnull(day" in df._jdf.queryExecution().toString()
