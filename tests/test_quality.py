"""Every declared check kind fails on a planted bad row and passes on clean data."""

from __future__ import annotations

import os

import pytest

from forgeline.operators import quality as dq
from forgeline.plans import materialize
from tests.conftest import SF_SMALL
from tests.helpers import rows_of
from tests.test_models_edges import _commit, _issue, _models, _repo


@pytest.fixture()
def frames(spark):
    good = spark.createDataFrame([("a", "open", 1), ("b", "closed", 2), ("c", None, 3)], "k string, state string, n int")
    bad = spark.createDataFrame([("a", "open", 1), ("a", "merged", 2), (None, "merged", 3), ("d", "weird", 4)],
                                "k string, state string, n int")
    return {"good": good, "bad": bad}


def _report(frames, table):
    checks = [dq.not_null(table, "k"), dq.unique(table, "k"), dq.accepted_values(table, "state", ["open", "closed"]),
              dq.unique_combination(table, ["k"]), dq.value_between(table, "n", 1, 3),
              dq.row_count_between(table, 1, 3)]
    return {(r["check_name"]): r["failures"] for r in dq.quality_report(frames, checks).collect()}


def test_clean_table_passes(frames):
    assert set(_report(frames, "good").values()) == {0}


def test_planted_failures(frames):
    rep = _report(frames, "bad")
    assert rep == {"not_null": 1, "unique": 1, "accepted_values": 2, "unique_combination": 1, "value_between": 1,
                   "row_count_between": 1}


def test_gate_raises(frames):
    rep = dq.quality_report(frames, [dq.not_null("bad", "k")])
    with pytest.raises(dq.QualityGateError):
        dq.enforce(rep)
    assert dq.enforce(dq.quality_report(frames, [dq.not_null("good", "k")])) == []


def test_gate_stops_build_before_gold(spark, tmp_dir):
    import os

    from forgeline.plans import materialize
    from forgeline.plans.medallion import Models
    from tests.conftest import SF_SMALL

    m = Models.from_events(spark, SF_SMALL)
    checks = dq.declared_checks() + [dq.value_between("fct_commits", "parent_count", 5, 10)]
    with pytest.raises(dq.QualityGateError):
        materialize.build_and_check(spark, m, os.path.join(tmp_dir, "b"), checks)
    # silver was written aside and checked; the failing silver check stopped the gold layer and the publishing
    assert os.path.isdir(os.path.join(tmp_dir, "b", "_pending", "fct_commits"))
    assert not os.path.isdir(os.path.join(tmp_dir, "b", "_pending", "repo_daily_metrics"))
    assert os.listdir(os.path.join(tmp_dir, "b")) == ["_pending"]


def test_staging_views_are_queryable(spark):
    from forgeline.plans import materialize
    from forgeline.plans.medallion import Models
    from tests.conftest import SF_SMALL

    materialize.register_views(Models.from_events(spark, SF_SMALL))
    n = spark.sql("SELECT count(*) AS n FROM stg_commit WHERE sha IS NOT NULL").collect()[0]["n"]
    assert n > 0


def _planted(spark, check):
    """A tiny frame for ``check.table`` holding one row that must fail the check."""
    cols = list(check.columns)
    if check.kind == "not_null":
        rows = [("x",), (None,)]
    elif check.kind == "unique":
        rows = [("x",), ("x",)]
    elif check.kind == "accepted_values":
        rows = [("open",), ("merged",)]
    elif check.kind == "unique_combination":
        rows = [tuple("x" for _ in cols)] * 2
    else:
        raise AssertionError(check.kind)
    schema = ", ".join(f"{c} string" for c in cols)
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("check", dq.declared_checks() + dq.added_checks(), ids=lambda c: c.name)
def test_every_declared_check_fails_on_planted_row(spark, check):
    report = dq.quality_report({check.table: _planted(spark, check)}, [check]).collect()
    assert len(report) == 1 and report[0]["failures"] >= 1
    assert (report[0]["check_name"], report[0]["table_name"]) == (check.kind, check.table)


def test_declared_check_count():
    assert len(dq.declared_checks()) == 29


def _build_inputs(spark, state="open", extra=()):
    issues = [_issue("o/a", n, state=state if n == 2 else "open", created=f"2024-01-0{n}T10:00:00Z", seq=n) for n in range(1, 5)]
    return _models(spark, repos=[_repo("o/a", 5, "2024-01-05T10:00:00Z"), *extra], issues=issues,
                   commits=[_commit("o/a", "s1"), _commit("o/a", "s2", committed="2024-01-12T09:00:00Z")])


@pytest.mark.parametrize("broken", ["source", "gold"])
def test_a_failing_layer_leaves_the_published_tables(spark, tmp_dir, broken):
    root = os.path.join(tmp_dir, f"published-{broken}")
    checks = dq.declared_checks() + dq.added_checks()
    report = materialize.build_and_check(spark, _build_inputs(spark), root, checks)
    assert report.count() == len(checks) and report.where("failures > 0").count() == 0
    files = {n: sorted(os.listdir(f"{root}/{n}")) for n in (*materialize.SILVER_MODELS, *materialize.GOLD_TABLES)}
    before = rows_of(materialize.read_model(spark, root, "repo_daily_metrics"))
    bad, checks = (_build_inputs(spark, state="merged"), checks) if broken == "source" else (
        _build_inputs(spark, state="closed"), [*checks, dq.value_between("repo_daily_metrics", "issues_opened", 2, 9)])
    with pytest.raises(dq.QualityGateError, match="merged|state" if broken == "source" else "issues_opened"):
        materialize.build_and_check(spark, bad, root, checks)
    assert {n: sorted(os.listdir(f"{root}/{n}")) for n in files} == files
    assert rows_of(materialize.read_model(spark, root, "repo_daily_metrics")) == before
    # a report without the gate publishes; then the gate lets a sound build replace it
    report = {tuple(r)[:3]: r["failures"] for r in materialize.build_and_check(spark, bad, root, checks, fail_fast=False).collect()}
    assert report == {tuple(r)[:3]: r["failures"] for r in dq.quality_report(_all_tables(spark, bad, root), checks).collect()}
    assert any(report.values())
    materialize.build_and_check(spark, _build_inputs(spark), root, dq.declared_checks())
    assert rows_of(materialize.read_model(spark, root, "repo_daily_metrics")) == before


def _all_tables(spark, models, root):
    tables = {k: models.bronze(k) for k in ("repo_metadata", "issue_or_pr", "commit")} | {n: models.stg(n) for n in materialize.STAGING_MODELS}
    return tables | {n: materialize.read_model(spark, root, n) for n in (*materialize.SILVER_MODELS, *materialize.GOLD_TABLES)}


def test_extra_checks_as_metrics_equal_the_report(spark, tmp_dir):
    from forgeline import catalog

    df = spark.range(100).selectExpr("id", "IF(id % 4 = 0, NULL, concat('x', id)) AS name", "TIMESTAMP_NTZ '2024-01-30 10:00:00' AS at")
    checks = [dq.row_count_between("t", 1), dq.row_count_between("t", 200), dq.missing_share_at_most("t", "name", 0.3),
              dq.missing_share_at_most("t", "name", 0.1), dq.fresh_within("t", "at", "2024-01-31 00:00:00", 24), dq.fresh_within("t", "at", catalog.AS_OF + " 12:00:00", 2),
              dq.value_between("t", "id", 5, 90), dq.matches_pattern("t", "name", "^x[0-9]$"), dq.accepted_values("t", "name", ["x1"]), dq.not_null("t", "name")]
    for i, frame in enumerate((df, df.where("id < 0"))):
        watch = dq.Watch(checks)
        watch.on("t", frame).write.parquet(f"{tmp_dir}/watched-{i}")
        assert sorted(watch.rows()) == sorted(map(tuple, dq.quality_report({"t": frame}, checks).collect()))


def test_partitioned_tables_have_one_file_a_day(spark, tmp_dir):
    from forgeline import catalog

    root = os.path.join(tmp_dir, "files")
    materialize.build(spark, catalog.Models.from_events(spark, SF_SMALL), root)
    days = [d for d in os.listdir(f"{root}/repo_daily_metrics") if d.startswith("day=")]
    assert days and all(len([f for f in os.listdir(f"{root}/repo_daily_metrics/{d}") if f.endswith(".parquet")]) == 1 for d in days)
