"""Plans of the serving reads, mergeable sketches, the joined daily metrics."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from forgeline import catalog
from forgeline.operators import anomaly
from forgeline.plans import gold, serving
from forgeline.sources import bronze, fixtures
from forgeline.sources.tables import events
from tests.conftest import SF_SMALL
from tests.helpers import rows_of


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _scan_metric(df, metric: str) -> int:
    """A metric summed over the file scans of an executed plan."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif hasattr(node, "plan") and node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
        else:
            if "Scan" in node.nodeName() and node.metrics().contains(metric):
                total += node.metrics().get(metric).get().value()
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


@pytest.fixture(scope="module")
def by_repo(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("by-repo"))
    bronze.write_bronze(fixtures.bronze_issue_or_pr(events(spark, SF_SMALL)), root, "issue_or_pr", F.lit("2024-01-31").cast("date"))
    return bronze.read_bronze(spark, root, "issue_or_pr")


def test_targets_prune_the_folders_of_other_repositories(spark, by_repo, tmp_dir):
    path = os.path.join(tmp_dir, "targets")
    by_repo.selectExpr("owner", "repo", "IF(repo LIKE '%1', 'tracked', 'paused') AS status").distinct().write.parquet(path)
    targets = spark.read.parquet(path)
    got = serving.of_targets(by_repo, targets, "status = 'tracked'").select("repo_full_name", "number")
    plan = _final_plan(got)
    assert "dynamicpruning" in plan.lower()
    assert rows_of(got) == rows_of(by_repo.where("repo LIKE '%1'").select("repo_full_name", "number"))
    # the scan hands on rows of target folders only: no file of another repository is read
    n_targets = targets.where("status = 'tracked'").count()
    assert _scan_metric(got, "numOutputRows") - targets.count() == got.count() < by_repo.count() / 2 and n_targets < targets.count()
    assert serving.of_targets(by_repo, targets, "status = 'none'").count() == 0


def test_serving_reads_written_gold_once(spark):
    for name, tables in (("dashboard_kpis", 1), ("top_repos", 1), ("target_repo_filter", 1), ("activity_series", 2)):
        df = catalog.QUERIES[name](spark, SF_SMALL)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == tables and "event_type" not in plan, name
        assert all("/serving-" in f for f in df.inputFiles())


def test_sketches_of_days_merge_into_any_window(spark):
    r = [(f"o/r{i % 2}", dt.date(2024, 1, 1 + i % 30), f"a{i * i % (4000 if i % 2 else 7)}") for i in range(20_000)] + [("o/r0", None, "x"), ("o/r0", dt.date(2024, 1, 2), None)]
    act = spark.createDataFrame(r, "repo_full_name string, day date, author string")
    sketches = gold.author_sketches(act)
    assert sketches.count() == len({x[:2] for x in r if x[1] and x[2]})
    for as_of, days in (("2024-01-31", 28), ("2024-01-20", 3), ("2024-01-31", 2)):
        start = dt.date.fromisoformat(as_of) - dt.timedelta(days)
        for got in gold.recent_authors_from_sketches(sketches, as_of, days).collect():
            exact = len({a for k, d, a in r if k == got["repo_full_name"] and d and a and d >= start})
            assert abs(got["recent_authors_28d"] - exact) <= gold.SKETCH_ERROR * exact


def test_joined_daily_metrics_join_three_aggregates(spark):
    m = catalog.Models.from_events(spark, SF_SMALL)
    df = m.repo_daily_metrics_joined()
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 3
    assert rows_of(df.select(*gold.DAILY_COLUMNS)) == rows_of(m.repo_daily_metrics().select(*gold.DAILY_COLUMNS))


def test_anomalies_take_one_shuffle(spark):
    daily = spark.createDataFrame(
        [("a", dt.date(2024, 1, d), 5 + d % 3, 1, 0) for d in range(1, 20) if d not in (4, 5, 11)] + [("a", dt.date(2024, 1, 25), 90, 0, 0), ("b", dt.date(2024, 1, 3), 1, 1, 1),
                                                                                                     ("b", None, 4, 4, 4)],
        "repo_full_name string, day date, commits bigint, prs_opened bigint, issues_opened bigint")
    scores = anomaly.anomaly_scores(daily)
    assert _final_plan(scores).split("Initial Plan")[0].count("Exchange hashpartitioning") == 1
    got = {(r["repo_full_name"], r["day"].day): r for r in scores.where("metric = 'commits'").collect()}
    assert sorted(d for k, d in got if k == "a") == list(range(1, 26)) and ("b", 3) in got
    assert got["a", 4]["value"] == 0 and got["a", 22]["value"] == 0 and got["a", 25]["is_anomaly"] and got["a", 25]["history_days"] == 24
