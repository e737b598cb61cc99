"""Plan regression tests: the physical properties the design relies on at scale."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as E
from forgeline.operators.joins import bounded_rows, maybe_broadcast
from forgeline.plans import serving
from forgeline.plans.medallion import Models
from forgeline.sources import fixtures, landing, tables
from tests.conftest import SF_SMALL

# queries whose callables only build plans (the others write files or run streams first)
LAZY = ["stg_repo_metadata", "stg_issue_or_pr", "stg_commit", "dim_repos", "fct_issues", "fct_pull_requests",
        "fct_commits", "repo_daily_metrics", "repo_daily_metrics_joined", "activity_spine", "repo_health_snapshot",
        "dashboard_kpis", "top_repos", "activity_series", "target_repo_filter", "since_filter",
        "json_field_extract", "dq_report", "dq_extras_report", "landing_parse_issue", "landing_rejects",
        "anomaly_scores", "title_term_weights"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cartesian_or_nested_loop_join(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_dedup_limits_rows_before_the_shuffle(spark):
    plan = _plan(Models.from_events(spark, SF_SMALL).silver("fct_commits"))
    partial = plan.index("WindowGroupLimit")
    assert "Partial" in plan and "Final" in plan
    # partial limit sits below (printed after) the exchange
    assert plan.rindex("Exchange") < plan.rindex("Partial") and partial < plan.rindex("Partial")


def test_daily_metrics_shuffles(spark):
    m = Models.from_events(spark, SF_SMALL)
    single = _plan(m.repo_daily_metrics())
    joined = _plan(m.repo_daily_metrics_joined())
    assert single.count("Exchange hashpartitioning") == 4          # 2 dedup + 2 aggregation
    assert joined.count("Exchange hashpartitioning") > single.count("Exchange hashpartitioning")
    assert single.count("FileScan parquet") == 2                    # issues+PRs in one pass, commits


def test_filters_and_columns_reach_the_scan(spark):
    plan = _plan(Models.from_events(spark, SF_SMALL).silver("fct_commits"))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in scan
    read_schema = re.search(r"ReadSchema: struct<([^>]*)>", scan).group(1)
    assert "value" not in read_schema                               # commits never read `value`


def test_landing_parses_each_item_at_most_twice(spark):
    pages = fixtures.landed_pages(tables.events(spark, SF_SMALL), "issue_or_pr")
    good, _ = landing.land(pages, "issue_or_pr")
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    # the page array, the typed item, the key map (flagged items only)
    assert plan.count("from_json(") <= 3


def test_broadcast_only_with_a_row_bound(spark):
    health = Models.from_events(spark, SF_SMALL).repo_health_snapshot()
    top = serving.top_repos(health, 5).select("repo_full_name")
    assert bounded_rows(top) == 5
    assert "strategy=broadcast" in maybe_broadcast(top)._jdf.queryExecution().analyzed().toString()
    assert bounded_rows(health) is None
    assert maybe_broadcast(health) is health
