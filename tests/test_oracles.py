"""Every registered query against its DuckDB oracle on the smallest driver tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from forgeline import catalog
from tests.conftest import SF_SMALL
from tests.helpers import canon, duck

QUERIES = catalog.QUERIES
ORACLES = catalog.ORACLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = canon(df.columns, df.collect())
    cols, rows = duck(ORACLES[name], SF_SMALL)
    assert sorted(df.columns) == sorted(cols)
    assert got == canon(cols, rows)


def test_every_query_has_its_oracle():
    assert set(ORACLES) == set(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["repo_full_name", "day", "issues_opened", "issues_closed_same_day", "prs_opened",
                          "prs_closed", "commits", "distinct_authors"]
    assert df.count() > 0
