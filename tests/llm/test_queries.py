"""Registered queries: against their SQL on the smallest tables, or rows only."""

from __future__ import annotations

import subprocess
import sys

import pytest

import __spark_entry__ as E
from forgeline.llm import oracles, queries
from tests.conftest import ROOT, SF_SMALL
from tests.helpers import canon, duck


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_equals_its_sql(spark, name):
    df = queries.QUERIES[name](spark, SF_SMALL)
    cols, rows = duck(oracles.ORACLES[name], SF_SMALL)
    assert sorted(df.columns) == sorted(cols)
    assert canon(df.columns, df.collect()) == canon(cols, rows)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(oracles.ORACLES)))
def test_query_returns_a_row_per_document(spark, name):
    assert queries.QUERIES[name](spark, SF_SMALL).count() == 200


def test_one_query_per_operator_and_the_pipeline():
    names = E.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert "pipeline" in names


def test_entry_without_the_subpackage():
    code = ("import sys; sys.modules['forgeline.llm'] = None\n"
            "import __spark_entry__ as E\n"
            "assert E.queries() and not any(n.startswith('op') or n == 'pipeline' for n in E.queries())")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
