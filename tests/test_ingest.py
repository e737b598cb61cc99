"""Runs from landed pages: claimed once, repeatable, visible when done."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from forgeline import catalog
from forgeline.plans import ingest
from forgeline.sources import bronze, fixtures
from forgeline.sources.tables import events
from tests.conftest import SF_SMALL
from tests.helpers import rows_of


def _land(spark, root, arrival, kinds=ingest.KINDS):
    for kind in kinds:
        fixtures.landed_pages(events(spark, SF_SMALL), kind).where(f"page_no % 3 = {arrival}").coalesce(1).write.mode("append").parquet(
            f"{root}/landed/{kind}")


def _records(spark, root):
    return {kind: rows_of(ingest.read_runs(spark, root, kind).drop("run_id")) for kind in ingest.KINDS}


def test_runs_read_every_file_once_and_can_be_repeated(spark, tmp_dir):
    root = os.path.join(tmp_dir, "ingest")
    _land(spark, root, 0)
    first = ingest.run(spark, f"{root}/landed", root, "a")
    _land(spark, root, 1)
    again = ingest.run(spark, f"{root}/landed", root, "a")  # files that came later belong to the next run
    assert again == first and all(n > 0 for n, _ in first.values())
    second = ingest.run(spark, f"{root}/landed", root, "b")
    paths = [r["path"] for r in spark.read.parquet(f"{root}/ledger").collect()]
    assert len(paths) == len(set(paths)) == 6
    before = _records(spark, root)
    for name in ("b", "a", "b"):
        ingest.run(spark, f"{root}/landed", root, name)
    assert _records(spark, root) == before
    assert ingest.run(spark, f"{root}/landed", root, "c") == {}
    assert {k: len(v) for k, v in before.items()} == {k: first[k][0] + second[k][0] for k in first}
    n = sum(spark.read.parquet(f"{root}/rejects/{k}").count() for k in ingest.KINDS)
    assert n == sum(r for counts in (first, second) for _, r in counts.values()) > 0


def test_a_run_that_failed_is_not_seen(spark, tmp_dir, monkeypatch):
    root = os.path.join(tmp_dir, "half")
    _land(spark, root, 0)
    ingest.run(spark, f"{root}/landed", root, "a")
    seen = _records(spark, root)
    _land(spark, root, 1)
    write = bronze.write_bronze

    def failing(df, where, kind, *args, **kw):
        if kind == "commit":
            raise OSError("lost")
        return write(df, where, kind, *args, **kw)

    monkeypatch.setattr(bronze, "write_bronze", failing)
    with pytest.raises(OSError):
        ingest.run(spark, f"{root}/landed", root, "b")
    assert _records(spark, root) == seen
    monkeypatch.setattr(bronze, "write_bronze", write)
    ingest.run(spark, f"{root}/landed", root, "b")
    now = _records(spark, root)
    assert all(len(now[k]) > len(seen[k]) for k in seen)


def test_pages_to_gold_writes_the_tables(spark, tmp_dir):
    root = os.path.join(tmp_dir, "gold")
    _land(spark, root, 0)
    paths = ingest.pages_to_gold(spark, f"{root}/landed", root, "a", catalog.AS_OF)
    daily = spark.read.parquet(paths["repo_daily_metrics"])
    assert rows_of(daily) == rows_of(ingest.models(spark, root).repo_daily_metrics().select(*daily.columns))
    assert spark.read.parquet(paths["repo_health_snapshot"]).count() > 0


def test_row_counts_of_writes(spark, tmp_dir):
    """Empty inputs of every kind count as no rows; what is not empty is counted."""
    df = spark.range(100).selectExpr("id", "id % 3 AS p")
    inputs = {"rows": (df, 100), "false": (df.where("false"), 0), "filtered": (df.where("id < 0"), 0),
              "grouped": (df.groupBy("p").count().where("count < 0"), 0), "none": (spark.createDataFrame([], "id INT, p INT"), 0),
              "joined": (df.join(df.where("id < 0").selectExpr("id AS k"), F.expr("id = k")), 0)}
    for name, (frame, n) in inputs.items():
        got = bronze.counted_write(frame, lambda x, path=f"{tmp_dir}/counted/{name}": x.hint("rebalance", "p").write.partitionBy("p").parquet(path))
        assert got == n, name
