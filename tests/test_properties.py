"""Properties of the models (hypothesis-generated Bronze rows, few examples: Spark is slow)."""

from __future__ import annotations

import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from forgeline import schemas
from forgeline.operators.dedup import latest_by_fetch
from forgeline.plans import gold
from forgeline.plans.medallion import Models
from forgeline.sources import fixtures, tables
from tests.conftest import SF_SMALL
from tests.test_models_edges import _commit, _issue

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

_day = st.integers(1, 4).map(lambda d: f"2024-01-0{d}")
_hour = st.integers(0, 23).map(lambda h: f"{h:02d}")
_ts = st.builds(lambda d, h: f"{d}T{h}:00:00Z", _day, _hour)

issue_rows = st.lists(st.builds(
    lambda repo, num, pr, closed, created, fetched, seq: _issue(
        repo, num, is_pr=pr, state="closed" if closed else "open", created=created,
        closed=created if closed else None, fetched=fetched, seq=seq),
    st.sampled_from(["o/a", "o/b"]), st.integers(1, 4), st.booleans(), st.booleans(), _ts, _ts,
    st.integers(0, 3)), min_size=1, max_size=25)

commit_rows = st.lists(st.builds(
    lambda repo, sha, author, committed, fetched, seq: _commit(repo, sha, author=author, committed=committed,
                                                              fetched=fetched, seq=seq),
    st.sampled_from(["o/a", "o/c"]), st.sampled_from(["s1", "s2", "s3"]),
    st.sampled_from(["x", "y", None]), st.one_of(st.none(), _ts), _ts, st.integers(0, 3)),
    min_size=1, max_size=25)


def _models(spark, issues, commits):
    def frame(rows, kind):
        return spark.createDataFrame(list(rows), schemas.nullable(schemas.BRONZE_SCHEMAS[kind]))
    return Models({"repo_metadata": frame([], "repo_metadata"), "issue_or_pr": frame(issues, "issue_or_pr"),
                   "commit": frame(commits, "commit")})


def _rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


@SETTINGS
@given(issues=issue_rows, commits=commit_rows)
def test_single_pass_equals_reference_plan(spark, issues, commits):
    m = _models(spark, issues, commits)
    assert _rows(m.repo_daily_metrics()) == _rows(m.repo_daily_metrics_joined().select(*gold.DAILY_COLUMNS))
    assert _rows(m.repo_daily_metrics()) == _rows(gold.repo_daily_metrics(*m.facts()))


@SETTINGS
@given(commits=commit_rows)
def test_daily_commits_sum_to_dated_facts(spark, commits):
    m = _models(spark, [_issue("o/a", 1)], commits)
    total = m.repo_daily_metrics().agg({"commits": "sum"}).collect()[0][0]
    assert total == m.silver("fct_commits").filter("committed_date IS NOT NULL").count()


@SETTINGS
@given(issues=issue_rows)
def test_dedup_is_idempotent_and_reingest_stable(spark, issues):
    m = _models(spark, issues, [])
    once = m.silver("fct_issues")
    twice = _models(spark, issues + issues, []).silver("fct_issues")   # the same landing twice
    assert _rows(once) == _rows(twice)
    stg = m.stg("stg_issue_or_pr")
    keys = ["repo_full_name", "number", "is_pull_request"]
    assert _rows(latest_by_fetch(latest_by_fetch(stg, keys), keys)) == _rows(latest_by_fetch(stg, keys))


def test_stream_restart_adds_nothing(spark, tmp_dir):
    """A second run on the same checkpoint finds no new input: output unchanged."""
    from forgeline.streaming import jobs

    pages = fixtures.landed_pages(tables.events(spark, SF_SMALL), "commit")
    pages.write.parquet(os.path.join(tmp_dir, "landing"))
    schema = spark.read.parquet(os.path.join(tmp_dir, "landing")).schema
    out, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")
    for _ in range(2):
        stream = spark.readStream.schema(schema).parquet(os.path.join(tmp_dir, "landing"))
        jobs.await_all(jobs.parse_stream(stream, "commit", out, ck))
    got = spark.read.parquet(os.path.join(out, "records")).drop("batch_id")
    expected, _ = __import__("forgeline.sources.landing", fromlist=["land"]).land(pages, "commit")
    assert got.count() == expected.count()
    assert got.exceptAll(expected.select(*got.columns)).count() == 0


def test_late_rows_are_dropped_and_counted(spark, tmp_dir):
    import datetime as dt

    from forgeline.streaming import jobs

    src = os.path.join(tmp_dir, "events")
    schema = "repo_full_name string, kind string, ts timestamp_ntz"
    on_time = [("o/a", "commit", dt.datetime(2024, 1, d, 12)) for d in range(1, 11)]
    spark.createDataFrame(on_time, schema).coalesce(1).write.parquet(os.path.join(src, "f1"))
    # Spark filters late rows against the *previous* batch's watermark: the row
    # arriving one batch after the watermark moved is still merged, the next one is dropped
    more = [("o/a", "commit", dt.datetime(2024, 1, 11, 12))]
    spark.createDataFrame(more, schema).coalesce(1).write.parquet(os.path.join(src, "f2"))
    late = [("o/a", "commit", dt.datetime(2024, 1, 1, 13))]
    spark.createDataFrame(late, schema).coalesce(1).write.parquet(os.path.join(src, "f3"))
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(src))
    q = jobs.daily_counts_stream(stream, "ts", ["repo_full_name", "kind"], os.path.join(tmp_dir, "out"),
                                 os.path.join(tmp_dir, "ck"), delay="1 hour")
    jobs.await_all(q)
    assert jobs.rows_dropped_by_watermark(q) == 1
    days = {r["day"]: r["records"] for r in spark.read.parquet(os.path.join(tmp_dir, "out")).collect()}
    assert days[dt.date(2024, 1, 1)] == 1          # the late row did not change a closed window


def test_stream_upsert_keeps_newest_across_batches(spark, tmp_dir):
    import datetime as dt

    from forgeline.streaming import jobs

    src = os.path.join(tmp_dir, "in")
    schema = "k string, v string, fetched_at timestamp_ntz, seq bigint"
    batches = [
        [("a", "a1", dt.datetime(2024, 1, 1), 1), ("b", "b1", dt.datetime(2024, 1, 1), 2)],
        [("a", "a2", dt.datetime(2024, 1, 2), 3), ("a", "a0", dt.datetime(2023, 12, 31), 4)],   # newer + stale
        [("b", "b0", dt.datetime(2023, 12, 1), 5), ("c", "c1", dt.datetime(2024, 1, 3), 6)],    # stale + new key
    ]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(src, f"f{i}"))
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(src))
    mart = os.path.join(tmp_dir, "mart")
    jobs.await_all(jobs.upsert_stream(stream, ["k"], ["fetched_at", "seq"], mart, os.path.join(tmp_dir, "ck")))
    got = {r["k"]: r["v"] for r in jobs.read_mart(spark, mart, ["k"], ["fetched_at", "seq"]).collect()}
    assert got == {"a": "a2", "b": "b1", "c": "c1"}
    assert jobs._deltas(spark, mart) == [0, 1, 2]


def test_sliding_windows_count_each_row_per_window(spark):
    """The window slide is a parameter: with 1-day windows sliding by 12 hours every
    row falls into two windows (checked on a static frame; the watermark is inert there)."""
    import datetime as dt

    from forgeline.streaming import jobs

    rows = [("o/a", "commit", dt.datetime(2024, 1, 2, h)) for h in (1, 13)]
    df = spark.createDataFrame(rows, "repo_full_name string, kind string, ts timestamp_ntz")
    counts = jobs.daily_counts(df, "ts", ["repo_full_name", "kind"], window="1 day", slide="12 hours")
    got = {(r["window_start"].isoformat(), r["records"]) for r in counts.collect()}
    assert got == {("2024-01-01T12:00:00", 1), ("2024-01-02T00:00:00", 2), ("2024-01-02T12:00:00", 1)}


def test_batch_equals_stream_on_closed_windows(spark):
    """B2: the windowed counts of the stream equal the same function on the static table,
    restricted to the windows the watermark has closed."""
    import __spark_entry__ as E
    from forgeline.streaming import jobs

    streamed = E.queries()["stream_daily_counts"](spark, SF_SMALL)
    records = tables.events(spark, SF_SMALL).selectExpr(
        "concat('org', CAST(user_id % 3 AS STRING), '/repo', CAST(user_id % 12 AS STRING)) AS repo_full_name",
        "CASE WHEN event_type = 'view' THEN 'repo_metadata' WHEN event_type = 'error' THEN 'commit' "
        "ELSE 'issue_or_pr' END AS kind", "ts")
    batch = jobs.daily_counts(records, "ts", ["repo_full_name", "kind"])
    closed_until = streamed.agg({"window_end": "max"}).collect()[0][0]
    batch_closed = batch.filter(batch.window_end <= closed_until)
    assert _rows(streamed.select(*batch.columns)) == _rows(batch_closed)
