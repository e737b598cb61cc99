"""Registry of named queries and their DuckDB oracles.

Every query reads the driver tables (or data Spark derives from them) in
full; nothing is sampled or capped except where a limit is the feature
(top-k).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from forgeline import oracle
from forgeline.functions.json import payload_fields
from forgeline.operators import anomaly as _anomaly
from forgeline.operators import quality as dq
from forgeline.operators import text_features as _text
from forgeline.operators import upsert as _upsert
from forgeline.plans import incremental as _inc
from forgeline.plans import ingest as _ingest
from forgeline.plans import materialize as _mat
from forgeline.plans import gold, serving, silver
from forgeline.plans import staging as _staging
from forgeline.plans.medallion import Models as _Models
from forgeline.session import work_path
from forgeline.sources import bronze as _bronze
from forgeline.sources import fixtures as _fx
from forgeline.sources import landing
from forgeline.sources.tables import events as _events
from forgeline.sources.tables import read_table, table_path
from forgeline.streaming import jobs as _stream

QueryFn = Callable[[SparkSession, str], DataFrame]

# Fixed value: the date the registered queries report on (the library's default is the current date).
AS_OF = "2024-01-31"


class Models(_Models):
    """The models as of the fixed date."""

    def __init__(self, bronze, as_of=AS_OF):
        super().__init__(bronze, as_of)

    @classmethod
    def from_events(cls, spark: SparkSession, sf_dir: str, as_of=AS_OF) -> Models:
        return super().from_events(spark, sf_dir, as_of)

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _model_query(name: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return Models.from_events(spark, sf_dir).table(name)
    run.__name__ = name
    return run


_MODEL_SQL = oracle.model_sql()
for _name in ("stg_repo_metadata", "stg_issue_or_pr", "stg_commit",
              "dim_repos", "fct_issues", "fct_pull_requests", "fct_commits",
              "repo_daily_metrics", "repo_daily_metrics_joined", "activity_spine",
              "repo_health_snapshot"):
    register(_name, _MODEL_SQL[_name])(_model_query(_name))


# ------------------------------------------------------------------ serving

_SERVING_SQL = oracle.serving_sql()


_built: dict[tuple, str] = {}


def _gold(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A written gold table. The tables are built once per application and state of the events (their files), as a nightly build would; serving reads them."""
    key = (spark.sparkContext.applicationId, tuple(sorted(tuple(r) for r in _events(spark, sf_dir).select(
        "_metadata.file_path", "_metadata.file_size", F.col("_metadata.file_modification_time").cast("string")).distinct().collect())))
    if key not in _built:
        root = work_path(spark, "serving")
        _mat.build(spark, Models.from_events(spark, sf_dir), root)
        _built[key] = root
    return _mat.read_model(spark, _built[key], name)


@register("dashboard_kpis", _SERVING_SQL["dashboard_kpis"])
def q_dashboard_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.dashboard_kpis(_gold(spark, sf_dir, "repo_health_snapshot"))


@register("top_repos", _SERVING_SQL["top_repos"])
def q_top_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.top_repos(_gold(spark, sf_dir, "repo_health_snapshot"), 5)


@register("activity_series", _SERVING_SQL["activity_series"])
def q_activity_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.default_activity_series(_gold(spark, sf_dir, "repo_daily_metrics"), _gold(spark, sf_dir, "repo_health_snapshot"), 5)


@register("target_repo_filter", _SERVING_SQL["target_repo_filter"])
def q_target_repo_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.activity_series(_gold(spark, sf_dir, "repo_daily_metrics"), oracle.TARGET_REPOS_TEXT)


@register("recent_authors_sketch", oracle.sketch_sql())
def q_recent_authors_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct authors of 28 days from written daily sketches, beside the exact number and whether the stated error holds."""
    act = Models.from_events(spark, sf_dir).activity()
    path = work_path(spark, "author-sketches")
    _mat.write_table(gold.author_sketches(act), path, partition_by=["day"])
    estimate = gold.recent_authors_from_sketches(spark.read.parquet(path), AS_OF).withColumnRenamed("recent_authors_28d", "estimate")
    exact = gold.recent_from_activity(act, AS_OF).where("recent_authors_28d > 0").select("repo_full_name", "recent_authors_28d")
    return exact.join(estimate, "repo_full_name", "full_outer").selectExpr(
        "repo_full_name", "recent_authors_28d",
        f"coalesce(abs(estimate - recent_authors_28d) <= {gold.SKETCH_ERROR} * recent_authors_28d, false) AS within_error")


@register("target_items_pruned", oracle.targets_pruned_sql())
def q_target_items_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of the enabled targets of a target table, read from Bronze that is partitioned by owner and repository."""
    root = work_path(spark, "targets")
    items = _fx.bronze_issue_or_pr(_events(spark, sf_dir))
    _bronze.write_bronze(items, f"{root}/bronze", "issue_or_pr", partition_date=F.lit(AS_OF).cast("date"))
    Models.from_events(spark, sf_dir).silver("dim_repos").selectExpr(
        "split(repo_full_name, '/')[0] AS owner", "split(repo_full_name, '/')[1] AS repo",
        f"IF({oracle.TARGET_ENABLED}, 'tracked', 'paused') AS status").write.parquet(f"{root}/targets")
    records = _bronze.read_bronze(spark, f"{root}/bronze", "issue_or_pr")
    return serving.of_targets(records, spark.read.parquet(f"{root}/targets"), "status = 'tracked'").groupBy("repo_full_name", "state").agg(
        F.count(F.lit(1)).alias("records"))


@register("since_filter", _SERVING_SQL["since_filter"])
def q_since_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = Models.from_events(spark, sf_dir).stg("stg_issue_or_pr")
    # the collector's default look-back: seven days before the run date
    since = serving.look_back_start(AS_OF, days=7)
    return serving.updated_since(stg, since).select(
        "repo_full_name", "number", "state", "is_pull_request", "updated_at", "ingest_seq")


@register("json_field_extract", _SERVING_SQL["json_field_extract"])
def q_json_field_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = Models.from_events(spark, sf_dir).stg("stg_repo_metadata")
    return payload_fields(stg, {"payload_stars": ("$.stargazers_count", "bigint"),
                                "payload_id": ("$.id", "bigint"),
                                "payload_missing": ("$.missing.key", "string")}).select(
        "repo_full_name", "ingest_seq", "stargazers_count", "payload_stars", "payload_id", "payload_missing")


# ------------------------------------------------------------------ data quality
def _model_tables(m: Models) -> dict[str, DataFrame]:
    out = {kind: m.bronze(kind) for kind in ("repo_metadata", "issue_or_pr", "commit")}
    for name in ("stg_repo_metadata", "stg_issue_or_pr", "stg_commit", "dim_repos", "fct_issues",
                 "fct_pull_requests", "fct_commits", "repo_daily_metrics", "repo_health_snapshot"):
        out[name] = m.table(name)
    return out


def _extra_checks() -> list[dq.Check]:
    return [
        dq.row_count_between("fct_commits", 1),
        dq.fresh_within("stg_commit", "fetched_at", "2024-01-31 00:00:00", 48),
        dq.missing_share_at_most("stg_commit", "author_login", 0.1),
        dq.missing_share_at_most("stg_commit", "committed_date", 0.5),
        dq.value_between("repo_daily_metrics", "commits", 0, 1000),
        dq.value_between("repo_health_snapshot", "stargazers_count", 0, 500),
        dq.matches_pattern("fct_commits", "sha", "^[0-9a-f]+$"),
        dq.matches_pattern("stg_issue_or_pr", "title", "^Item [0-9]+ of org"),
    ]


@register("dq_report", oracle.report_sql(dq.declared_checks() + dq.added_checks()))
def q_dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Models.from_events(spark, sf_dir)
    return dq.quality_report(_model_tables(m), dq.declared_checks() + dq.added_checks())


@register("dq_build_gate", oracle.report_sql(dq.declared_checks() + dq.added_checks()))
def q_dq_build_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The build with its checks in DAG order (the declared checks all pass here,
    so the fail-fast gate lets the build finish); the report of every layer."""
    root = work_path(spark, "gated-build")
    return _mat.build_and_check(spark, Models.from_events(spark, sf_dir), root,
                               dq.declared_checks() + dq.added_checks())


@register("dq_extras_report", oracle.report_sql(_extra_checks()))
def q_dq_extras_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.quality_report(_model_tables(Models.from_events(spark, sf_dir)), _extra_checks())


# planted failures: each check must fail on rows Spark derives from the driver tables
_PLANTED_STATE = ("CASE WHEN ingest_seq % 97 = 0 THEN 'merged' WHEN ingest_seq % 89 = 0 THEN NULL "
                  "ELSE state END")


@register("dq_accepted_values_failures", oracle.with_models(f"""
SELECT repo_full_name, number, ingest_seq, state FROM (
    SELECT repo_full_name, number, ingest_seq, {_PLANTED_STATE} AS state FROM stg_issue_or_pr) p
WHERE state IS NOT NULL AND state NOT IN ('open', 'closed')"""))
def q_dq_accepted_values_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = Models.from_events(spark, sf_dir).stg("stg_issue_or_pr")
    planted = stg.selectExpr("repo_full_name", "number", "ingest_seq", f"{_PLANTED_STATE} AS state")
    return dq.failing_rows(planted, dq.accepted_values("stg_issue_or_pr", "state", ["open", "closed"]))


@register("dq_not_null_failures", oracle.with_models(
    "SELECT repo_full_name, sha, ingest_seq, author_login FROM stg_commit WHERE author_login IS NULL"))
def q_dq_not_null_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = Models.from_events(spark, sf_dir).stg("stg_commit").select(
        "repo_full_name", "sha", "ingest_seq", "author_login")
    return dq.failing_rows(stg, dq.not_null("stg_commit", "author_login"))


@register("dq_unique_failures", oracle.with_models("""
SELECT repo_full_name, count(*) AS n_records FROM stg_repo_metadata
WHERE repo_full_name IS NOT NULL GROUP BY repo_full_name HAVING count(*) > 1"""))
def q_dq_unique_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = Models.from_events(spark, sf_dir).stg("stg_repo_metadata")
    return dq.failing_rows(stg, dq.unique("stg_repo_metadata", "repo_full_name"))


@register("dq_unique_combination_failures", """
SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q_dq_unique_combination_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return dq.failing_rows(li, dq.unique_combination("lineitem", ["l_orderkey", "l_linenumber"]))


# ------------------------------------------------------------------ landing

_LANDING_SQL = oracle.landing_sql()


def _landed(spark: SparkSession, sf_dir: str, kind: str):
    return landing.land(_fx.landed_pages(_events(spark, sf_dir), kind), kind)


@register("landing_parse_issue", _LANDING_SQL["landing_parse_issue"])
def q_landing_parse_issue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, "issue_or_pr")[0].drop("ingest_seq")


@register("landing_parse_commit", _LANDING_SQL["landing_parse_commit"])
def q_landing_parse_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, "commit")[0].drop("ingest_seq")


@register("landing_parse_repo", _LANDING_SQL["landing_parse_repo"])
def q_landing_parse_repo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, "repo_metadata")[0].drop("ingest_seq")


@register("landing_rejects", _LANDING_SQL["landing_rejects"])
def q_landing_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = []
    for kind in ("issue_or_pr", "commit", "repo_metadata"):
        rej = _landed(spark, sf_dir, kind)[1]
        parts.append(rej.select(F.lit(kind).alias("kind"), "repo_full_name", "raw_payload", "reason"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("landing_page_rejects", oracle.page_rejects_sql())
def q_landing_page_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged pages are quarantined whole: records, rejected items and rejected pages of each repository."""
    good, rejected = landing.land(_fx.damaged_pages(_events(spark, sf_dir), "issue_or_pr"), "issue_or_pr")
    tags = good.selectExpr("repo_full_name", "'record' AS what").unionByName(rejected.selectExpr(
        "repo_full_name", "CASE WHEN reason LIKE 'page:%' THEN 'page' ELSE 'item' END AS what"))
    return tags.groupBy("repo_full_name").agg(
        F.count_if(F.col("what") == "record").alias("records"), F.count_if(F.col("what") == "item").alias("rejected_items"),
        F.count_if(F.col("what") == "page").alias("rejected_pages"))


@register("landed_lines", oracle.landed_lines_sql())
def q_landed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items landed one to a line, with white space between their tokens: the kept payload is the line byte for byte."""
    root = work_path(spark, "lines")
    _fx.landed_items(_events(spark, sf_dir), "issue_or_pr").selectExpr(
        f"{oracle.SPACED_ITEM.format('payload')} AS value", "split(repo_full_name, '/')[0] AS owner", "split(repo_full_name, '/')[1] AS repo"
    ).write.partitionBy("owner", "repo").text(f"{root}/landed")
    good, _ = landing.parse_issue_or_pr(landing.read_landed_jsonl(spark, f"{root}/landed"))
    return good.select("repo_full_name", "number", "title", "raw_payload")


# ------------------------------------------------------------------ Bronze storage

BRONZE_RUN_ID = "run-0001"


@register("bronze_roundtrip", oracle.bronze_roundtrip_sql(BRONZE_RUN_ID))
def q_bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the issue/PR records partitioned by landing date, read them back."""
    root = work_path(spark, "bronze")
    src = _fx.bronze_issue_or_pr(_events(spark, sf_dir))
    _bronze.write_bronze(src, root, "issue_or_pr", partition_date=F.to_date(F.col("fetched_at")),
                         run_id=BRONZE_RUN_ID)
    return _bronze.read_bronze(spark, root, "issue_or_pr")


@register("bronze_roundtrip_orc", oracle.bronze_roundtrip_sql(BRONZE_RUN_ID))
def q_bronze_roundtrip_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same round trip with another file format."""
    root = work_path(spark, "bronze-orc")
    _bronze.write_bronze(_fx.bronze_issue_or_pr(_events(spark, sf_dir)), root, "issue_or_pr", partition_date=F.to_date(F.col("fetched_at")),
                         run_id=BRONZE_RUN_ID, fmt="orc")
    return _bronze.read_bronze(spark, root, "issue_or_pr", fmt="orc")


# ------------------------------------------------------------------ landed pages to gold

ITEM_SEQUENCE = "CAST(conv(substring(md5(raw_payload), 1, 15), 16, 10) AS BIGINT)"


@register("pages_to_daily_metrics", oracle.pages_to_daily_sql())
def q_pages_to_daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages land in two arrivals; a run after each takes the new files to Bronze, and each run is repeated. Gold from all runs."""
    root = work_path(spark, "pages")
    ev = _events(spark, sf_dir)
    for arrival in (0, 1):
        for kind in _ingest.KINDS:
            _fx.landed_pages(ev, kind).where(f"page_no % 2 = {arrival}").write.mode("append").parquet(f"{root}/landed/{kind}")
        for _ in range(2):
            _ingest.run(spark, f"{root}/landed", root, f"run-{arrival}", ITEM_SEQUENCE)
    return _ingest.models(spark, root).repo_daily_metrics()


# ------------------------------------------------------------------ incremental, backfill

# The landing cuts between three batches, the share of earlier records that land with the last batch only, and the
# dates on which the health table is taken after each batch.
INCREMENTAL_CUTS = ("2024-01-12 00:00:00", "2024-01-22 00:00:00")
LATE_RECORD = "ingest_seq % 50 = 7"
INCREMENTAL_DATES = ("2024-01-12", "2024-01-22", AS_OF)


def _staged_batches(spark: SparkSession, sf_dir: str) -> list[dict[str, DataFrame]]:
    """All records in three landing batches; some early ones arrive with the last."""
    ev = _events(spark, sf_dir)
    staged = {"repo_metadata": _staging.stg_repo_metadata(_fx.bronze_repo_metadata(ev)),
              "issue_or_pr": _staging.stg_issue_or_pr(_fx.bronze_issue_or_pr(ev)), "commit": _staging.stg_commit(_fx.bronze_commit(ev))}
    first, second = (f"fetched_at < TIMESTAMP_NTZ '{c}'" for c in INCREMENTAL_CUTS)
    conditions = (f"{first} AND NOT {LATE_RECORD}", f"NOT {first} AND {second}", f"NOT {second} OR ({first} AND {LATE_RECORD})")
    return [{kind: df.where(c) for kind, df in staged.items()} for c in conditions]


@register("incremental_daily_metrics", _MODEL_SQL["repo_daily_metrics"])
def q_incremental_daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three landing batches, each applied to the touched buckets and days; must equal the full rebuild."""
    root = work_path(spark, "incremental")
    for version, batch in enumerate(_staged_batches(spark, sf_dir)):
        _inc.apply_batch(spark, {k: batch[k] for k in ("issue_or_pr", "commit")}, root, version, buckets=8)
    return _inc.read_daily(spark, root)


@register("incremental_health", _MODEL_SQL["repo_health_snapshot"])
def q_incremental_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The health table from kept days after three batches, its date moving on; written after each, the last must equal the full rebuild."""
    root = work_path(spark, "incremental-health")
    for version, (batch, as_of) in enumerate(zip(_staged_batches(spark, sf_dir), INCREMENTAL_DATES)):
        _inc.apply_batch(spark, batch, root, version, buckets=8)
        _mat.write_table(_inc.health(spark, root, as_of), f"{root}/repo_health_snapshot")
    return _mat.read_model(spark, root, "repo_health_snapshot")


@register("backfill_daily_metrics", _MODEL_SQL["repo_daily_metrics"])
def q_backfill_daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backfill all landed records into Bronze (partitioned by landing day) twice:
    dynamic partition overwrite makes the re-run idempotent. Gold from the result."""
    ev = _events(spark, sf_dir)
    root = work_path(spark, "backfill")
    for _ in range(2):
        for kind, frame in _fx.bronze_from_events(ev).items():
            _bronze.write_bronze(frame, root, kind, partition_date=F.to_date(F.col("fetched_at")),
                                 run_id="backfill", mode="overwrite", partition_by=_bronze.DATE_PARTITIONS)
    m = Models({kind: _bronze.read_bronze(spark, root, kind, partition_by=_bronze.DATE_PARTITIONS)
                for kind in ("repo_metadata", "issue_or_pr", "commit")})
    return m.repo_daily_metrics()


# ------------------------------------------------------------------ mart upsert

# The previous mart was built from records landed before this
# instant, as of this date; the fresh rows are today's full snapshot.
MART_PREVIOUS_CUT = "2024-01-15 00:00:00"
MART_PREVIOUS_AS_OF = "2024-01-15"


def _merged_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previous mart version on disk, fresh health snapshot, merged with change flags.

    So that all four outcomes occur, the mart lacks the repositories ending in 3, has those ending in 7 as they are now, and the fresh
    rows lack those ending in 4."""
    before = f"CAST(fetched_at AS TIMESTAMP_NTZ) < TIMESTAMP_NTZ '{MART_PREVIOUS_CUT}'"
    previous_bronze = {k: f.where(before) for k, f in _fx.bronze_from_events(_events(spark, sf_dir)).items()}
    previous = Models(previous_bronze, as_of=MART_PREVIOUS_AS_OF).repo_health_snapshot()
    today = Models.from_events(spark, sf_dir).repo_health_snapshot()
    root = work_path(spark, "mart")
    previous.where("NOT repo_full_name RLIKE '[37]$'").unionByName(today.where("repo_full_name LIKE '%7'")).write.mode(
        "overwrite").parquet(f"{root}/v0")
    return _upsert.upsert_frame(spark.read.parquet(f"{root}/v0"), today.where("repo_full_name NOT LIKE '%4'"), ["repo_full_name"])


@register("upsert_repo_health", oracle.upsert_sql(MART_PREVIOUS_CUT, MART_PREVIOUS_AS_OF))
def q_upsert_repo_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged_mart(spark, sf_dir)


@register("upsert_changes", oracle.upsert_sql(MART_PREVIOUS_CUT, MART_PREVIOUS_AS_OF, ("insert", "update")))
def q_upsert_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change feed of the merge: what a change-based sink must receive."""
    return _upsert.changes(_merged_mart(spark, sf_dir))


# ------------------------------------------------------------------ streaming

STREAM_DELAY = "1 hour"
_STREAM_KIND = ("CASE WHEN event_type = 'view' THEN 'repo_metadata' WHEN event_type = 'error' THEN 'commit' "
                "ELSE 'issue_or_pr' END AS kind")


def _stream_landed(spark: SparkSession, root: str, parts: list[DataFrame], start: Callable[[DataFrame], StreamingQuery]) -> None:
    """Run a checkpointed stream over parts that land one after the other, each as one micro-batch of as many files as its tasks write.

    ``start`` catches up with what has landed; the next part lands when it is through, and the stream goes on from its checkpoint.
    """
    for part in parts:
        part.write.mode("append").parquet(f"{root}/landing")
        _stream.await_all(start(spark.readStream.schema(part.schema).parquet(f"{root}/landing")))


# Where the stream of events in order of time is cut, and which events come with the last batch only.
STREAM_CUTS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")
STREAM_LATE = "event_id % 40 = 3"


def _timed_parts(ev: DataFrame) -> list[DataFrame]:
    """The events as three parts in order of time."""
    first, second = (f"ts < TIMESTAMP_NTZ '{c}'" for c in STREAM_CUTS)
    return [ev.where(first), ev.where(f"NOT {first} AND {second}"), ev.where(f"NOT {second}")]


def _shuffled_parts(ev: DataFrame, n: int = 6) -> list[DataFrame]:
    """The events as parts in no order of time, with late records."""
    return [ev.where(f"pmod(xxhash64(event_id), {n}) = {i}") for i in range(n)]


def _item_versions(events: DataFrame) -> DataFrame:
    return _staging.stg_issue_or_pr(_fx.bronze_issue_or_pr(events)).select(
        "repo_full_name", "number", "is_pull_request", "state", "title", "user_login", "created_at",
        "closed_at", "fetched_at", "ingest_seq")


def _named_records(events: DataFrame) -> DataFrame:
    return events.selectExpr("event_id", f"{_fx.REPO_NAME} AS repo_full_name", _STREAM_KIND, "ts")


@register("stream_parse", _LANDING_SQL["landing_parse_issue"])
def q_stream_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages landed as files by the collector, parsed by a checkpointed stream."""
    root = work_path(spark, "stream-parse")
    pages = _fx.landed_pages(_events(spark, sf_dir), "issue_or_pr")
    pages.write.parquet(f"{root}/landing")
    stream = spark.readStream.schema(spark.read.parquet(f"{root}/landing").schema) \
        .option("maxFilesPerTrigger", 2).parquet(f"{root}/landing")
    _stream.await_all(_stream.parse_stream(stream, "issue_or_pr", f"{root}/out", f"{root}/checkpoint"))
    return spark.read.parquet(f"{root}/out/records").drop("batch_id", "ingest_seq")


@register("stream_daily_counts", oracle.stream_counts_sql(STREAM_DELAY))
def q_stream_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of closed days: append mode emits a window once the watermark has passed it, so the last ones stay open."""
    root = work_path(spark, "stream-counts")
    _stream_landed(spark, root, _timed_parts(_events(spark, sf_dir)), lambda events: _stream.daily_counts_stream(
        _named_records(events), "ts", ["repo_full_name", "kind"], f"{root}/out", f"{root}/checkpoint", delay=STREAM_DELAY))
    return spark.read.parquet(f"{root}/out")


@register("stream_latest_state", oracle.stream_latest_sql())
def q_stream_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_path(spark, "stream-latest")
    _stream_landed(spark, root, _shuffled_parts(_events(spark, sf_dir)), lambda events: _stream.latest_state_stream(
        _item_versions(events), ["repo_full_name", "number", "is_pull_request"], ["fetched_at", "ingest_seq"], f"{root}/out",
        f"{root}/checkpoint", compact_after=4))
    return _stream.serving_view(spark, f"{root}/out", ["repo_full_name", "number", "is_pull_request"])


@register("stream_upsert_latest", oracle.stream_latest_sql())
def q_stream_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events stream upserted into a versioned mart of the latest issue/PR state, batch by batch."""
    root = work_path(spark, "stream-upsert")
    _stream_landed(spark, root, _shuffled_parts(_events(spark, sf_dir)), lambda events: _stream.upsert_stream(
        _item_versions(events), ["repo_full_name", "number", "is_pull_request"], ["fetched_at", "ingest_seq"], f"{root}/mart",
        f"{root}/checkpoint", compact_after=4))
    return _stream.read_mart(spark, f"{root}/mart", ["repo_full_name", "number", "is_pull_request"], ["fetched_at", "ingest_seq"])


@register("stream_late_rows", oracle.stream_late_sql(STREAM_DELAY, STREAM_CUTS, STREAM_LATE))
def q_stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches in order of time, some events only with the last: rows counted in each window and rows that came too late for it."""
    root = work_path(spark, "stream-late")
    ev, keys = _events(spark, sf_dir), ["repo_full_name", "kind"]
    first, second, third = _timed_parts(ev.where(f"NOT {STREAM_LATE}"))
    _stream_landed(spark, root, [first, second, third.unionByName(ev.where(STREAM_LATE))], lambda events: _stream.counts_with_late_rows(
        _named_records(events), "ts", keys, f"{root}/out", f"{root}/checkpoint", STREAM_DELAY))
    window = [*keys, "window_start", "window_end"]
    late = _stream.read_late(spark, f"{root}/out").groupBy(*window).agg(F.count(F.lit(1)).alias("late_records"))
    return _stream.read_counts(spark, f"{root}/out", keys, STREAM_DELAY).join(late, window, "full_outer").selectExpr(
        *window, "coalesce(records, CAST(0 AS BIGINT)) AS records", "coalesce(late_records, CAST(0 AS BIGINT)) AS late_records",
        "coalesce(closed, true) AS closed")


# A redelivery comes up to three days of event time later; every tenth event again with its own batch, every tenth with the next.
REDELIVERY_DELAY = "3 days"


@register("stream_dedup_counts", oracle.stream_dedup_sql(REDELIVERY_DELAY))
def q_stream_dedup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of closed days when some events are delivered twice, within a batch and across batches: each counts once."""
    root = work_path(spark, "stream-dedup")
    parts = _timed_parts(_events(spark, sf_dir))
    again = [p.unionByName(p.where("event_id % 10 = 0")) for p in parts]
    for i in (1, 2):
        again[i] = again[i].unionByName(parts[i - 1].where("event_id % 10 = 1"))
    _stream_landed(spark, root, again, lambda events: _stream.deduplicated_counts_stream(
        _named_records(events), "ts", "event_id", ["repo_full_name", "kind"], f"{root}/out", f"{root}/checkpoint", REDELIVERY_DELAY))
    return spark.read.parquet(f"{root}/out")


# ------------------------------------------------------------------ features


def _title_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Models.from_events(spark, sf_dir)
    return _text.documents_combined(silver.issue_or_pr_latest(m.stg("stg_issue_or_pr")), m.silver("fct_commits"))


@register("anomaly_scores", oracle.anomaly_sql())
def q_anomaly_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = _anomaly.anomaly_scores(Models.from_events(spark, sf_dir).repo_daily_metrics())
    return scores.withColumns({c: F.round(c, 6) for c in ("baseline_mean", "baseline_std", "z_score")})


@register("title_term_weights", oracle.term_weights_sql())
def q_title_term_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text.term_weights(_title_documents(spark, sf_dir)).withColumn("weight", F.round("weight", 6))


@register("title_vectors", oracle.vectors_sql())
def q_title_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse TF-IDF vectors (pyspark.ml): non-zero entries, length and largest entry of each."""
    vec = _text.text_vectors(_title_documents(spark, sf_dir), num_features=1 << 22)
    # the entries of the sparse vector by built-ins: it never becomes dense and no Python runs on the rows
    entries = vec.select("doc_kind", "repo_full_name", "doc_key", F.unwrap_udt("features").alias("v"))
    return entries.selectExpr(
        "doc_kind", "repo_full_name", "doc_key", "CAST(size(filter(v.values, x -> x <> 0)) AS BIGINT) AS n_terms",
        "round(sqrt(aggregate(v.values, 0D, (s, x) -> s + x * x)), 6) AS norm", "round(coalesce(array_max(v.values), 0D), 6) AS largest")


# ------------------------------------------------------------------ materialised build + serving read


@register("materialized_health_by_stars", _MODEL_SQL["repo_health_snapshot"])
def q_materialized_health_by_stars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build all tables to the shared folder, then serve the overview list from the written gold table."""
    root = work_path(spark, "build")
    _mat.build(spark, Models.from_events(spark, sf_dir), root)
    return serving.health_by_stars(_mat.read_model(spark, root, "repo_health_snapshot"))


@register("rebuild_same_folder", oracle.rebuilt_sql(MART_PREVIOUS_CUT, MART_PREVIOUS_AS_OF))
def q_rebuild_same_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full build, then a rebuild into the same folder from earlier records only: nothing of the first may stay."""
    root = work_path(spark, "rebuild")
    _mat.build(spark, Models.from_events(spark, sf_dir), root)
    before = f"CAST(fetched_at AS TIMESTAMP_NTZ) < TIMESTAMP_NTZ '{MART_PREVIOUS_CUT}'"
    fewer = {k: f.where(before) for k, f in _fx.bronze_from_events(_events(spark, sf_dir)).items()}
    _mat.build(spark, Models(fewer, as_of=MART_PREVIOUS_AS_OF), root)
    return _mat.read_model(spark, root, "repo_daily_metrics")
