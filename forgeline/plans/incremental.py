"""Incremental rebuild: a landing batch costs the key buckets and the days it touches, not the history.

Tables below one root (Parquet, in the shared folder):

* ``{kind}_state``, partitioned by ``bucket`` (a hash of the key): the latest staged version of every key. This *is*
  silver: :func:`facts` are projections of it;
* ``activity``, partitioned by ``day``: one narrow row per dated fact, with its key;
* ``repo_daily_metrics`` and ``day_authors`` (distinct commit authors per repository), partitioned by ``day``.

One run (:func:`apply_batch`):

1. the batch's keys give the touched buckets; only those are read (partition pruning);
2. ``changes/v{n}`` is written first: for each key of the batch the activity row of its old version (``-``) and of its new latest version
   (``+``). ``latest(old latest, new versions) == latest(all versions)``, so a record that arrives late changes nothing unless it
   is the newest of its key;
3. the touched buckets of the states are replaced (dynamic partition overwrite);
4. the touched days of ``activity`` are replaced: what they held of other keys plus the ``+`` rows. Daily counts and day authors
   of these days are counted anew from them. A day that lost all activity is dropped.

A run that fails anywhere can be repeated with the same batch and number: written changes are kept (they were computed before any
table changed), and steps 3 and 4 give the same partitions again.

The 28-day health table is a sum of the daily counts of the kept days plus distinct authors over ``day_authors`` (:func:`health`),
so it reads neither facts nor days outside the window; only the day list moves with the date.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline.operators.dedup import latest_by_fetch
from forgeline.operators.joins import anti_join_keys, semi_join_keys
from forgeline.plans import gold, silver

STATE_KEYS = {
    "repo_metadata": ["repo_full_name"],
    "issue_or_pr": ["repo_full_name", "number", "is_pull_request"],
    "commit": ["repo_full_name", "sha"],
}
FACT_KEY = ["repo_full_name", "kind", "item"]
_FACT = ["repo_full_name", "kind", "item", "day", "closed_same_day", "closed", "author"]
#: Buckets of each state; a run rewrites the touched ones, so more buckets cost more files and less rewriting.
BUCKETS = 32


def _activity(issue_or_pr: DataFrame, commit: DataFrame) -> DataFrame:
    """Activity rows with their key, from latest versions."""
    items = issue_or_pr.where("is_pull_request IS NOT NULL").selectExpr(
        "repo_full_name", "CASE WHEN is_pull_request THEN 'pr' ELSE 'issue' END AS kind", "CAST(number AS STRING) AS item",
        "to_date(created_at) AS day",
        "(NOT is_pull_request AND closed_at IS NOT NULL AND to_date(closed_at) = to_date(created_at)) AS closed_same_day",
        "(is_pull_request AND state = 'closed') AS closed", "CAST(NULL AS STRING) AS author")
    commits = commit.where("committed_date IS NOT NULL").selectExpr(
        "repo_full_name", "'commit' AS kind", "sha AS item", "to_date(committed_date) AS day", "false AS closed_same_day",
        "false AS closed", "author_login AS author")
    return items.unionByName(commits)


# ------------------------------------------------------------------ tables
def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _read(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A table written with the columns of ``like``, which stands for it (without rows) while there is none."""
    return spark.read.schema(like.schema).parquet(path) if _exists(spark, path) else like.limit(0)


def _replace(df: DataFrame, path: str, partition: str) -> None:
    """Overwrite the partitions that ``df`` has rows of; each is one file unless it is large."""
    (df.hint("rebalance", partition).sortWithinPartitions(partition, "repo_full_name").write.mode("overwrite")
     .option("compression", "zstd").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path))


def _drop_days(spark: SparkSession, path: str, days: Iterable) -> None:
    jvm = spark.sparkContext._jvm
    for d in days:
        name = "__HIVE_DEFAULT_PARTITION__" if d is None else d
        p = jvm.org.apache.hadoop.fs.Path(f"{path}/day={name}")
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _in_days(days: Iterable) -> str:
    """A filter on the partition column that prunes at planning: calendar days, so bounded by the time span."""
    known = ", ".join(f"DATE '{d}'" for d in days if d is not None)
    tests = ([f"day IN ({known})"] if known else []) + (["day IS NULL"] if None in days else [])
    return " OR ".join(tests) or "false"


def _bucketed(staged: DataFrame, kind: str, buckets: int) -> DataFrame:
    return staged.drop("raw_payload").withColumn("bucket", F.expr(
        f"CAST(pmod(xxhash64({', '.join(STATE_KEYS[kind])}), {buckets}) AS INT)"))


# ------------------------------------------------------------------ one run
def apply_batch(spark: SparkSession, staged: Mapping[str, DataFrame], root: str, version: int, buckets: int = BUCKETS) -> None:
    """Apply the staged records of one landing batch (by record kind; kinds may be left out)."""
    # read by four jobs, so kept (in memory, spilling to disk) until the run is over
    fresh = {kind: _bucketed(df, kind, buckets).persist(StorageLevel.MEMORY_AND_DISK) for kind, df in staged.items()}
    try:
        _apply(spark, fresh, root, version)
    finally:
        for df in fresh.values():
            df.unpersist()


def _apply(spark: SparkSession, fresh: Mapping[str, DataFrame], root: str, version: int) -> None:
    names = reduce(DataFrame.unionByName, (df.selectExpr(f"'{kind}' AS kind", "bucket").distinct() for kind, df in fresh.items()))
    touched: dict[str, list[int]] = {kind: [] for kind in fresh}
    for r in names.collect():  # at most `buckets` rows a kind
        touched[r["kind"]].append(r["bucket"])
    old = {kind: _read(spark, f"{root}/{kind}_state", fresh[kind]).where(F.col("bucket").isin(touched[kind])) for kind in fresh}

    changes_path = f"{root}/changes/v{version}"
    if not _exists(spark, f"{changes_path}/_SUCCESS"):
        _changes(fresh, old).write.mode("overwrite").option("compression", "zstd").parquet(changes_path)
    changes = spark.read.parquet(changes_path)

    for kind, df in fresh.items():
        if touched[kind]:
            # the written files replace the read ones when the job commits
            _replace(latest_by_fetch(old[kind].unionByName(df), STATE_KEYS[kind]), f"{root}/{kind}_state", "bucket")
    _replace_days(spark, changes, root)


def _changes(fresh: Mapping[str, DataFrame], old: Mapping[str, DataFrame]) -> DataFrame:
    """(sign, fact columns): what the batch's keys had, and what they have now."""
    before, after = {}, {}
    for kind in ("issue_or_pr", "commit"):
        if kind not in fresh:
            continue
        keys = STATE_KEYS[kind]
        before[kind] = semi_join_keys(old[kind], fresh[kind].select(*keys).distinct(), keys)
        after[kind] = latest_by_fetch(before[kind].unionByName(fresh[kind]), keys)
    spark = next(iter(fresh.values())).sparkSession
    none = {
        "issue_or_pr": "repo_full_name STRING, number BIGINT, is_pull_request BOOLEAN, state STRING, created_at TIMESTAMP_NTZ, closed_at TIMESTAMP_NTZ",
        "commit": "repo_full_name STRING, sha STRING, committed_date TIMESTAMP_NTZ, author_login STRING",
    }
    for kind, ddl in none.items():
        for side in (before, after):
            side.setdefault(kind, spark.createDataFrame([], ddl))
    return _activity(before["issue_or_pr"], before["commit"]).selectExpr("'-' AS sign", *_FACT).unionByName(
        _activity(after["issue_or_pr"], after["commit"]).selectExpr("'+' AS sign", *_FACT))


def _replace_days(spark: SparkSession, changes: DataFrame, root: str) -> None:
    arrives = {r["day"]: r["arrives"] for r in changes.groupBy("day").agg(F.expr("bool_or(sign = '+') AS arrives")).collect()}
    if not arrives:
        return
    touched = _in_days(arrives)
    arrived = changes.where("sign = '+'").select(*_FACT)
    keys = changes.select(*FACT_KEY).distinct()
    held = _read(spark, f"{root}/activity", arrived).where(touched)
    _replace(anti_join_keys(held, keys, FACT_KEY).unionByName(arrived), f"{root}/activity", "day")
    # a day that only lost rows and has no others is in no write: its old partition would stay
    emptied = {d for d, comes in arrives.items() if not comes}
    if emptied:
        others = anti_join_keys(spark.read.schema(arrived.schema).parquet(f"{root}/activity").where(_in_days(emptied)), keys, FACT_KEY)
        emptied -= {r["day"] for r in others.select("day").distinct().collect()}
        for table in ("activity", "repo_daily_metrics"):
            _drop_days(spark, f"{root}/{table}", emptied)
    now = spark.read.schema(arrived.schema).parquet(f"{root}/activity").where(touched)
    authors = now.where("author IS NOT NULL").select("repo_full_name", "day", "author").distinct()
    _replace(gold.daily_metrics_from_activity(now), f"{root}/repo_daily_metrics", "day")
    _replace(authors, f"{root}/day_authors", "day")
    counted = spark.read.parquet(f"{root}/repo_daily_metrics").where(touched).where("distinct_authors > 0")
    _drop_days(spark, f"{root}/day_authors", set(arrives) - {r["day"] for r in counted.select("day").distinct().collect()})


# ------------------------------------------------------------------ reads
def facts(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Silver tables as projections of the states (each key is there once)."""
    state = {kind: spark.read.parquet(f"{root}/{kind}_state") for kind in STATE_KEYS if _exists(spark, f"{root}/{kind}_state")}
    return silver.from_latest(state)


def read_daily(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/repo_daily_metrics").select(*gold.DAILY_COLUMNS)


def recent(spark: SparkSession, root: str, as_of=None, days: int = 28) -> DataFrame:
    """Counts per repository over the kept days of the window (``day >= as_of - days``, no upper bound)."""
    start = F.date_sub(gold.as_of_col(as_of), days)
    daily = spark.read.parquet(f"{root}/repo_daily_metrics").where(F.col("day") >= start)
    sums = daily.groupBy("repo_full_name").agg(*[F.expr(e) for e in (
        "sum(commits) AS recent_commits_28d", "sum(prs_opened) AS recent_prs_28d", "sum(issues_opened) AS recent_issues_28d")])
    if not _exists(spark, f"{root}/day_authors"):
        return sums.withColumn("recent_authors_28d", F.lit(0).cast("bigint"))
    authors = spark.read.parquet(f"{root}/day_authors").where(F.col("day") >= start).groupBy("repo_full_name").agg(
        F.expr("count(DISTINCT author) AS recent_authors_28d"))
    return sums.join(authors, "repo_full_name", "left")


def health(spark: SparkSession, root: str, as_of=None, days: int = 28) -> DataFrame:
    """The health table as of a date, from the repository state and the days of its window."""
    return gold.health_from_recent(facts(spark, root)["dim_repos"], recent(spark, root, as_of, days))
