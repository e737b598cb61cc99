"""Full-refresh materialisation of silver and gold (the build step), and serving reads.

Each build writes every model to ``{root}/{name}`` with overwrite (static
overwrite, so a rebuild leaves nothing of the one before). Silver facts are written first
and gold is computed from the *written* silver tables, so the expensive
dedup windows run once per build and gold's lineage starts at Parquet.
``fmt`` is the table-format parameter (``parquet`` by default; a lakehouse
format whose package is installed plugs in by name).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession

from forgeline.operators import quality as dq
from forgeline.plans import gold, silver
from forgeline.plans.medallion import BRONZE_OF, SILVER_MODELS, STAGING_FN, STAGING_MODELS, Models

GOLD_TABLES = ("repo_daily_metrics", "repo_health_snapshot")

# gold daily partitioned by day: serving filters on dates prune files
PARTITIONING = {"repo_daily_metrics": ["day"]}
# rows clustered by repo inside each file: Parquet min/max statistics then let a
# repo filter skip row groups (the reference's "order by repo, day", kept for storage)
CLUSTERING = {"repo_daily_metrics": ["repo_full_name"], "repo_health_snapshot": ["repo_full_name"]}


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                cluster_by: list[str] | None = None) -> None:
    if partition_by:
        # rows of a partition meet before the write (AQE splits large and joins small ones): else every task writes a file into every partition
        df = df.hint("rebalance", *partition_by)
    if cluster_by:
        # partition columns lead: the partitioned writer needs that order and would
        # otherwise add its own sort, dropping the clustering
        df = df.sortWithinPartitions(*(partition_by or []), *cluster_by)
    # a full refresh replaces the whole table: partitions that the new rows lack must go too
    w = df.write.mode("overwrite").format(fmt).option("compression", "zstd").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def register_views(models: Models, names: Sequence[str] = STAGING_MODELS) -> None:
    """Staging models as temporary views (the reference materialises staging as views),
    so SQL users can query ``stg_*`` by name; nothing is computed until queried."""
    for name in names:
        models.table(name).createOrReplaceTempView(name)


def read_model(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(f"{root}/{name}")


def build_silver(models: Models, root: str, fmt: str = "parquet") -> dict[str, str]:
    paths = {}
    for name in SILVER_MODELS:
        paths[name] = f"{root}/{name}"
        write_table(models.silver(name), paths[name], fmt)
    return paths


def gold_frames(spark: SparkSession, root: str, as_of, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Gold from the *written* silver tables (dedup windows are not re-run)."""
    s = {name: read_model(spark, root, name, fmt) for name in SILVER_MODELS}
    facts = (s["fct_issues"], s["fct_pull_requests"], s["fct_commits"])
    return {
        "repo_daily_metrics": gold.repo_daily_metrics(*facts),
        "repo_health_snapshot": gold.repo_health_snapshot(s["dim_repos"], *facts, as_of=as_of),
    }


def build_gold(spark: SparkSession, root: str, as_of, fmt: str = "parquet") -> dict[str, str]:
    paths = {}
    for name, df in gold_frames(spark, root, as_of, fmt).items():
        paths[name] = f"{root}/{name}"
        write_table(df, paths[name], fmt, PARTITIONING.get(name), CLUSTERING.get(name))
    return paths


def build(spark: SparkSession, models: Models, root: str, fmt: str = "parquet", as_of=None) -> dict[str, str]:
    """Write silver, then gold from the written silver. Returns name -> path."""
    paths = build_silver(models, root, fmt)
    paths.update(build_gold(spark, root, as_of or models.as_of, fmt))
    return paths


def build_and_check(spark: SparkSession, models: Models, root: str, checks: Sequence[dq.Check],
                    fmt: str = "parquet", as_of=None, fail_fast: bool = True) -> DataFrame:
    """``build`` behind its data tests: everything is written to a pending folder and published only if the tests hold.

    Row-level tests of sources, staging, silver and gold are metrics of the writes themselves (``quality.Watch``), so no table is scanned for
    them; uniqueness is tested on the key columns of the pending tables. With ``fail_fast`` the first failing layer (sources, staging and silver; then
    gold) stops the build with ``QualityGateError`` and the published tables stay as they were; without, tables are published whatever
    the report says. Returns the report (one row per check).
    """
    pending = f"{root}/_pending"
    watch = dq.Watch(checks)
    reports: list[tuple] = []

    def settle(names: Sequence[str]) -> None:
        rows = watch.rows()
        grouped = [c for c in checks if c.table in names and not dq.is_row_level(c)]
        if grouped:
            rows += map(tuple, dq.quality_report({n: read_model(spark, pending, n, fmt) for n in names}, grouped).collect())
        if fail_fast:
            dq.enforce_rows([Row(**dict(zip(dq.REPORT_COLUMNS, r))) for r in rows])
        reports.extend(rows)

    for name, df in _watched_silver(models, watch).items():
        write_table(watch.on(name, df), f"{pending}/{name}", fmt)
    settle(SILVER_MODELS)
    for name, df in gold_frames(spark, pending, as_of or models.as_of, fmt).items():
        write_table(watch.on(name, df), f"{pending}/{name}", fmt, PARTITIONING.get(name), CLUSTERING.get(name))
    settle(GOLD_TABLES)
    for name in (*SILVER_MODELS, *GOLD_TABLES):
        publish(spark, f"{pending}/{name}", f"{root}/{name}")
    return spark.createDataFrame(reports, dq.REPORT_SCHEMA)


def _watched_silver(models: Models, watch: dq.Watch) -> dict[str, DataFrame]:
    """Silver frames whose sources and staging are watched where they are read first (issues, for the two facts of one source)."""
    stg = {name: watch.on(name, STAGING_FN[name](watch.on(kind, models.bronze(kind)))) for name, kind in BRONZE_OF.items()}
    return {
        "dim_repos": silver.dim_repos(stg["stg_repo_metadata"]),
        "fct_issues": silver.fct_issues(stg["stg_issue_or_pr"]),
        "fct_pull_requests": models.silver("fct_pull_requests"),
        "fct_commits": silver.fct_commits(stg["stg_commit"]),
    }


def publish(spark: SparkSession, pending: str, path: str) -> None:
    """Put a written folder in the place of a published one (two renames; the old folder goes last)."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    src, dst, old = hadoop.Path(pending), hadoop.Path(path), hadoop.Path(f"{path}._old")
    fs = dst.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(old, True)
    if fs.exists(dst) and not fs.rename(dst, old):
        raise OSError(f"cannot move {path}")
    if not fs.rename(src, dst):
        fs.rename(old, dst)
        raise OSError(f"cannot publish {path}")
    fs.delete(old, True)
