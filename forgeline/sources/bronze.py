"""Bronze storage: partitioned Parquet writer and readers.

Layout (ours): ``{root}/{kind}/owner=/repo=/year=/month=/day=/part-*.zstd.parquet``
with the run id as a column. Every level is a ``k=v`` directory, so filters on
owner, repo or landing date prune partitions at planning time.

The collector's own layout, ``{kind}/{owner}/{repo}/year=/month=/day=/{run}.parquet``,
is not Hive-style (owner and repo are bare directory names); Spark refuses to
infer partitions from it, so :func:`read_foreign_bronze` lists files
recursively and recovers the levels from each file's path.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgeline import schemas
from forgeline.operators.quality import observed_values

PARTITION_COLUMNS = ["owner", "repo", "year", "month", "day"]
# Bulk loads: landing date only (owner/repo levels multiply small files at scale).
DATE_PARTITIONS = ["year", "month", "day"]


def with_partition_columns(df: DataFrame, kind: str, partition_date: Column | _dt.date | None = None,
                           run_id: str | None = None) -> DataFrame:
    """Add owner/repo (split once on the first slash) and the landing date parts.

    ``partition_date`` defaults to today's UTC date (the landing date; it is
    ingest lineage, never event time). A column may be given for backfills.
    """
    key = F.col(schemas.REPO_KEY[kind])
    if partition_date is None:
        partition_date = _dt.datetime.now(_dt.UTC).date()
    d = partition_date if isinstance(partition_date, Column) else F.lit(partition_date)
    parts = F.split(key, "/", 2)
    out = df.withColumns({
        "owner": parts.getItem(0),
        "repo": parts.getItem(1),
        # zero-padded directory values: year=2024/month=01/day=05
        "year": F.lpad(F.year(d).cast("string"), 4, "0"),
        "month": F.lpad(F.month(d).cast("string"), 2, "0"),
        "day": F.lpad(F.dayofmonth(d).cast("string"), 2, "0"),
    })
    if run_id is not None:
        out = out.withColumn("run_id", F.lit(run_id))
    return out


def write_bronze(df: DataFrame, root: str, kind: str, partition_date: Column | _dt.date | None = None,
                 run_id: str | None = None, mode: str = "append", fmt: str = "parquet",
                 partition_by: list[str] | None = None) -> int:
    """Append typed records of one kind; returns the number of rows written.

    An empty input writes no data file (a partitioned write creates no
    directory) and returns 0. The row count is observed during the write, not
    by a second pass. ``hint("rebalance")`` lets AQE split a hot repository's
    partition into several files and merge tiny ones, instead of one task per
    key. ``mode="overwrite"`` with dynamic partition overwrite replaces only the
    partitions present in ``df`` (idempotent re-runs).
    """
    cols = [f.name for f in schemas.BRONZE_SCHEMAS[kind].fields]
    framed = with_partition_columns(df.select(*cols), kind, partition_date, run_id)
    parts = partition_by or PARTITION_COLUMNS

    def write(counted: DataFrame) -> None:
        out = counted.hint("rebalance", *parts)
        if "repo" not in parts:
            # date-only layout: cluster rows by repository inside each file, so Parquet
            # row-group statistics let a repository filter skip most of a day's data.
            # The partition columns lead the sort, which is the order the partitioned
            # writer needs anyway (it would otherwise add its own sort and drop ours).
            out = out.sortWithinPartitions(*parts, schemas.REPO_KEY[kind])
        (out.write.mode(mode).format(fmt).option("compression", "zstd")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*parts).save(f"{root.rstrip('/')}/{kind}"))

    return counted_write(framed, write)


def counted_write(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write a frame and return its number of rows, observed during the write.

    Where Spark proves an input empty it prunes the plan with its metrics, so the observation ends without values; only that counts as no rows.
    """
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    write(df.observe(obs, F.count(F.lit(1)).alias("rows")))
    return int(observed_values(obs).get("rows", 0))


def read_bronze(spark: SparkSession, root: str, kind: str, fmt: str = "parquet",
                partition_by: list[str] | None = None) -> DataFrame:
    """Our layout: declared schema (no inference), partitions discovered from paths."""
    path = f"{root.rstrip('/')}/{kind}"
    schema = schemas.nullable(schemas.BRONZE_SCHEMAS[kind])
    types = {"owner": T.StringType(), "repo": T.StringType(), "year": T.IntegerType(),
             "month": T.IntegerType(), "day": T.IntegerType()}
    parts = partition_by or PARTITION_COLUMNS
    data_cols = [c for c in PARTITION_COLUMNS if c not in parts]
    for name in [*(["run_id"] if "run_id" not in parts else []), *data_cols, *parts]:
        schema = schema.add(name, types.get(name, T.StringType()), True)
    return spark.read.schema(schema).option("basePath", path).format(fmt).load(path)


_FOREIGN_PATH = r"/([^/]+)/([^/]+)/year=(\d+)/month=(\d+)/day=(\d+)/([^/]+)\.parquet$"


def read_foreign_bronze(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """The collector's layout: recursive listing, levels recovered from ``_metadata.file_path``.

    Foreign files may carry null-typed columns (a file whose every value was
    null); reading those under a declared schema needs
    ``spark.sql.parquet.enableVectorizedReader=false`` for that job.
    """
    path = f"{root.rstrip('/')}/{kind}"
    schema = schemas.nullable(schemas.BRONZE_SCHEMAS[kind])
    raw = (spark.read.schema(schema).option("recursiveFileLookup", "true")
           .option("pathGlobFilter", "*.parquet").parquet(path))
    fp = F.col("_metadata.file_path")
    return raw.withColumns({
        "owner": F.regexp_extract(fp, _FOREIGN_PATH, 1),
        "repo": F.regexp_extract(fp, _FOREIGN_PATH, 2),
        "year": F.regexp_extract(fp, _FOREIGN_PATH, 3).cast("int"),
        "month": F.regexp_extract(fp, _FOREIGN_PATH, 4).cast("int"),
        "day": F.regexp_extract(fp, _FOREIGN_PATH, 5).cast("int"),
        "run_id": F.regexp_extract(fp, _FOREIGN_PATH, 6),
    })


class session_conf:
    """Temporarily override SQL settings for the actions run inside the block.

    Spark reads most settings when a query *executes*, so the override must
    cover the action (write / collect), not only the DataFrame definition.
    """

    def __init__(self, spark: SparkSession, settings: dict[str, str]):
        self.spark, self.settings, self.saved = spark, settings, {}

    def __enter__(self):
        for k, v in self.settings.items():
            self.saved[k] = self.spark.conf.get(k, None)
            self.spark.conf.set(k, v)
        return self

    def __exit__(self, *exc):
        for k, v in self.saved.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)
        return False


def normalize_foreign_bronze(spark: SparkSession, src_root: str, kind: str, dst_root: str,
                             partition_by: list[str] | None = None) -> int:
    """One-off conversion of the collector's Bronze into our typed, Hive-partitioned layout.

    The collector infers each file's schema from its values, so a file in which a
    column was always null (``closed_at``) or always empty (``labels``) carries
    a null-typed column; the vectorized Parquet reader refuses to read it under
    the declared type. The row-based reader accepts it, so this job (and only
    this job) runs with the vectorized reader off. The run id and landing date
    come from each file's path. Returns the number of rows written.
    """
    cols = [f.name for f in schemas.BRONZE_SCHEMAS[kind].fields]
    parts = partition_by or PARTITION_COLUMNS
    with session_conf(spark, {"spark.sql.parquet.enableVectorizedReader": "false"}):
        foreign = read_foreign_bronze(spark, src_root, kind).withColumn(
            "_landing_date", F.make_date(F.col("year"), F.col("month"), F.col("day")))
        framed = with_partition_columns(foreign.select(*cols, "run_id", "_landing_date"), kind,
                                        F.col("_landing_date")).drop("_landing_date")
        # a second conversion replaces the partitions of the first
        return counted_write(framed, lambda df: df.hint("rebalance", *parts).write.mode("overwrite").option("compression", "zstd").option(
            "partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(f"{dst_root.rstrip('/')}/{kind}"))
