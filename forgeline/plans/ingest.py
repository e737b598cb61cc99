"""From landed pages to Bronze and gold, one run at a time, with a ledger of what each run has read.

Folders below one root:

* ``ledger/run_id=<run>``: the landed files a run claims (path, time, size), written before anything else. A file is claimed once, so no page is
  read by two runs; a repeated run reads its own claims again;
* ``bronze/<kind>/run_id=<run>/year=/month=/day=`` and ``rejects/<kind>/run_id=<run>``: what a run's pages gave. A repeated run replaces its own
  folders, whatever it had written before;
* ``done/run_id=<run>``: one row for each kind (records, rejects), written last. Readers see done runs only, so a run that failed half-way
  is invisible until it is repeated.

The files of a run pass through the driver as names, as for any scan that Spark plans; their pages never do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline import schemas
from forgeline.plans import materialize
from forgeline.plans.medallion import Models
from forgeline.sources import bronze, landing

KINDS = ("repo_metadata", "issue_or_pr", "commit")
RUN_PARTITIONS = ["run_id", *bronze.DATE_PARTITIONS]


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def claim(spark: SparkSession, landed: str, root: str, run_id: str, pattern: str = "*.parquet") -> dict[str, list[str]]:
    """Files of each kind (below ``landed/<kind>``) that belong to this run; claimed now unless the run has claimed before."""
    own = f"{root}/ledger/run_id={run_id}"
    if not _exists(spark, f"{own}/_SUCCESS"):
        found = None
        for kind in KINDS:
            if _exists(spark, f"{landed}/{kind}"):
                # names only: the content column is pruned, so no file is opened
                files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(
                    f"{landed}/{kind}").selectExpr(f"'{kind}' AS kind", "path", "modificationTime AS landed_at", "length AS bytes")
                found = files if found is None else found.unionByName(files)
        if found is None:
            found = spark.createDataFrame([], "kind STRING, path STRING, landed_at TIMESTAMP, bytes BIGINT")
        claimed = _claims(spark, root)
        if claimed is not None:
            found = found.join(claimed.select("path"), "path", "left_anti").select("kind", "path", "landed_at", "bytes")
        found.write.mode("overwrite").parquet(own)
    out: dict[str, list[str]] = {}
    for r in spark.read.parquet(own).select("kind", "path").orderBy("kind", "path").collect():
        out.setdefault(r["kind"], []).append(r["path"])
    return out


def _claims(spark: SparkSession, root: str) -> DataFrame | None:
    runs = [r for r in _runs(spark, f"{root}/ledger") if _exists(spark, f"{root}/ledger/run_id={r}/_SUCCESS")]
    return spark.read.parquet(*[f"{root}/ledger/run_id={r}" for r in runs]) if runs else None


def _runs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(n.removeprefix("run_id=") for n in names if n.startswith("run_id="))


def run(spark: SparkSession, landed: str, root: str, run_id: str, ingest_seq: str | None = None) -> dict[str, tuple[int, int]]:
    """One run: claim, parse once, write records and rejects, mark as done. Returns (records, rejects) by kind.

    ``ingest_seq`` is an SQL expression over a record that breaks ties between versions fetched at the same instant (default: the landing's hash).
    """
    files = claim(spark, landed, root, run_id)
    _delete(spark, f"{root}/done/run_id={run_id}")
    counts = {}
    for kind in KINDS:
        _delete(spark, f"{root}/bronze/{kind}/run_id={run_id}")
        _delete(spark, f"{root}/rejects/{kind}/run_id={run_id}")
        if kind not in files:
            continue
        tagged, good_cols, keep = landing.land_tagged(spark.read.parquet(*files[kind]), kind)
        tagged = tagged.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good, rejected = landing.split_tagged(tagged, good_cols, keep)
            if ingest_seq:
                good = good.withColumn("ingest_seq", F.expr(ingest_seq))
            day = F.to_date(F.substring("fetched_at", 1, 10))
            records = bronze.write_bronze(good, f"{root}/bronze", kind, day, run_id, mode="append", partition_by=RUN_PARTITIONS)
            refused = bronze.counted_write(rejected.select("repo_full_name", "raw_payload", "reason"),
                                           lambda df, path=f"{root}/rejects/{kind}/run_id={run_id}": df.write.parquet(path))
            counts[kind] = records, refused
        finally:
            tagged.unpersist()
    spark.createDataFrame([(k, *v) for k, v in counts.items()], "kind STRING, records BIGINT, rejects BIGINT").coalesce(1).write.parquet(
        f"{root}/done/run_id={run_id}")
    return counts


def read_runs(spark: SparkSession, root: str, kind: str, runs: Sequence[str] | None = None) -> DataFrame:
    """Bronze records of the done runs (or of some of them); other runs are pruned by their folder."""
    done = [r for r in _runs(spark, f"{root}/done") if runs is None or r in runs]
    if not done or not _exists(spark, f"{root}/bronze/{kind}"):
        return spark.createDataFrame([], schemas.nullable(schemas.BRONZE_SCHEMAS[kind]))
    return bronze.read_bronze(spark, f"{root}/bronze", kind, partition_by=RUN_PARTITIONS).where(F.col("run_id").isin(done))


def models(spark: SparkSession, root: str, as_of=None) -> Models:
    """The models over the records of all done runs."""
    return Models({kind: read_runs(spark, root, kind) for kind in KINDS}, as_of)


def pages_to_gold(spark: SparkSession, landed: str, root: str, run_id: str, as_of=None, ingest_seq: str | None = None) -> dict[str, str]:
    """One command from collected pages to written silver and gold tables (name -> path, below ``root/tables``)."""
    run(spark, landed, root, run_id, ingest_seq)
    return materialize.build(spark, models(spark, root, as_of), f"{root}/tables")
