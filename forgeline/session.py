"""Session construction and the shared work folder.

Every job that has to persist intermediate data (streaming checkpoints, landed
files, incremental snapshots) writes below one shared root: the folder the
cluster names in ``spark.checkpoint.dir``. A session that does not name one
(tests, single-machine runs) gets a fresh temporary folder, set once.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that hold on a cluster as well as in local mode. Shuffle partition
# count is left to the caller (cluster: sized to the data; tests: 8).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "forgeline", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from the session; only when the session names none (local runs and
    tests) is a fresh temporary folder created and registered.
    """
    root = spark.sparkContext.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            master = spark.sparkContext.master
            if not master.startswith("local") or master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            root = tempfile.mkdtemp(prefix="forgeline-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared checkpoint root."""
    root = checkpoint_root(spark)
    sep = "" if root.endswith("/") else "/"
    return f"{root}{sep}{name}-{uuid.uuid4().hex[:12]}"


def is_local_path(path: str) -> bool:
    return path.startswith("/") or path.startswith("file:")


def local_fs_path(path: str) -> str:
    """Strip a ``file:`` scheme so local helpers (tests) can list the folder."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
