"""Small helpers that the operators of this subpackage share.

Every operator reads its rows by the names given to it and works on internal
copies of those columns, so other columns of the input never clash with its own.
"""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline.session import work_path
from forgeline.sources.tables import read_table

#: The fold that no model may learn from: crc32(doc_id as text) mod 4 = 2.
HELD_OUT = "coalesce(pmod(crc32(cast({0} as string)), 4) = 2, false)"

#: `[^\x20\x09-\x0D]+`, the words of sizes and quality rules, as SQL pattern text.
SPACED_WORD = r"[^\\x20\\x09-\\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns most operators read; pruned at the scan."""
    return df.selectExpr(f"`{id_col}` as doc_id", f"cast(`{text_col}` as string) as text")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so they need not have it installed."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        with tempfile.TemporaryDirectory() as folder:
            copy = os.path.join(folder, "copy")
            shutil.copytree(package, os.path.join(copy, os.path.basename(package)), ignore=shutil.ignore_patterns("__pycache__"))
            archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="forgeline-code-"), "forgeline"), "zip", copy)
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


def arrow_map(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """`mapInArrow` with this package at hand in the workers.

    Workers outlive tasks, so each task hands the memory it no longer needs back to the system.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim_memory()

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def trim_memory() -> None:
    """Free heap pages go back to the system where the C library can do it (glibc)."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def binary_column(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """One column of a batch as UTF-8 bytes."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def slices(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges whose lengths sum to about `most` (one row at least)."""
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += int(n)
    if start < len(lengths):
        yield start, len(lengths)


def materialized(df: DataFrame, name: str) -> DataFrame:
    """Write to a new table in the shared folder and read it back: cuts lineage, survives lost executors."""
    path = work_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def train_sample(labelled: DataFrame, key: str, most: int, salt: str) -> list:
    """At most `most` rows, those with the smallest hash of `key`: a bounded, repeatable sample for fitting."""
    order = F.expr(f"md5(concat('{salt}', coalesce(cast(`{key}` as string), '')))")
    return labelled.orderBy(order).limit(most).collect()
