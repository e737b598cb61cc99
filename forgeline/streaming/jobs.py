"""Structured Streaming jobs: parse landed events, windowed counts, latest state.

All three read a file source (a Kafka source plugs in the same way where its
package is on the classpath: ``readStream.format("kafka")`` with a value
column), write through checkpointed sinks, and run either continuously or as
``trigger(availableNow=True)`` for catch-up and tests.

* :func:`parse_stream` -- landed pages -> typed records + rejects, written per
  micro-batch by ``foreachBatch`` into ``batch_id=`` folders with overwrite, so
  a replayed batch replaces its own output (exactly-once effect).
* :func:`daily_counts_stream` -- event-time ``window(ts, '1 day')`` counts
  with a watermark, append mode: a window is emitted once, when it closes.
* :func:`latest_state_stream` -- latest version per key; ``row_number`` is not
  supported on streams, so ``max_by(struct, (fetched_at, ingest_seq))`` in
  update mode, without a lateness bound. The updated keys of each batch are
  upserted into the serving table.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from forgeline.functions.columns import utc_instant, utc_wall_clock
from forgeline.sources import landing


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    # commit a small changelog per batch instead of uploading a snapshot each time
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def _explicit(spark: SparkSession, key: str, other: str) -> bool:
    """Whether the session sets ``key`` (a value equal to ``other`` needs no change either)."""
    return spark.conf.get(key, other) != other


def _start(df: DataFrame, checkpoint: str, trigger_once: bool, **kw) -> StreamingQuery:
    # Keyed state (latest version per key) grows with the number of keys: keep it
    # in RocksDB off the JVM heap unless the session chose a provider. The query keeps the settings
    # it starts with, so the session's own are put back at once.
    spark = df.sparkSession
    chosen = _explicit(spark, "spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    w = df.writeStream.option("checkpointLocation", checkpoint)
    for k, v in kw.items():
        w = getattr(w, k)(*v) if isinstance(v, tuple) else getattr(w, k)(v)
    if trigger_once:
        w = w.trigger(availableNow=True)
    if chosen:
        return w.start()
    for k, v in _STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        return w.start()
    finally:
        for k in _STATE_CONF:
            spark.conf.unset(k)


# ------------------------------------------------------------------ B1: parse
def parse_stream(pages: DataFrame, kind: str, out: str, checkpoint: str,
                 trigger_once: bool = True) -> StreamingQuery:
    """Streaming landing: ``pages`` is a streaming frame of landed pages.

    Each micro-batch is parsed once: the tagged items are persisted (memory,
    spilling to disk) for the two writes, then released."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        tagged, good_cols, keep = landing.land_tagged(batch, kind)
        tagged = tagged.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good, rejected = landing.split_tagged(tagged, good_cols, keep)
            good.write.mode("overwrite").parquet(f"{out}/records/batch_id={batch_id}")
            rejected.write.mode("overwrite").parquet(f"{out}/rejects/batch_id={batch_id}")
        finally:
            tagged.unpersist()
    return _start(pages, checkpoint, trigger_once, foreachBatch=per_batch)


# ------------------------------------------------------------------ B2: windowed counts
def daily_counts(events: DataFrame, time_col: str, keys: list[str], delay: str = "1 hour",
                 window: str = "1 day", slide: str | None = None) -> DataFrame:
    """Event-time window counts; the watermark column must be ``timestamp``
    (not ``timestamp_ntz``), so naive UTC times become instants explicitly."""
    spark = events.sparkSession
    ts = events.withColumn("_event_time", utc_instant(time_col, spark)).withWatermark("_event_time", delay)
    win = F.window("_event_time", window, slide) if slide else F.window("_event_time", window)
    counted = ts.groupBy(win.alias("w"), *keys).agg(F.count(F.lit(1)).alias("records"))
    return counted.select(
        *keys,
        F.to_date(utc_wall_clock("w.start", spark)).alias("day"),
        utc_wall_clock("w.start", spark).alias("window_start"),
        utc_wall_clock("w.end", spark).alias("window_end"),
        F.col("records").cast("bigint").alias("records"),
    )


def daily_counts_stream(events: DataFrame, time_col: str, keys: list[str], out: str, checkpoint: str,
                        delay: str = "1 hour", trigger_once: bool = True) -> StreamingQuery:
    counts = daily_counts(events, time_col, keys, delay)
    return _start(counts, checkpoint, trigger_once, outputMode="append", format="parquet", option=("path", out))


# ------------------------------------------------------------------ B3: latest state
def latest_state(records: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Latest row per key as a streaming aggregation (update mode).

    ``max_by`` gives the same row in whatever order and however often records arrive, so
    there is no watermark: a late record of a new key counts, a redelivered one changes nothing. The state holds one
    row per key.
    """
    value_cols = [c for c in records.columns if c not in keys]
    latest = records.groupBy(*keys).agg(
        F.max_by(F.struct(*value_cols), F.struct(*order)).alias("_latest"))
    return latest.select(*keys, "_latest.*")


def latest_state_stream(records: DataFrame, keys: list[str], order: list[str], out: str, checkpoint: str,
                        trigger_once: bool = True, compact_after: int | None = None) -> StreamingQuery:
    """The updated keys of each batch become a delta of the serving table (see :func:`write_delta`)."""
    state = latest_state(records, keys, order)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        write_delta(batch, out, batch_id, keys)
        if compact_after and len(_deltas(batch.sparkSession, out)) >= compact_after:
            compact(batch.sparkSession, out, keys, [BATCH])
    return _start(state, checkpoint, trigger_once, outputMode="update", foreachBatch=per_batch)


def serving_view(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """Current serving table = the last emitted version of every key."""
    return read_mart(spark, out, keys, [BATCH])


def await_all(*queries: StreamingQuery) -> None:
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))


class LateRows(StreamingQueryListener):
    """Counts late rows of all batches: input rows that a stateful operator dropped because they were older than the watermark.

    Register before the query starts (``spark.streams.addListener``). Spark compares incoming rows with the watermark of the
    *previous* micro-batch, so a row arriving in the very batch where the watermark passes its window is still counted in that window.
    """

    def __init__(self):
        self.rows: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.rows.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.rows[str(p.id)] = self.rows.get(str(p.id), 0) + sum(int(o.numRowsDroppedByWatermark) for o in p.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def rows_dropped_by_watermark(query: StreamingQuery) -> int:
    """Late rows of the *recent* batches (``recentProgress`` is a bounded list); :class:`LateRows` counts all."""
    total = 0
    for p in query.recentProgress:
        for op in p.get("stateOperators", []) if isinstance(p, dict) else p.stateOperators:
            total += int((op.get("numRowsDroppedByWatermark") if isinstance(op, dict)
                          else op.numRowsDroppedByWatermark) or 0)
    return total


# ------------------------------------------------------------------ B3 + B7: a keyed mart by deltas
#: Column that numbers the micro-batch a row came with.
BATCH = "batch_id"
MART_BUCKETS = 16


def _folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Committed folders of that prefix below ``path`` (a metadata call)."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return [n for n in names if n.startswith(prefix) and fs.exists(hadoop.Path(f"{path}/{n}/_SUCCESS"))]


def _deltas(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n.split("=")[1]) for n in _folders(spark, f"{root}/delta", f"{BATCH}="))


def write_delta(rows: DataFrame, root: str, batch_id: int, keys: list[str], buckets: int = MART_BUCKETS) -> None:
    """Write the rows of one micro-batch to ``delta/batch_id=<n>/bucket=<hash of the key>``: what a batch writes follows the batch, not the mart.

    A replayed batch replaces its own folder.
    """
    (rows.withColumn("bucket", F.expr(f"CAST(pmod(xxhash64({', '.join(f'`{k}`' for k in keys)}), {buckets}) AS INT)"))
     .hint("rebalance", "bucket").write.mode("overwrite").option("compression", "zstd").partitionBy("bucket")
     .parquet(f"{root}/delta/{BATCH}={batch_id}"))


def _delta_rows(spark: SparkSession, root: str, batches: list[int]) -> DataFrame:
    return spark.read.option("basePath", f"{root}/delta").parquet(*[f"{root}/delta/{BATCH}={b}" for b in batches]).withColumn(
        BATCH, F.col(BATCH).cast("bigint"))


def _base(spark: SparkSession, root: str) -> DataFrame | None:
    """The base, if one was ever written (a half-written one is right too: its deltas are still there)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/base")
    exists = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
    return spark.read.parquet(f"{root}/base") if exists else None


def read_mart(spark: SparkSession, root: str, keys: list[str], order: list[str]) -> DataFrame:
    """Merge on read: the latest row of every key over the base and the deltas that are not folded yet.

    ``latest`` over rows that are there twice is the same, so a reader may see a delta beside a base that already holds it.
    """
    from forgeline.operators.dedup import latest_by

    batches, base = _deltas(spark, root), _base(spark, root)
    parts = [p for p in (base, _delta_rows(spark, root, batches) if batches else None) if p is not None]
    if not parts:
        raise FileNotFoundError(f"no committed rows under {root}")
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return latest_by(rows, keys, [F.col(c).desc_nulls_last() for c in order]).drop(BATCH, "bucket")


def compact(spark: SparkSession, root: str, keys: list[str], order: list[str]) -> int:
    """Fold all committed deltas into the base, rewriting only the buckets they touch; returns how many were folded.

    The base is replaced first and the deltas go afterwards, so a compaction that fails half-way loses nothing and can be repeated.
    """
    from forgeline.operators.dedup import latest_by

    batches = _deltas(spark, root)
    if not batches:
        return 0
    fresh, base = _delta_rows(spark, root, batches), _base(spark, root)
    touched = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]  # at most the number of buckets
    rows = fresh if base is None else base.where(F.col("bucket").isin(touched)).unionByName(fresh)
    merged = latest_by(rows, keys, [F.col(c).desc_nulls_last() for c in order])
    (merged.hint("rebalance", "bucket").write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "dynamic")
     .partitionBy("bucket").parquet(f"{root}/base"))
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for b in batches:
        p = hadoop.Path(f"{root}/delta/{BATCH}={b}")
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    return len(batches)


def upsert_stream(records: DataFrame, keys: list[str], order: list[str], mart_root: str, checkpoint: str,
                  trigger_once: bool = True, compact_after: int | None = None) -> StreamingQuery:
    """Keep a mart of the latest row per key, one delta per micro-batch.

    Inside ``foreachBatch`` the batch is a static frame, so the batch's own latest rows come from the ``row_number`` dedup; older
    redeliveries lose against newer rows when the mart is read or compacted, by the same ordering. A replayed batch rewrites its own delta, so the
    result is exactly once. ``compact_after`` folds the deltas into the base whenever that many stand beside it, which bounds the merge on read.
    """
    from forgeline.operators.dedup import latest_by

    ordering = [F.col(c).desc_nulls_last() for c in order]

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        write_delta(latest_by(batch, keys, ordering), mart_root, batch_id, keys)
        if compact_after and len(_deltas(batch.sparkSession, mart_root)) >= compact_after:
            compact(batch.sparkSession, mart_root, keys, order)

    return _start(records, checkpoint, trigger_once, foreachBatch=per_batch)


# ------------------------------------------------------------------ B2: late rows beside the counts
def counts_with_late_rows(events: DataFrame, time_col: str, keys: list[str], out: str, checkpoint: str, delay: str = "1 hour",
                          window: str = "1 day", trigger_once: bool = True) -> StreamingQuery:
    """Window counts that keep what comes too late: rows behind the watermark land in ``late`` with their window.

    A built-in streaming aggregation drops late rows unseen, so each micro-batch is dealt here: the watermark is the greatest event
    time of all batches *before* less ``delay``, and a row is late if its window ended by then (the built-in rule takes the watermark of one batch
    earlier, so it still counts some rows that are late here). Each batch writes ``late/batch_id=``, its own partial
    counts ``partial/batch_id=`` and, last, ``progress/batch_id=`` (one row: the greatest event time so far). A replayed batch finds the same
    watermark and replaces its own folders. No state is kept between batches but that one row.
    """
    spark = events.sparkSession

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        seen = _greatest_time(session, out, batch_id)
        placed = batch.withColumn("_t", utc_instant(time_col, spark)).withColumn("_w", F.window("_t", window))
        placed = placed.withColumns({"window_start": utc_wall_clock("_w.start", spark), "window_end": utc_wall_clock("_w.end", spark)}).drop("_w")
        # the window function leaves out rows without a time: they count in a window without one
        none = F.lit(None).cast("timestamp_ntz")
        placed = placed.unionByName(batch.where(F.col(time_col).isNull()).withColumns(
            {"_t": F.lit(None).cast("timestamp"), "window_start": none, "window_end": none}))
        late = F.lit(False) if seen is None else F.col("window_end") <= F.lit(seen) - F.expr(f"INTERVAL {delay}")
        placed = placed.withColumn("_late", F.coalesce(late, F.lit(False))).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            placed.where("_late").drop("_t", "_late").write.mode("overwrite").parquet(f"{out}/late/{BATCH}={batch_id}")
            placed.where("NOT _late").groupBy(*keys, "window_start", "window_end").agg(F.count(F.lit(1)).alias("records")).write.mode(
                "overwrite").parquet(f"{out}/partial/{BATCH}={batch_id}")
            placed.agg(F.greatest(F.max(utc_wall_clock("_t", spark)), F.lit(seen).cast("timestamp_ntz")).alias("seen")).write.mode(
                "overwrite").parquet(f"{out}/progress/{BATCH}={batch_id}")
        finally:
            placed.unpersist()

    return _start(events, checkpoint, trigger_once, foreachBatch=per_batch)


def _greatest_time(spark: SparkSession, out: str, before: int | None = None):
    """The greatest event time of the batches before one (of all)."""
    done = [int(n.split("=")[1]) for n in _folders(spark, f"{out}/progress", f"{BATCH}=")]
    done = [b for b in done if before is None or b < before]
    return spark.read.parquet(f"{out}/progress/{BATCH}={max(done)}").first()["seen"] if done else None


def read_counts(spark: SparkSession, out: str, keys: list[str], delay: str = "1 hour") -> DataFrame:
    """Counts of every window so far; ``closed`` windows can only get late rows from now on."""
    seen = _greatest_time(spark, out)
    rows = spark.read.parquet(f"{out}/partial").groupBy(*keys, "window_start", "window_end").agg(F.sum("records").alias("records"))
    return rows.withColumn("closed", F.coalesce(F.col("window_end") <= F.lit(seen) - F.expr(f"INTERVAL {delay}"), F.lit(False)))


def read_late(spark: SparkSession, out: str) -> DataFrame:
    """Late rows as they came, with their window and batch."""
    return spark.read.parquet(f"{out}/late")


# ------------------------------------------------------------------ B3: redeliveries before counting
def deduplicated_counts(events: DataFrame, time_col: str, delivery_id: str, keys: list[str], delay: str, window: str = "1 day") -> DataFrame:
    """:func:`daily_counts` over each delivery once: a repeat that arrives within ``delay`` of event time is dropped by its id, one that comes later is
    behind the watermark and dropped as late, so no delivery counts twice. The ids are state for ``delay`` only."""
    spark = events.sparkSession
    once = events.withColumn("_event_time", utc_instant(time_col, spark)).withWatermark("_event_time", delay).dropDuplicatesWithinWatermark(
        [delivery_id])
    counted = once.groupBy(F.window("_event_time", window).alias("w"), *keys).agg(F.count(F.lit(1)).alias("records"))
    return counted.select(*keys, utc_wall_clock("w.start", spark).alias("window_start"), utc_wall_clock("w.end", spark).alias("window_end"),
                          F.col("records").cast("bigint").alias("records"))


def deduplicated_counts_stream(events: DataFrame, time_col: str, delivery_id: str, keys: list[str], out: str, checkpoint: str, delay: str,
                               trigger_once: bool = True) -> StreamingQuery:
    counts = deduplicated_counts(events, time_col, delivery_id, keys, delay)
    return _start(counts, checkpoint, trigger_once, outputMode="append", format="parquet", option=("path", out))
