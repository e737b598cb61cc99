"""Delta mart, late rows beside counts, redeliveries."""

from __future__ import annotations

import datetime as dt
import glob
import json
import os

import pytest

from forgeline.streaming import jobs
from tests.conftest import SF_SMALL

KEYS, ORDER = ["k"], ["at", "seq"]


def _rows(n, batch, of=1000):
    """n of `of` keys, newer with each batch but for every seventh."""
    return [(f"k{(i * 37 + batch) % of}", f"v{batch}-{i}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=-5 if i % 7 == 0 else batch), batch * 10_000 + i)
            for i in range(n)]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v string, at timestamp_ntz, seq bigint")


def _newest(rows):
    out = {}
    for k, v, at, seq in rows:
        if k not in out or (at, seq) > out[k][:2]:
            out[k] = (at, seq, v)
    return {k: v[2] for k, v in out.items()}


def _size(path):
    return sum(os.path.getsize(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True))


def _values(spark, root):
    return {r["k"]: r["v"] for r in jobs.read_mart(spark, root, KEYS, ORDER).collect()}


def test_deltas_follow_the_batch_and_compaction_keeps_the_mart(spark, tmp_dir):
    root, all_rows = os.path.join(tmp_dir, "mart"), []
    for batch, n in enumerate((4000, 10, 10, 40, 10, 10)):
        rows = _rows(n, batch, of=4000)
        all_rows += rows
        fresh = _newest(rows)
        jobs.write_delta(_frame(spark, [r for r in rows if fresh[r[0]] == r[1]]), root, batch, KEYS)
    sizes = [_size(f"{root}/delta/batch_id={b}") for b in range(6)]
    assert max(sizes[1:]) < sizes[0] / 2
    want = _newest(all_rows)
    assert _values(spark, root) == want
    assert jobs.compact(spark, root, KEYS, ORDER) == 6 and jobs._deltas(spark, root) == []
    assert _values(spark, root) == want and jobs.compact(spark, root, KEYS, ORDER) == 0
    # a small delta rewrites its buckets of the base only
    before = {d: set(os.listdir(d)) for d in glob.glob(f"{root}/base/bucket=*")}
    late = _rows(2, 9, of=4000)
    jobs.write_delta(_frame(spark, late), root, 6, KEYS)
    touched = {f"{root}/base/{os.path.basename(d)}" for d in glob.glob(f"{root}/delta/batch_id=6/bucket=*")}
    jobs.compact(spark, root, KEYS, ORDER)
    assert {d for d in before if set(os.listdir(d)) != before[d]} == touched and 1 <= len(touched) <= 2
    assert _values(spark, root) == _newest(all_rows + late)


def test_a_compaction_that_failed_is_repeated(spark, tmp_dir):
    """The base already holds the deltas that are still there."""
    root = os.path.join(tmp_dir, "failed")
    rows = [_rows(300, b) for b in range(3)]
    for b, r in enumerate(rows):
        jobs.write_delta(_frame(spark, r), root, b, KEYS)
        if b == 1:
            jobs.compact(spark, root, KEYS, ORDER)
            for again in (0, 1):
                jobs.write_delta(_frame(spark, rows[again]), root, again, KEYS)
    want = _newest(sum(rows, []))
    assert _values(spark, root) == want
    assert jobs.compact(spark, root, KEYS, ORDER) == 3 and _values(spark, root) == want
    with pytest.raises(FileNotFoundError):
        jobs.read_mart(spark, os.path.join(tmp_dir, "nothing"), KEYS, ORDER)


def test_an_upsert_stream_is_folded_while_it_runs(spark, tmp_dir):
    root, src = os.path.join(tmp_dir, "folded"), os.path.join(tmp_dir, "folded-in")
    rows = [_rows(60, b) for b in range(5)]
    for b, r in enumerate(rows):
        _frame(spark, r).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(_frame(spark, []).schema).option("maxFilesPerTrigger", 1).parquet(src)
    jobs.await_all(jobs.upsert_stream(stream, KEYS, ORDER, root, f"{root}-ck", compact_after=2))
    assert jobs._deltas(spark, root) == [4] and _values(spark, root) == _newest(sum(rows, []))


def _events(spark, rows):
    return spark.createDataFrame(rows, "id bigint, k string, ts timestamp_ntz")


def _land(spark, src, parts):
    for p in parts:
        _events(spark, p).coalesce(1).write.mode("append").parquet(src)
    return spark.readStream.schema(_events(spark, []).schema).option("maxFilesPerTrigger", 1).parquet(src)


def _at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


PARTS = [
    [(1, "a", _at(1, 5)), (2, "a", _at(1, 23)), (3, "b", _at(2, 1))],
    [(4, "a", _at(1, 22)), (5, "a", _at(3, 4)), (6, "b", None)],          # 4: the watermark stands at 2nd, 00:00: late
    [(7, "a", _at(2, 8)), (8, "b", _at(3, 1)), (9, "b", _at(4, 9))],      # 7: its day ended at 3rd, 00:00, watermark 3rd, 03:00: late; 8: in time
]


def test_late_rows_and_counts_make_up_the_input(spark, tmp_dir):
    out = os.path.join(tmp_dir, "late")
    stream = _land(spark, f"{out}-in", PARTS)
    jobs.await_all(jobs.counts_with_late_rows(stream, "ts", ["k"], out, f"{out}-ck"))
    late = {(r["id"], r["window_start"], r["batch_id"]) for r in jobs.read_late(spark, out).collect()}
    assert late == {(4, _at(1), 1), (7, _at(2), 2)}
    counts = {(r["k"], r["window_start"]): (r["records"], r["closed"]) for r in jobs.read_counts(spark, out, ["k"]).collect()}
    assert counts == {("a", _at(1)): (2, True), ("b", _at(2)): (1, True), ("a", _at(3)): (1, True), ("b", _at(3)): (1, True),
                      ("b", _at(4)): (1, False), ("b", None): (1, False)}
    assert sum(n for n, _ in counts.values()) + len(late) == sum(map(len, PARTS))


def test_closed_counts_equal_the_built_in_aggregation(spark, tmp_dir):
    """Without late rows, closed windows have the counts that Spark's own watermarked aggregation emits over the same batches."""
    out = os.path.join(tmp_dir, "same")
    parts = [[r for r in p if r[2] and r[0] not in (4, 7)] for p in PARTS]
    for name, start in (("own", lambda s: jobs.counts_with_late_rows(s, "ts", ["k"], f"{out}/own", f"{out}/own-ck")),
                        ("built", lambda s: jobs.daily_counts_stream(s, "ts", ["k"], f"{out}/built", f"{out}/built-ck"))):
        jobs.await_all(start(_land(spark, f"{out}/{name}-in", parts)))
    built = {(r["k"], r["window_start"], r["records"]) for r in spark.read.parquet(f"{out}/built").collect()}
    own = {(r["k"], r["window_start"], r["records"]) for r in jobs.read_counts(spark, f"{out}/own", ["k"]).where("closed").collect()}
    assert own == built and own


def test_redeliveries_count_once(spark, tmp_dir):
    out = os.path.join(tmp_dir, "once")
    first = [(i, "a", _at(1, i % 24)) for i in range(40)]
    second = [(100 + i, "a", _at(2, i % 24)) for i in range(30)] + first[:15] + first[:5]
    third = [(200, "a", _at(9, 1))] + second[:10] + first[:3]  # the last come behind the watermark
    stream = _land(spark, f"{out}-in", [first + first[7:9], second, third])
    jobs.await_all(jobs.deduplicated_counts_stream(stream, "ts", "id", ["k"], out, f"{out}-ck", "2 days"))
    assert {(r["window_start"], r["records"]) for r in spark.read.parquet(out).collect()} == {(_at(1), 40), (_at(2), 30)}


@pytest.mark.parametrize("name, parts", [("stream_dedup_counts", 3), ("stream_daily_counts", 3), ("stream_late_rows", 3), ("stream_latest_state", 6),
                                         ("stream_upsert_latest", 6)])
def test_parts_land_by_many_tasks_as_one_micro_batch_each(spark, tmp_dir, monkeypatch, name, parts):
    from forgeline import catalog

    sf_dir, rows = os.path.join(tmp_dir, "sf"), 600
    columns = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
    made = {"event_id": "id", "ts": "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, CAST(id * 72 AS INT))",
            "user_id": "id % 5", "event_type": "element_at(array('view', 'click', 'error', 'purchase'), CAST(id % 4 AS INT) + 1)"}
    events = spark.range(0, rows, 1, 3).selectExpr(
        *[f"CAST({made.get(f.name, 'id' if f.dataType.typeName() != 'string' else repr('{}'))} AS {f.dataType.simpleString()}) AS `{f.name}`" for f in columns])
    events.write.parquet(f"{sf_dir}/events.parquet")
    monkeypatch.setattr(catalog, "work_path", lambda session, folder: os.path.join(tmp_dir, folder))
    got = catalog.QUERIES[name](spark, sf_dir)
    root = glob.glob(f"{tmp_dir}/stream-*")[0]
    batches = {}
    for f in glob.glob(f"{root}/checkpoint/sources/0/*"):
        with open(f) as lines:
            for entry in map(json.loads, [x for x in lines if x.startswith("{")]):
                batches.setdefault(entry["batchId"], set()).add(entry["path"])
    landed = glob.glob(f"{root}/landing/*.parquet")
    assert len(batches) == parts and sum(map(len, batches.values())) == len(landed) > parts
    if name != "stream_latest_state" and name != "stream_upsert_latest":
        seen, delay = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=72 * (rows - 1)), catalog.REDELIVERY_DELAY if "dedup" in name else catalog.STREAM_DELAY
        amount, unit = delay.split()
        closed = (seen - dt.timedelta(**{unit if unit.endswith("s") else f"{unit}s": int(amount)})).date()
        days = [(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=72 * i)).date() for i in range(rows)]
        found = got.where("closed").collect() if name == "stream_late_rows" else got.collect()
        assert sum(r["records"] + (r["late_records"] if name == "stream_late_rows" else 0) for r in found) == sum(d < closed for d in days)
