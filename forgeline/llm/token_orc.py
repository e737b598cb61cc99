"""Token ids of whole texts in ORC files.

Documents are ranged by id, each range sorted, encoded and written as ORC: the
ids are integer columns (ORC run-length encodes them), every `row_index_stride` rows have a row
index with minima and maxima, and document ids have a Bloom filter, so a reader takes stripes in
parallel and skips those that cannot hold the ids it asks for. `read_ids` and `find` read the files.

Texts are cut before spaces that follow another character, if the vocabulary file says that its tokenizer ends a piece there
(`chunks.byte_level_cuts`: no normaliser, byte-level pre-tokenizer with its pattern, BPE); other files have their texts encoded whole. Each distinct
chunk is encoded once: the frequent ones of a bounded sample once for all workers (`chunks.frequent`: 200,000 chunks of 64 bytes at most), the
others once in their slice of about 6 MB; ids are joined back by position, about 1 MB of text at a time. The vocabulary file is read on the driver (a parameter; a few MB,
`byte_level.MOST_VOCABULARY_BYTES` at most) and sent along, so executors need no such file.

Defined cases: null and empty texts have the end id alone. Rows that repeat an id stand next to each other, ordered by the
text's hash; each has its own start. Null ids come first. An empty table gives no row. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline.llm.byte_level import byte_level, id_rows, vocabulary_text
from forgeline.llm.chunks import Chunked, Segments, byte_level_cuts, frequent, text_bytes, text_slices
from forgeline.llm.common import arrow_map, id_text, slices
from forgeline.session import work_path
from forgeline.sources.bronze import session_conf

END_ID = 2
#: Bytes of text that are cut and encoded together and come in one Arrow batch (a longer text comes alone), and those that are written together:
#: what a worker holds follows them.
SLICE_BYTES, EXPANDED_BYTES = 6 << 20, 1 << 20
ORC_OPTIONS = {
    "orc.stripe.size": str(16 * 2**20),
    "orc.row.index.stride": "1000",
    "orc.create.index": "true",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "compression": "zstd",
}


def write_ids(docs: DataFrame, path: str, tokenizer_path: str | None = None, end_id: int = END_ID,
              id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text and write (part, doc_id, part_start, part_end, ids) as ORC files in ascending order of id.

    part numbers the ranges (one file each), part_start and part_end count the ids of its range before and after the document.
    """
    file = vocabulary_text(tokenizer_path)
    cut = byte_level_cuts(file)
    context = docs.sparkSession.sparkContext
    vocabulary = context.broadcast(file)
    texts = id_text(docs, id_col, text_col)
    known = context.broadcast(frequent(texts, cut, "", lambda: lambda c: id_rows(byte_level(vocabulary.value).ids(c)), "ids array<int>"))
    ranged = texts.repartitionByRange("doc_id").withColumn("tie", F.expr("xxhash64(text)")).sortWithinPartitions("doc_id", "tie")
    ranged = ranged.selectExpr("spark_partition_id() as part", "doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return id_batches(batches, Segments(lambda c: id_rows(byte_level(vocabulary.value).ids(c)), known.value), cut, end_id)

    kind = docs.schema[id_col].dataType.simpleString()
    encoded = arrow_map(ranged, encode, f"part int, doc_id {kind}, part_start long, part_end long, ids array<int>")
    with session_conf(docs.sparkSession, {"spark.sql.execution.arrow.maxBytesPerBatch": str(SLICE_BYTES)}):
        encoded.write.options(**ORC_OPTIONS).orc(path)


def id_batches(batches: Iterator[pa.RecordBatch], segments: Segments, cut: bool, end_id: int) -> Iterator[pa.RecordBatch]:
    """The rows (part, doc_id, part_start, part_end, ids) of one range, from its batches of (part, doc_id, text)."""
    written = 0
    for batch in batches:
        for rows, some in text_slices(batch, "text", SLICE_BYTES):
            chunked = Chunked(some, cut)
            lists = segments.of(chunked).column(0)
            values, chunk_ends = lists.values.to_numpy(), lists.offsets.to_numpy()
            for first, last in slices(text_bytes(some), EXPANDED_BYTES):
                flat, bounds = chunked.ragged(values, chunk_ends, first, last)
                # the end id goes behind each text
                flat = np.insert(flat, bounds[1:], np.int32(end_id))
                ends = bounds + np.arange(len(bounds))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0)[first:last], rows.column(1)[first:last], pa.array(written + ends[:-1], pa.int64()),
                     pa.array(written + ends[1:], pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                    names=["part", "doc_id", "part_start", "part_end", "ids"])
                written += int(ends[-1])


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The written rows; columns and filters on doc_id reach the ORC reader."""
    return spark.read.orc(path)


def find(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """The rows of a few documents: stripes and row groups without them are skipped by index and Bloom filter."""
    return read_ids(spark, path).where(f"doc_id in ({', '.join(str(int(i)) for i in ids)})" if ids else "false")


def index(written: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    start adds up the totals of the ranges before (one row per range) and part_start.
    """
    kind = written.schema["doc_id"].dataType.simpleString()

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            flat = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            ends = ids.offsets.to_numpy()
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 pa.array(np.diff(ends), pa.int64()), pa.array(crc, pa.int64())],
                names=["part", "doc_id", "part_start", "n_tokens", "ids_crc32"])

    rows = arrow_map(
        written.select("part", "doc_id", "part_start", "ids"), sums, f"part int, doc_id {kind}, part_start long, n_tokens long, ids_crc32 long")
    totals = written.selectExpr("part as p", "part_end").groupBy("p").max("part_end").toDF("p", "total")
    before = totals.selectExpr(
        "p", "coalesce(sum(total) over (order by p rows between unbounded preceding and 1 preceding), 0) as before")
    return rows.join(before, rows.part == before.p).selectExpr(
        "doc_id", "before + part_start as start", "n_tokens", "ids_crc32")


def token_index(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write `docs` as ORC (to `path`, else a new folder of the shared one), read the files back and index them."""
    spark = docs.sparkSession
    path = path or work_path(spark, "llm-token-ids")
    write_ids(docs, path, **options)
    return index(read_ids(spark, path))
