"""Texts as sequences of distinct chunks: cut once, work on each distinct chunk once, join back by position.

A chunk begins at a space whose previous character is no white space (and not U+2581), and at the start of a text. Byte-level
pre-tokenisation ends a piece there, and so do models whose pieces hold white-space marks at their front only, so ids of a
text are the ids of its chunks in order. `byte_level_cuts` and `front_mark_cuts` check a vocabulary for that; with one that fails,
every text is one chunk.

Cuts are found on the UTF-8 bytes of a whole slice of texts (numpy), the distinct chunks by Arrow's dictionary encoding. Nothing here
depends on other slices, so a lost task is repeated with the same result. Memory follows the slice.

`frequent` has the most frequent chunks of a bounded sample worked on once, in Spark tasks, and sends the rows to every worker (at most
`KNOWN` chunks of `KNOWN_BYTES` bytes); `Segments` looks chunks up there and works on a slice's other distinct chunks once each. The sample
decides cost only: a chunk gets the same row from the table and from its own slice.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from forgeline.llm.common import arrow_map, slices

#: Bytes of text that are cut and encoded together.
SLICE_BYTES = 8 << 20
#: Bounds of the table of frequent chunks, and of the rows it is learned from.
KNOWN, KNOWN_BYTES, SAMPLE_ROWS = 200_000, 64, 20_000

#: Last bytes of characters that may be white space or U+2581: no cut after them (a missed cut changes no id).
_SPACE_END = np.zeros(256, bool)
_SPACE_END[:33] = True
_WIDE_END = np.zeros(256, bool)
_WIDE_END[[0x80, 0x81, 0x82, 0x83, 0x84, 0x85, 0x86, 0x87, 0x88, 0x89, 0x8A, 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True
_WIDE_LEAD = np.zeros(256, bool)
_WIDE_LEAD[[0x80, 0x81, 0x96, 0x9A, 0xC2]] = True


class Chunked:
    """One slice of texts: `distinct` chunks, their `codes` by position, and `bounds` of each text in `codes`."""

    def __init__(self, texts: pa.Array, cut: bool):
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        low, high = int(offsets[0]), int(offsets[-1])
        at = offsets[:-1][np.diff(offsets) > 0]
        if cut and high > low:
            folded = np.frombuffer(data, np.uint8)[low:high]
            spaces = np.flatnonzero(folded[1:] == 32) + 1
            last, before = folded[spaces - 1], folded[np.maximum(spaces - 2, 0)]
            spaces = spaces[~(_SPACE_END[last] | (_WIDE_END[last] & _WIDE_LEAD[before]))]
            begins = np.zeros(high - low, bool)
            begins[spaces] = True
            begins[at - low] = True
            at = np.flatnonzero(begins) + low
        ends = np.append(at, high).astype(np.int32)
        if len(at):
            encoded = pa.StringArray.from_buffers(len(at), pa.py_buffer(ends), data).dictionary_encode()
            self.distinct, self.codes = encoded.dictionary, encoded.indices.to_numpy()
        else:
            self.distinct, self.codes = pa.array([], pa.string()), np.empty(0, np.int32)
        self.bounds = np.searchsorted(at, offsets)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Per text the sum over its chunks of a number that each distinct chunk has."""
        return np.diff(np.concatenate([[0], np.cumsum(values[self.codes])])[self.bounds])

    def ragged(self, values: np.ndarray, ends: np.ndarray, first: int = 0, last: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Values of all chunks of the texts from `first` to before `last` (all) in order, and the bounds of each text in them; chunk c has
        values[ends[c]:ends[c + 1]]."""
        bounds = self.bounds[first:None if last is None else last + 1]
        codes = self.codes[bounds[0]:bounds[-1]]
        lengths = np.diff(ends)[codes]
        to = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat(ends[:-1][codes] - to[:-1], lengths) + np.arange(to[-1])
        return values[at], to[bounds - bounds[0]]


def text_bytes(texts: pa.Array) -> np.ndarray:
    """The number of bytes of each text."""
    return np.diff(np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1])


def text_slices(batch: pa.RecordBatch, name: str, most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Parts of a batch of about `most` bytes of text, with the text column (null: empty)."""
    texts = batch.column(batch.schema.get_field_index(name)).cast(pa.string()).fill_null("")
    for a, b in slices(text_bytes(texts), most):
        yield batch.slice(a, b - a), texts.slice(a, b - a)


class Segments:
    """Rows of distinct chunks: those of the shared table, and what `segment` makes of a slice's other chunks.

    `segment` turns a list of chunks into a record batch with one row each, in order, of the table's columns without `chunk`.
    """

    def __init__(self, segment: Callable[[list[str]], pa.RecordBatch], known: pa.Table | None = None):
        self.segment = segment
        self.names = known.column("chunk").combine_chunks() if known else None
        self.known = known.drop_columns("chunk").combine_chunks().to_batches()[0] if known else None

    def of(self, chunked: Chunked) -> pa.RecordBatch:
        """Rows for the slice; its `codes` then number these rows."""
        if self.known is None:
            return self.segment(chunked.distinct.to_pylist())
        found = pc.index_in(chunked.distinct, value_set=self.names)
        missing = found.is_null().to_numpy(zero_copy_only=False)
        place = found.fill_null(0).to_numpy(zero_copy_only=False).copy()
        place[missing] = len(self.names) + np.arange(missing.sum())
        chunked.codes = place[chunked.codes] if len(place) else chunked.codes
        own = self.segment(chunked.distinct.filter(pa.array(missing)).to_pylist())
        return pa.concat_batches([self.known, own])


def frequent(docs: DataFrame, cut: bool, before: str, make: Callable[[], Callable[[list[str]], pa.RecordBatch]],
             schema: str) -> pa.Table | None:
    """The rows (`chunk`, then `schema`) of the most frequent chunks of the column `text`; None if texts are not cut.

    `make` is called in each task and gives what segments; `before` is put before each text.
    """
    if not cut:
        return None
    rows = docs.count()
    some = docs.select("text").sample(min(1.0, SAMPLE_ROWS / max(rows, 1)), 7)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in text_slices(batch, "text"):
                chunked = Chunked(pc.binary_join_element_wise(before, texts, "") if before else texts, True)
                n = pa.array(np.bincount(chunked.codes, minlength=len(chunked.distinct)), pa.int64())
                short = pc.and_(pc.less_equal(pc.binary_length(chunked.distinct), KNOWN_BYTES), pc.greater(n, 1))
                yield pa.RecordBatch.from_arrays([chunked.distinct.filter(short), n.filter(short)], names=["chunk", "n"])

    def segmented(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = make()
        for batch in batches:
            rows = segment(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), *rows.columns], names=["chunk", *rows.schema.names])

    counts = arrow_map(some, counted, "chunk string, n long").groupBy("chunk").sum("n").toDF("chunk", "n")
    top = counts.orderBy("n", "chunk", ascending=[False, True]).limit(KNOWN).select("chunk").repartition(docs.sparkSession.sparkContext.defaultParallelism)
    table = arrow_map(top, segmented, f"chunk string, {schema}").toArrow()
    return table if table.num_rows else None


def stacked(rows: list, kind) -> tuple[np.ndarray, np.ndarray]:
    """Lists as one array and their ends (from 0)."""
    ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, rows), np.int64, len(rows)))])
    return np.fromiter((x for r in rows for x in r), kind, int(ends[-1])), ends


def byte_level_cuts(vocabulary: str) -> bool:
    """Is this tokenizer file byte-level BPE that always ends a piece before such a space?"""
    try:
        file = json.loads(vocabulary)
        cutter, model = file["pre_tokenizer"], file["model"]
        return (
            file["normalizer"] is None
            and cutter["type"] == "ByteLevel" and not cutter["add_prefix_space"] and cutter.get("use_regex", True)
            and model["type"] == "BPE" and not model.get("dropout")
            and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
            and (file.get("post_processor") or {"type": "ByteLevel"})["type"] == "ByteLevel"
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"])
                        for t in file.get("added_tokens", [])))
    except (KeyError, TypeError, AttributeError, ValueError):
        return False


def front_mark_cuts(model: bytes) -> bool:
    """Is this SentencePiece file a BPE model without normalisation whose pieces never hold a mark behind another character?"""
    try:
        from sentencepiece import sentencepiece_model_pb2
    except ImportError:  # without protobuf the file cannot be checked
        return False
    file = sentencepiece_model_pb2.ModelProto.FromString(model)
    norm, trained = file.normalizer_spec, file.trainer_spec
    return (
        not norm.precompiled_charsmap and norm.add_dummy_prefix and not norm.remove_extra_whitespaces and norm.escape_whitespaces
        and trained.model_type == trained.BPE and trained.byte_fallback and not trained.treat_whitespace_as_suffix
        and not any(p.type == p.USER_DEFINED or re.search("[^▁]▁", p.piece) for p in file.pieces))
