"""SentencePiece ids of whole texts and texts of ids, by a table of distinct chunks.

If no piece of the model crosses a white-space mark (no piece holds a mark behind another character, which `front_mark_cuts` reads
from the model file), a text's ids are those of its marked words in order. Each text is cut before the spaces that follow another character
(`chunks.Chunked`), each distinct marked word is segmented once (frequent ones once for all workers, others once in their slice of about
8 MB) and the ids are joined back by position. A model that fails the check has its texts segmented whole. A chunk begins with
the space that stands for its mark; the library puts that mark before what follows the space.

Decoding takes the pieces of a column of ids from a table by id: a text is one run of the gathered bytes, without the space of its first mark.
Rows that the table cannot decide (a control, unknown or byte id or a bare mark in front, other unknown or control ids, ids out of range,
bytes that are no UTF-8) go to the library.

Defined cases: null and empty texts have no ids; null or empty ids give an empty text. Ids outside the vocabulary are left out by `decoded`
before decoding. Repeated rows stay rows of their own; an empty table gives no row. Long texts are cut like others, so the library sees one
marked word at a time. Other columns of the input are not read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from forgeline.llm.chunks import Chunked, Segments, frequent, front_mark_cuts, stacked, text_slices
from forgeline.llm.common import arrow_map, id_text

MOST_MODEL_BYTES = 32_000_000


def model_path() -> str:
    """Where the public SentencePiece model lies."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def model_bytes(path: str | None = None) -> bytes:
    """A model file, small enough to be sent to every worker."""
    path = path or model_path()
    size = os.path.getsize(path)
    if size > MOST_MODEL_BYTES:
        raise ValueError(f"{path} has {size} bytes; {MOST_MODEL_BYTES} may be sent to every worker")
    with open(path, "rb") as f:
        return f.read()


_processors: dict[bytes, object] = {}


def processor_of(model: bytes):
    """One processor a worker process."""
    from sentencepiece import SentencePieceProcessor

    if model not in _processors:
        _processors.clear()
        _processors[model] = SentencePieceProcessor(model_proto=model)
    return _processors[model]


def chunk_ids(model: bytes, cut: bool):
    """chunk strings -> list of ids; if texts are cut, a chunk's first space stands for the mark that the library adds."""
    encode = processor_of(model)

    def ids(chunks: list[str]) -> list[list[int]]:
        out = encode.encode([c[1:] for c in chunks] if cut else chunks, out_type=int)
        if cut and "" in (c[1:] for c in chunks):
            # a lone mark: the library gives nothing for an empty text
            alone = [encode.piece_to_id("▁")]
            out = [alone if c == " " else x for c, x in zip(chunks, out)]
        return out

    return ids


def encoded(docs: DataFrame, model: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, ids array<int>) as the library's encode gives them, without begin and end ids."""
    file = model_bytes(model)
    cut = front_mark_cuts(file)
    sent = docs.sparkSession.sparkContext.broadcast(file)
    texts = id_text(docs, id_col, text_col)
    before = " " if cut else ""

    def make():
        ids = chunk_ids(sent.value, cut)

        def segment(chunks: list[str]) -> pa.RecordBatch:
            values, ends = stacked(ids(chunks), np.int32)
            return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))], names=["ids"])

        return segment

    known = docs.sparkSession.sparkContext.broadcast(frequent(texts, cut, before, make, "ids array<int>"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments = Segments(make(), known.value)
        for batch in batches:
            for rows, some in text_slices(batch, "text"):
                marked = pc.if_else(pc.equal(some, ""), "", pc.binary_join_element_wise(before, some, ""))
                chunked = Chunked(marked, cut)
                lists = segments.of(chunked).column(0)
                values, bounds = chunked.ragged(lists.values.to_numpy(), lists.offsets.to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values))], names=["doc_id", "ids"])

    return arrow_map(texts, encode, f"doc_id {docs.schema[id_col].dataType.simpleString()}, ids array<int>")


class Pieces:
    """Bytes by id, and a second copy without the first space for the piece in front; `plain` ids need nothing else."""

    def __init__(self, model: bytes):
        self.library = processor_of(model)
        n = self.library.get_piece_size()
        names = [self.library.id_to_piece(i) for i in range(n)]
        special = np.array([self.library.is_control(i) or self.library.is_unknown(i) for i in range(n)])
        byte = np.array([self.library.is_byte(i) for i in range(n)])
        data = [bytes([int(p[3:5], 16)]) if b else p.replace("▁", " ").encode() for p, b in zip(names, byte)]
        self.n, self.special = n, special
        self.front_odd = special | byte | np.array([not p.strip("▁") for p in names])
        self.data = pa.array(data + [d.removeprefix(b" ") for d in data], pa.binary())

    def texts(self, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """One text for each range of `ids`."""
        ids = ids.astype(np.int64)
        inside = np.concatenate([[0], np.cumsum((ids >= 0) & (ids < self.n))])
        ids, bounds = ids[(ids >= 0) & (ids < self.n)], inside[bounds]
        full = np.flatnonzero(np.diff(bounds) > 0)
        first = bounds[:-1][full]
        odd = np.zeros(len(bounds) - 1, bool)
        odd[full] = self.front_odd[ids[first]]
        odd |= np.diff(np.concatenate([[0], np.cumsum(self.special[ids])])[bounds]) > 0
        at = ids.copy()
        at[first] += self.n
        pieces = self.data.take(pa.array(at))
        ends = np.frombuffer(pieces.buffers()[1], np.int32)[:len(at) + 1][bounds] if len(at) else bounds.astype(np.int32)
        out = pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(ends.astype(np.int32)), pieces.buffers()[2] or pa.py_buffer(b""))
        try:
            out.validate(full=True)
        except pa.ArrowInvalid:
            out = None
        if out is None or odd.any():
            out = pa.array([self.library.decode(ids[a:b].tolist()) if o or out is None else out[i].as_py()
                            for i, (a, b, o) in enumerate(zip(bounds, bounds[1:], odd))], pa.string())
        return out


def decoded(rows: DataFrame, model: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Rows (doc_id, ids, text) with the text that the library's decode gives for the ids."""
    sent = rows.sparkSession.sparkContext.broadcast(model_bytes(model))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(sent.value)
        for batch in batches:
            lists = batch.column(1).fill_null(pa.scalar([], batch.schema.field(1).type)) if batch.column(1).null_count else batch.column(1)
            for at in range(0, len(lists), 2_000):
                some = lists.slice(at, 2_000)
                ends = some.offsets.to_numpy()
                values = some.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, 2_000), some, pieces.texts(values, ends - ends[0])], names=["doc_id", "ids", "text"])

    kind = rows.schema[id_col].dataType.simpleString()
    return arrow_map(rows.selectExpr(f"`{id_col}` as doc_id", f"cast(`{ids_col}` as array<int>) as ids"), decode,
                     f"doc_id {kind}, ids array<int>, text string")


def digest(rows: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of `decoded` rows."""
    return rows.selectExpr(
        "doc_id", "cast(size(ids) as bigint) as n_tokens", "sha2(array_join(cast(ids as array<string>), ','), 256) as ids_sha256",
        "sha2(text, 256) as decoded_sha256")
