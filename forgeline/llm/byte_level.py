"""Ids of chunks by a byte-level BPE file of the tokenizers library.

In a file that `byte_level_cuts` accepts, a chunk of a space and letters is one pre-token, so the BPE model alone is asked; marks behind
letters are a pre-token of their own. All other chunks, and all texts of other files, go through the whole tokenizer.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from forgeline.llm.chunks import byte_level_cuts, stacked

MOST_VOCABULARY_BYTES = 32_000_000
#: A run of these after letters, before a space or the end, is a pre-token of its own.
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: The byte-level alphabet: bytes that print stand for themselves, the others for code points from 256 on.
_PRINTING = {*range(33, 127), *range(161, 173), *range(174, 256)}
ALPHABET = {b: b if b in _PRINTING else 256 + sum(x not in _PRINTING for x in range(b)) for b in range(256)}
#: Letters below this (Latin, Greek, Cyrillic) are letters in every version of Unicode in use.
_SETTLED = "Ԁ"


def vocabulary_path() -> str:
    """Where the public byte-level vocabulary lies."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def vocabulary_text(path: str | None = None) -> str:
    """A vocabulary file, small enough to be sent to every worker."""
    path = path or vocabulary_path()
    size = os.path.getsize(path)
    if size > MOST_VOCABULARY_BYTES:
        raise ValueError(f"{path} has {size} bytes; {MOST_VOCABULARY_BYTES} may be sent to every worker")
    with open(path, encoding="utf-8") as f:
        return f.read()


class ByteLevel:
    """Ids of chunks; with `plain_special` the strings of special tokens are ordinary text."""

    def __init__(self, vocabulary: str, plain_special: bool = False):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.cut = byte_level_cuts(vocabulary)
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.encode_special_tokens = plain_special
        # letters and marks behind them never hold a special token that begins with a mark and has another character
        self.letters = self.cut and all(
            t.content[0] in _MARKS and t.content.strip(_MARKS) for t in self.tokenizer.get_added_tokens_decoder().values())

    def _whole(self, chunks: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    def ids(self, chunks: list[str]) -> list[list[int]]:
        if not self.letters:
            return self._whole(chunks)
        tokenize, marks, out, other = self.tokenizer.model.tokenize, {}, [], []
        for i, chunk in enumerate(chunks):
            stem = chunk.rstrip(_MARKS)
            if stem[:1] == " " and stem[1:].isalpha() and (stem.isascii() or max(stem) < _SETTLED):
                mapped = "Ġ" + stem[1:] if stem.isascii() else stem.encode().decode("latin-1").translate(ALPHABET)
                found = [t.id for t in tokenize(mapped)]
                tail = chunk[len(stem):]
                if tail:
                    if tail not in marks:
                        marks[tail] = self._whole([tail])[0]
                    found += marks[tail]
                out.append(found)
            else:
                other.append(i)
                out.append(None)
        for at in range(0, len(other), 10_000):
            some = other[at:at + 10_000]
            for i, found in zip(some, self._whole([chunks[i] for i in some])):
                out[i] = found
        return out

    def token_bytes(self) -> list[bytes]:
        """The bytes of each id (special tokens: of their string)."""
        back = {chr(c): b for b, c in ALPHABET.items()}
        out = [b""] * self.tokenizer.get_vocab_size(with_added_tokens=True)
        added = self.tokenizer.get_added_tokens_decoder()
        for piece, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            out[i] = piece.encode() if i in added or any(c not in back for c in piece) else bytes(back[c] for c in piece)
        return out


_encoders: dict[tuple, ByteLevel] = {}


def byte_level(vocabulary: str, plain_special: bool = False) -> ByteLevel:
    """One encoder of a kind in a worker process."""
    key = (hash(vocabulary), len(vocabulary), plain_special)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = ByteLevel(vocabulary, plain_special)
    return _encoders[key]


def id_rows(lists: list[list[int]]) -> pa.RecordBatch:
    """Lists of ids as the one column `ids`."""
    values, ends = stacked(lists, np.int32)
    return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))], names=["ids"])
