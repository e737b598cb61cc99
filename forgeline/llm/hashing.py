"""Vectorised hashes of the words of many texts at once (numpy inside a task)."""

from __future__ import annotations

import numpy as np

U64 = np.uint64

#: A-Z to a-z; 0-9, a-z and all bytes of non-ASCII characters belong to words, the rest parts them.
ALNUM = np.array([b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 0
                  for b in range(256)], np.uint8)
#: Every byte but white space belongs to words, case and symbols kept.
SPACED = np.array([0 if b in (0, 32) or 9 <= b <= 13 else b for b in range(256)], np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (two multiply-xorshift steps)."""
    x = (x ^ (x >> U64(31))) * U64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U64(29))) * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * U64(0x632BE59BD9B4E019))
_BASE = 0x5851F42D4C957F2D
_BASE_INVERSE = pow(_BASE, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_spans(folded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of non-zero bytes; the last byte is zero."""
    inside = folded != 0
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside.size and inside[0]:
        edge = np.concatenate([[0], edge])
    return edge[0::2], edge[1::2]


def joined(texts: list[bytes]) -> tuple[bytes, np.ndarray]:
    """All texts with a parting byte after each, and where each ends in it."""
    return b"\0".join(texts) + b"\0", np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))


class WordHasher:
    """Polynomial hashes by running sums: any part of a word costs one subtraction.

    Sums run over blocks of about `block` bytes (longer if one word is), so memory follows the block, not the text.
    """

    block = 1 << 18

    def __init__(self, fold: np.ndarray = ALNUM):
        self.fold = fold
        self.up, self.down = _powers(_BASE, self.block), _powers(_BASE_INVERSE, self.block)

    def parts(self, buffer: bytes, prefixes: tuple[int, ...] = (), suffixes: tuple[int, ...] = ()
              ) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Starts and ends of words, and hashes: the word, then its first and last n bytes (the word if shorter)."""
        folded = self.fold[np.frombuffer(buffer, np.uint8)]
        starts, ends = word_spans(folded)
        out = [np.empty(len(starts), np.uint64) for _ in range(1 + len(prefixes) + len(suffixes))]
        at = 0
        while at < len(starts):
            base = starts[at]
            to = max(at + 1, int(np.searchsorted(ends, base + self.block - 1)))
            span = int(ends[to - 1] - base)
            if span >= len(self.up):
                self.up, self.down = _powers(_BASE, span + 1), _powers(_BASE_INVERSE, span + 1)
            sums = np.zeros(span + 1, np.uint64)
            np.cumsum(_BYTE[folded[base:base + span]] * self.up[:span], out=sums[1:])
            s, e = starts[at:to] - base, ends[at:to] - base
            ranges = [(s, e), *((s, np.minimum(e, s + n)) for n in prefixes), *((np.maximum(s, e - n), e) for n in suffixes)]
            for kind, (a, b) in enumerate(ranges):
                out[kind][at:to] = mix((sums[b] - sums[a]) * self.down[a] + U64(kind))
            at = to
        return starts, ends, out

    def hashes(self, buffer: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(start, hash) of each word; the buffer ends with a byte that is in no word."""
        starts, _, out = self.parts(buffer)
        return starts, out[0]
