"""Vectorised word and shingle hashing over whole Arrow text columns.

All helpers work on a chunk of rows at a time (`text_chunks`): the UTF-8
bytes of the rows lie behind each other in one numpy buffer, so words,
word hashes and shingle hashes of a chunk come from a few array passes.
A chunk holds about ``CHUNK_BYTES`` of text, or one longer row on its own;
temporary memory is proportional to the chunk, never to the partition.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D, which for
UTF-8 equals the code-point pattern ``[^\\x20\\x09-\\x0D]+``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_BASE_INV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bytes, about, that are hashed at a time.
_HASHED = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift-multiply); a bijection."""
    out = x >> _U(30)
    out ^= x
    out *= _U(0xBF58476D1CE4E5B9)
    out ^= out >> _U(27)
    out *= _U(0x94D049BB133111EB)
    out ^= out >> _U(31)
    return out


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


def span_hashes(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of ``codes``: the sum of a finaliser over (code,
    place in the span), finalised with the length.  No two contents collide by
    their structure, as they do with powers of a base modulo 2**64."""
    size = end - start
    upto = np.cumsum(size)
    out, i = np.zeros(len(size), dtype=np.uint64), 0
    while i < len(size):
        done = upto[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(upto, done + _HASHED, side="right")))
        own = size[i:j]
        place = np.arange(upto[j - 1] - done) - np.repeat(upto[i:j] - own - done, own)
        at = np.repeat(start[i:j], own) + place
        sums = np.zeros(len(at) + 1, dtype=np.uint64)
        np.cumsum(mix(codes[at] + place.astype(np.uint64) * _BASE), out=sums[1:])
        out[i:j] = sums[upto[i:j] - done] - sums[upto[i:j] - own - done]
        i = j
    return mix(out ^ (size.astype(np.uint64) * _U(0xD6E8FEB86659FD93)))


class _Powers:
    """Powers of the hash base and of its inverse, grown on demand; for windows
    of a few dozen codes only, as long spans can collide by their structure."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n + 1:
            size = max(n + 1, CHUNK_BYTES + 1)
            for name, base in (("up", _BASE), ("down", _BASE_INV)):
                a = np.full(size, base, dtype=np.uint64)
                a[0] = 1
                setattr(self, name, np.multiply.accumulate(a))
        return self.up, self.down


_POWERS = _Powers()


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null rows have length 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if n == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offs, data = column.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(offs, dtype=kind)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of pieces of about ``limit`` bytes."""
    data, offsets = text_buffers(column)
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


@dataclass
class Words:
    """Words of a chunk: byte span, row number and 64-bit hash of each."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # index of each row's first word, and the total at the end


def _spans(offsets: np.ndarray, solid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the runs of solid bytes; a run ends with its row."""
    n = len(solid)
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:n]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | edge[1:n]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def _span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return span_hashes(_BYTE[data], start, end)


def segment_hashes(data: np.ndarray, offsets: np.ndarray, solid: np.ndarray,
                   breaks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the runs of solid bytes; a run also ends before each of
    the bytes ``breaks``."""
    start, end = _spans(offsets if breaks is None else np.concatenate([offsets, breaks]), solid)
    row = np.searchsorted(offsets, start, side="right") - 1
    return _span_hashes(data, start, end), row


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    if lower:
        data = _LOWER[data]
    start, end = _spans(offsets, ~_SPACE[data])
    first = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(start, end, row, _span_hashes(data, start, end), first)


def _step(k: int) -> np.uint64:
    return _U(k * int(_BASE) % (1 << 64))


def combine(hashes: np.ndarray, width: int) -> np.ndarray:
    """Order-sensitive hash of each window of ``width`` successive hashes."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = hashes[:n].copy()
    for k in range(1, width):
        out = mix(out + _step(k)) + hashes[k:k + n]
    return mix(out + _step(width))


def shingle_sets(words: Words, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of every row of the chunk.

    A row with fewer than ``width`` words has its whole sequence as its one
    shingle; a row without words has none.
    """
    windows = combine(words.hash, width)
    for lo, hi in zip(words.first[:-1], words.first[1:], strict=True):
        if hi - lo >= width:
            yield np.unique(windows[lo:hi - width + 1])
        elif hi > lo:
            yield combine(words.hash[lo:hi], int(hi - lo))
        else:
            yield np.zeros(0, dtype=np.uint64)
