"""Words of whole texts as Arrow arrays, found in their UTF-8 bytes.

Every separator of the operators' rules is an ASCII byte, and no byte of a
longer UTF-8 sequence is one, so texts are split byte by byte with numpy: no
string object per word.  A slice holds a bounded number of bytes; a text
longer than that goes through several slices, cut between two words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard

SLICE_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Slice(NamedTuple):
    words: pa.Array       # lower-cased (A-Z only), in order
    row: np.ndarray       # the row of each word within the batch
    gap: np.ndarray       # a break, or the start of the text, is right before the word
    first: int            # rows first..last of the batch are in this slice
    last: int
    goes_on: bool         # the first row began in an earlier slice
    ends: bool            # the last row ends in this slice


class Splitter:
    """Splits texts into words: runs of bytes that are neither ``spaces`` nor
    ``breaks``; a break also ends a piece."""

    def __init__(self, spaces: bytes, breaks: bytes = b"", slice_bytes: int = SLICE_BYTES):
        self.word = np.ones(256, bool)
        self.word[list(spaces + breaks)] = False
        self.breaks = np.zeros(256, bool)
        self.breaks[list(breaks)] = True
        self.slice_bytes = slice_bytes

    def slices(self, texts: pa.Array) -> Iterator[Slice]:
        """The words of all rows (nulls count as empty), in order; every row is in a slice."""
        off, data = _raw(texts)
        i, n = 0, len(texts)
        while i < n:
            j = int(np.searchsorted(off, off[i] + self.slice_bytes, side="right")) - 1
            if j > i:
                yield self._cut(data, off[i : j + 1], i, False, True)
                i = j
                continue
            at, end = int(off[i]), int(off[i + 1])
            while at < end:
                stop = self._word_end(data, min(at + self.slice_bytes, end), end)
                yield self._cut(data, np.array([at, stop]), i, at > int(off[i]), stop == end)
                at = stop
            i += 1

    def _word_end(self, data: np.ndarray, at: int, end: int) -> int:
        while at < end:
            other = np.flatnonzero(~self.word[data[at : min(at + 65536, end)]])
            if len(other):
                return at + int(other[0])
            at = min(at + 65536, end)
        return end

    def _cut(self, data: np.ndarray, off: np.ndarray, row: int, goes_on: bool, ends: bool) -> Slice:
        raw = data[off[0] : off[-1]]
        at = off - off[0]
        inside = self.word[raw]
        start = inside.copy()
        start[1:] &= ~inside[:-1]
        heads = at[:-1][np.diff(at) > 0]
        start[heads] = inside[heads]  # texts lie side by side
        starts = np.flatnonzero(start)
        kept = _LOWER[raw[inside]]
        stops = np.append(np.flatnonzero(start[inside]), len(kept)).astype(np.int32)
        words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(stops), pa.py_buffer(kept))
        place = np.searchsorted(at, starts, side="right") - 1
        gap = np.ones(len(starts), bool)
        if len(starts):
            seen = np.cumsum(self.breaks[raw], dtype=np.int32)[starts]
            gap[1:] = (seen[1:] != seen[:-1]) | (place[1:] != place[:-1])
            gap[0] = not goes_on or seen[0] > 0
        return Slice(words, place + row, gap, row, row + len(at) - 2, goes_on, ends)


def _raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    _, off, data = texts.buffers()
    if off is None or not len(texts):
        return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.uint8)
    off = np.frombuffer(off, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return off, np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)


def pack(*arrays: np.ndarray) -> bytes:
    """Integer arrays as compressed bytes: equal bytes of all numbers lie together."""
    out = [np.array([len(arrays)] + [x for a in arrays for x in (len(a), a.dtype.itemsize)], np.int64).tobytes()]
    for a in arrays:
        out.append(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes())
    return zstandard.compress(b"".join(out), 3)


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    n = int(raw[:8].view(np.int64)[0])
    head, at, out = raw[8 : 8 + 16 * n].view(np.int64), 8 + 16 * n, []
    for size, width in head.reshape(n, 2):
        planes = raw[at : at + size * width].reshape(width, size)
        out.append(np.ascontiguousarray(planes.T).view(f"<i{width}").reshape(size))
        at += size * width
    return out


def narrow(a: np.ndarray) -> np.ndarray:
    """The same non-negative numbers in 4 bytes each, where they fit."""
    return a.astype(np.int32) if not len(a) or int(a.max()) < 1 << 31 else a.astype(np.int64)


def pack_words(words: pa.Array) -> bytes:
    """A string array without nulls as compressed bytes."""
    off, data = _raw(words)
    return pack(np.diff(off).astype(np.int32), data[off[0]:off[-1]].view(np.int8))


def unpack_words(blob: bytes) -> pa.Array:
    size, data = unpack(blob)
    off = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(off), pa.py_buffer(data))
