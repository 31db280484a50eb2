"""Vectorised word handling over Arrow text columns.

``Words(array, separators)`` finds the words of every text of an Arrow string
array at once, in NumPy, on the UTF-8 bytes: no Python object per word. Words
are maximal runs of bytes that are no separator; a text boundary always ends a
word. Null and empty texts have no words. Word hashes are 64-bit tabulation
sums over (byte, position in the word), window hashes are multilinear sums over
word hashes; both are the same in every process and every run.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_U = np.uint64
SLICE_BYTES = 500_000  # texts are handled this many bytes at a time; one longer text is handled alone


def _randoms(seed: int, *shape: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**64, size=shape, dtype=np.uint64, endpoint=False)


def _class(pattern_bytes: set[int]) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(pattern_bytes)] = True
    return out


WHITE = _class({0x20, *range(0x09, 0x0E)})
NON_ALNUM = _class({*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)})
SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[0x41:0x5B] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (multiply and xor-shift rounds)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _text_buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, text boundaries) of a string array; a null is an empty text."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null("")
    kind = np.int64 if pa.types.is_large_string(arr.type) else np.int32
    n = len(arr)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = arr.buffers()
    bounds = np.frombuffer(offs, dtype=kind)[arr.offset: arr.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[bounds[0]: bounds[-1]], bounds - bounds[0]


def slices(arr: pa.Array, limit: int = SLICE_BYTES):
    """(first row, sub-array) pieces of about ``limit`` bytes of text each."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    _, bounds = _text_buffers(arr)
    lo, n = 0, len(arr)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + limit, side="right")) - 1)
        yield lo, arr.slice(lo, hi - lo)
        lo = hi


class Words:
    """Words of a batch of texts.

    doc: text index per word; starts / ends: byte range per word in ``raw``;
    first: index of the first word of each text, with the total at the end.
    """

    def __init__(self, arr: pa.Array, separators: np.ndarray = WHITE, fold: np.ndarray = SAME):
        self.raw, self.bounds = _text_buffers(arr)
        self.n_docs = len(self.bounds) - 1
        self.fold = fold
        size = len(self.raw)
        inside = ~separators[self.raw]
        begin = np.ones(size + 1, dtype=bool)
        begin[1:] = False
        begin[1:size][~inside[:-1]] = True
        begin[self.bounds] = True  # also the end of the buffer
        self.starts = np.flatnonzero(inside & begin[:-1])
        self.ends = np.empty_like(self.starts)
        if len(self.starts):
            last = np.zeros(size, dtype=bool)
            last[:-1] = ~inside[1:]
            last[-1] = True
            inner = self.bounds[(self.bounds > 0)] - 1
            last[inner] = True
            self.ends = np.flatnonzero(inside & last) + 1
        self.first = np.searchsorted(self.starts, self.bounds, side="left")
        self.first[-1] = len(self.starts)
        self.counts = np.diff(self.first)
        self.inside = inside

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs, dtype=np.int32), self.counts)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word (after folding)."""
        lens = (self.ends - self.starts).astype(np.int32)
        if not len(lens):
            return np.zeros(0, dtype=np.uint64)
        code = self.fold[self.raw[self.inside]].astype(np.int32)
        head = np.zeros(len(lens), dtype=np.int32)
        np.cumsum(lens[:-1], out=head[1:])
        pos = np.arange(len(code), dtype=np.int32) - np.repeat(head, lens)
        table = _TABLE
        longest = int(lens.max())
        value = table[(pos & 63) * 256 + code]
        if longest > 64:
            factor = _randoms(17, longest // 64 + 1) | _U(1)
            factor[0] = 1  # a word's hash does not depend on the words beside it
            value = value * factor[pos >> 6]
        return mix(np.add.reduceat(value, head) + lens.astype(np.uint64))

    def byte_counts(self, chosen: np.ndarray) -> np.ndarray:
        """Per text, the number of bytes that ``chosen`` (256 flags) marks."""
        total = np.zeros(len(self.raw) + 1, dtype=np.int32)
        np.cumsum(chosen[self.raw], out=total[1:])
        return np.diff(total[self.bounds]).astype(np.int64)


_TABLE = _randoms(11, 64 * 256)


def windows(h: np.ndarray, first: np.ndarray, size: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, is a window) for the ``size`` words from each word on; false where
    the text ends earlier."""
    n = len(h)
    good = np.zeros(n, dtype=bool)
    out = np.zeros(n, dtype=np.uint64)
    if n >= size:
        m = _randoms(seed, size) | _U(1)
        acc = h[: n - size + 1] * m[0]
        for j in range(1, size):
            acc = acc + h[j: n - size + 1 + j] * m[j]
        out[: n - size + 1] = mix(acc)
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n)
    good = left >= size
    return out, good


def covered(marked: np.ndarray, size: int) -> np.ndarray:
    """Words covered by marked windows of ``size`` words (a window never crosses texts)."""
    step = np.zeros(len(marked) + size + 1, dtype=np.int32)
    at = np.flatnonzero(marked)
    step[at] += 1
    step[at + size] -= 1
    return np.cumsum(step[: len(marked)]) > 0
