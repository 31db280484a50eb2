"""Which 64-bit fingerprints occur more than once in the whole corpus, in bounded space.

Tasks send each hash block the fingerprints they met (distinct within a flush, so a
very frequent fingerprint is sent once per flush, not once per occurrence). Each
block counts its own and answers with its part of one bitmap of fixed size and with
its most frequent fingerprints. The bitmap has a bit for every repeated fingerprint
and for some others that share a slot: a clear bit proves that a fingerprint is
unique, a set bit proves nothing. Its size does not grow with the data.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm.scratch import blocks_log2

BITS_LOG2 = 27
FLUSH = 2_000_000
_TAIL = 24  # bits of a fingerprint kept beside its block number
_U = np.uint64


def pack24(v: np.ndarray) -> bytes:
    """Sorted 24-bit numbers as three byte planes (they compress well)."""
    return np.ascontiguousarray(v.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].T).tobytes()


def unpack24(b: bytes) -> np.ndarray:
    planes = np.frombuffer(b, np.uint8).reshape(3, -1).astype(np.uint32)
    return planes[0] | planes[1] << 8 | planes[2] << 16


def by_block(block: np.ndarray, log2: int) -> Iterator[tuple[int, slice]]:
    """(block, its range) of a sorted block column."""
    at = np.searchsorted(block, np.arange((1 << log2) + 1))
    for b in np.flatnonzero(np.diff(at)):
        yield int(b), slice(at[b], at[b + 1])


class Repeats:
    """Answers for fingerprints: maybe repeated, and how often if very frequent."""

    def __init__(self, bits: np.ndarray, frequent: np.ndarray, counts: np.ndarray, log2: int):
        self.bits, self.frequent, self.counts, self.log2 = bits, frequent, counts, log2

    def shared(self, spark: SparkSession) -> Callable[[], Repeats]:
        """What a task calls to get the answers. Plain arrays are broadcast: a broadcast value
        is pickled by reference, and executors need not have this package."""
        sent = spark.sparkContext.broadcast((self.bits, self.frequent, self.counts, self.log2))
        return lambda: Repeats(*sent.value)

    def maybe(self, h: np.ndarray) -> np.ndarray:
        slot = (h >> _U(64 - BITS_LOG2)).astype(np.int64)
        return (self.bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1

    def frequency(self, h: np.ndarray) -> np.ndarray:
        """Count of the frequent fingerprints, 0 for all others."""
        if not len(self.frequent):
            return np.zeros(len(h), np.int64)
        key = h >> _U(64 - self.log2 - _TAIL)
        at = np.minimum(np.searchsorted(self.frequent, key), len(self.frequent) - 1)
        return np.where(self.frequent[at] == key, self.counts[at], 0)


def find_repeats(rows: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], frequent: int = 0,
                 least: int = 4) -> Repeats:
    """Count the fingerprints that ``hashes`` yields for the batches of ``rows``.
    frequent: how many of the most frequent ones (at least ``least`` times) to keep."""
    log2 = blocks_log2(rows.sparkSession)
    per_block = -(-frequent // (1 << log2))
    segment = BITS_LOG2 - log2

    def send(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        key, count = np.unique(np.concatenate(held) >> _U(64 - log2 - _TAIL), return_counts=True)
        block = (key >> _U(_TAIL)).astype(np.int64)
        tail = (key & _U((1 << _TAIL) - 1)).astype(np.uint32)
        out = {"block": [], "once": [], "more": [], "counts": []}
        for b, at in by_block(block, log2):
            many = count[at] > 1
            out["block"].append(b)
            out["once"].append(pack24(tail[at][~many]))
            out["more"].append(pack24(tail[at][many]))
            out["counts"].append(count[at][many].astype("<u4").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(out["block"], pa.int32()), *(pa.array(out[k], pa.binary())
                                          for k in ("once", "more", "counts"))], names=list(out))

    def collect(batches):
        held, size = [], 0
        for batch in batches:
            for h in hashes(batch):
                held.append(h)
                size += len(h)
                if size >= FLUSH:
                    yield from send(held)
                    held, size = [], 0
        yield from send(held)

    def count(table: pa.Table) -> pa.Table:
        once = [unpack24(x.as_py()) for x in table.column("once")]
        more = [unpack24(x.as_py()) for x in table.column("more")]
        n = [np.frombuffer(x.as_py(), "<u4") for x in table.column("counts")]
        tail = np.concatenate(once + more)
        weight = np.concatenate([np.ones(sum(map(len, once)), np.int64), *n]).astype(np.int64)
        order = np.argsort(tail, kind="stable")
        tail, weight = tail[order], weight[order]
        heads = np.flatnonzero(np.concatenate([[True], tail[1:] != tail[:-1]])) if len(tail) else np.zeros(0, int)
        total = np.add.reduceat(weight, heads) if len(heads) else np.zeros(0, np.int64)
        tail = tail[heads]
        repeated = total > 1
        bits = np.zeros(1 << segment, bool)
        bits[tail[repeated] >> (_TAIL - segment)] = True
        top = np.flatnonzero(total >= least)
        if len(top) > per_block:
            top = np.sort(top[np.lexsort((tail[top], -total[top]))[:per_block]])
        return pa.table({"block": table.column("block")[:1],
                         "bits": pa.array([zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)]),
                         "tails": pa.array([tail[top].astype("<u4").tobytes()]),
                         "counts": pa.array([total[top].astype("<u4").tobytes()])})

    sent = rows.mapInArrow(collect, "block int, once binary, more binary, counts binary")
    got = sent.groupBy("block").applyInArrow(count, "block int, bits binary, tails binary, counts binary").collect()
    bits = np.zeros((1 << BITS_LOG2) // 8, np.uint8)
    step = (1 << segment) // 8
    keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for r in sorted(got, key=lambda r: r["block"]):
        bits[r["block"] * step:(r["block"] + 1) * step] = np.frombuffer(zlib.decompress(r["bits"]), np.uint8)
        keys.append(np.frombuffer(r["tails"], "<u4").astype(np.uint64) | _U(r["block"]) << _U(_TAIL))
        counts.append(np.frombuffer(r["counts"], "<u4").astype(np.int64))
    return Repeats(bits, np.concatenate(keys), np.concatenate(counts), log2)
