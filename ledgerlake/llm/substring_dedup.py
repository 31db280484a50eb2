"""Operator 3: substring deduplication over difference-cover anchors.

A window is 20 consecutive words; a word goes if it lies in a window whose words
also start earlier in the corpus (a smaller doc_id, or earlier in the same text).

Anchors are the hashes of 8 consecutive words at positions whose remainder modulo
13 is in the difference cover {0, 1, 3, 9}: for any two positions some shift below
13 brings both to cover positions, so two equal windows of 20 words always share an
anchor at the same shift. Only anchors are counted over the whole corpus (about 0.3
per word). A repeated anchor is then extended: the 20-word windows around it are hashed,
and those whose hash occurs once (a second bitmap) go. Of the rest (96-bit hashes) the first occurrence of each window is found by a shuffle on
that hash. Tasks send one occurrence of a window per flush, the earliest; the
others of the flush are known to be repeats, so a passage that a third of all
documents share costs one row per flush, never a group of all its copies.

Defined results: null or empty texts have no words and keep an empty text. Null
doc_ids come after all others. Rows that share a doc_id are one document for the
order: of windows that start at the same place of the same doc_id none is earlier,
so a repeated row does not remove its own copy. Results go back by doc_id and text,
so rows that share a doc_id but not a text stay apart. Other columns pass on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.repeats import Repeats, by_block, find_repeats
from ledgerlake.llm.scratch import blocks_log2
from ledgerlake.llm.words import Words, covered, slices, windows

WINDOW = 20
PERIOD = 13
COVER = (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
FLUSH = 1_000_000
_LAST = np.iinfo(np.int64).max
_U = np.uint64


def _anchors(w: Words, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, is an anchor) at each word."""
    code, good = windows(h, w.first, ANCHOR, seed=8)
    place = np.arange(len(h)) - np.repeat(w.first[:-1], w.counts)
    cover = np.zeros(PERIOD, dtype=bool)
    cover[list(COVER)] = True
    return code, good & cover[place % PERIOD] & np.repeat(w.counts >= WINDOW, w.counts)


def _anchor_hashes(batch: pa.RecordBatch):
    for _, piece in slices(batch.column("text")):
        w = Words(piece)
        code, at = _anchors(w, w.hashes())
        yield code[at]


def _extend(w: Words, h: np.ndarray, anchors: Repeats) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of the windows that hold an anchor which may be repeated."""
    code, at = _anchors(w, h)
    flags = np.zeros(len(h), dtype=bool)
    flags[at] = anchors.maybe(code[at])
    hot = np.zeros(len(h) + 1, dtype=np.int32)
    np.cumsum(flags, out=hot[1:])
    if not hot[-1]:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    code, good = windows(h, w.first, WINDOW, seed=20)
    ends = np.minimum(np.arange(len(h)) + PERIOD, len(h))
    pick = np.flatnonzero(good & (hot[ends] > hot[:-1]))
    return pick, code[pick]


def _groups(*keys: np.ndarray) -> np.ndarray:
    """Flags of the rows that begin a new group in sorted columns."""
    new = np.ones(len(keys[0]), dtype=bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


_WINDOW = np.dtype([("h", "<u8"), ("g", "<u4"), ("id", "<i8"), ("t", "<i4"), ("at", "<i4")])
_MARK = np.dtype([("id", "<i8"), ("t", "<i4"), ("at", "<i4")])


def _planes(rows: np.ndarray) -> bytes:
    """Rows as byte planes, first bytes of all rows first: equal high bytes compress."""
    return np.ascontiguousarray(rows.view(np.uint8).reshape(len(rows), -1).T).tobytes()


def _rows(planes: bytes, kind: np.dtype) -> np.ndarray:
    flat = np.frombuffer(planes, np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(flat.T).reshape(-1).view(kind)


def _sorted_windows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows by window, then place; flags of the first place of each window, one row per text; flags of repeats)."""
    rows = rows[np.lexsort((rows["t"], rows["at"], rows["id"], rows["g"], rows["h"]))]
    new = _groups(rows["h"], rows["g"])
    head = np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))
    again = (rows["id"] != rows["id"][head]) | (rows["at"] != rows["at"][head])
    first = ~again
    first[1:] &= new[1:] | (rows["t"][1:] != rows["t"][:-1])
    return rows, first, again


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(id, t, starts): per document (id: doc_id, the largest long for null; t: hash of
    the text) the starts of windows that occur earlier, as 32-bit numbers."""
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(int(_LAST))).alias("id"), F.hash("text").alias("t"),
                        "text")
    spark = docs.sparkSession
    anchors = find_repeats(texts.select("text"), _anchor_hashes).shared(spark)

    def window_hashes(batch: pa.RecordBatch):
        for _, piece in slices(batch.column("text")):
            w = Words(piece)
            yield _extend(w, w.hashes(), anchors())[1]

    known = find_repeats(texts.select("text"), window_hashes).shared(spark)
    log2 = blocks_log2(spark)
    doc_log2 = max(4, log2 - 2)

    def marks(rows: np.ndarray):
        """(kind 1, document block, marks) batches."""
        if not len(rows):
            return
        block = (rows["id"].astype(np.uint64) * _U(0x9E3779B97F4A7C15)) >> _U(64 - doc_log2)
        order = np.lexsort((rows["at"], rows["t"], rows["id"], block))
        flat = np.empty(len(rows), dtype=_MARK)
        for name in _MARK.names:
            flat[name] = rows[name][order]
        got = list(by_block(block[order].astype(np.int64), doc_log2))
        yield pa.RecordBatch.from_pydict({"kind": pa.array([1] * len(got), pa.int32()),
                                          "block": pa.array([b for b, _ in got], pa.int32()),
                                          "data": pa.array([_planes(flat[s]) for _, s in got])})

    def send(held: list[np.ndarray]):
        if not held:
            return
        rows, first, again = _sorted_windows(np.concatenate(held))
        first = rows[first]  # texts that share a doc_id share its places
        block = (first["h"] >> _U(64 - log2)).astype(np.int64)
        got = list(by_block(block, log2))
        if got:
            yield pa.RecordBatch.from_pydict({"kind": pa.array([0] * len(got), pa.int32()),
                                              "block": pa.array([b for b, _ in got], pa.int32()),
                                              "data": pa.array([_planes(first[s]) for _, s in got])})
        yield from marks(rows[again])

    def candidate_windows(batches):
        held, size = [], 0
        first_filter, second_filter = anchors(), known()
        for batch in batches:
            ids, tags = batch.column("id").to_numpy(), batch.column("t").to_numpy()
            for lo, piece in slices(batch.column("text")):
                w = Words(piece)
                h = w.hashes()
                pick, h1 = _extend(w, h, first_filter)
                again = second_filter.maybe(h1)
                pick, h1 = pick[again], h1[again]
                if not len(pick):
                    continue
                h2, _ = windows(h, w.first, WINDOW, seed=21)
                doc = w.doc[pick]
                rows = np.empty(len(pick), dtype=_WINDOW)
                rows["h"], rows["g"] = h1, h2[pick] >> _U(32)
                rows["id"], rows["t"] = ids[lo + doc], tags[lo + doc]
                rows["at"] = pick - w.first[doc]
                held.append(rows)
                size += len(rows)
                if size >= FLUSH:
                    yield from send(held)
                    held, size = [], 0
        yield from send(held)

    def decide(table: pa.Table) -> pa.Table:
        """A window block gives the marks of repeats; a mark block passes on."""
        if table.column("kind")[0].as_py() == 1:
            return table
        rows = np.concatenate([_rows(x.as_py(), _WINDOW) for x in table.column("data")])
        rows, _, again = _sorted_windows(rows)
        out = list(marks(rows[again]))
        return pa.Table.from_batches(out) if out else table.slice(0, 0)

    def per_document(table: pa.Table) -> pa.Table:
        rows = np.concatenate([_rows(x.as_py(), _MARK) for x in table.column("data")])
        rows = rows[np.lexsort((rows["at"], rows["t"], rows["id"]))]
        head = np.flatnonzero(_groups(rows["id"], rows["t"]))
        ends = np.append(head[1:], len(rows))
        return pa.table({"id": pa.array(rows["id"][head]), "t": pa.array(rows["t"][head]),
                         "starts": pa.array([np.unique(rows["at"][a:b]).astype("<i4").tobytes()
                                             for a, b in zip(head, ends, strict=True)], pa.binary())})

    schema = "kind int, block int, data binary"
    sent = texts.mapInArrow(candidate_windows, schema)
    decided = sent.groupBy("kind", "block").applyInArrow(decide, schema)
    return decided.groupBy("block").applyInArrow(per_document, "id long, t int, starts binary")


@F.arrow_udf(T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("kept_text", T.StringType())]))
def _strip(text: pa.Array, starts: pa.Array) -> pa.Array:
    n, gone, kept = [], [], []
    for t, s in zip(text, starts, strict=True):
        words = (t.as_py() or "").encode().split()  # splits at exactly the six blank bytes
        n.append(len(words))
        s = s.as_py()
        if s:
            marked = np.zeros(len(words), dtype=bool)
            marked[np.frombuffer(s, "<i4")] = True
            out = covered(marked, WINDOW)
            gone.append(int(out.sum()))
            words = [w for w, o in zip(words, out.tolist(), strict=True) if not o]
        else:
            gone.append(0)
        kept.append(b" ".join(words))
    return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                                       pa.array(kept, pa.binary()).cast(pa.string())],
                                      names=["n_words", "n_removed", "kept_text"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, n_removed and kept_text (the kept words, joined by one space)."""
    marks = repeated_windows(docs).withColumnsRenamed({"id": "_id", "t": "_t", "starts": "_starts"})
    keyed = docs.drop("_starts", "_out").withColumns({"_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(int(_LAST))), "_t": F.hash("text")})
    out = keyed.join(marks, ["_id", "_t"], "left").withColumn("_out", _strip("text", "_starts"))
    return (out.withColumns({c: F.col(f"_out.{c}") for c in ("n_words", "n_removed", "kept_text")})
            .drop("_id", "_t", "_starts", "_out"))
