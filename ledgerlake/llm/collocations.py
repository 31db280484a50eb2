"""Operator 13: phrase collocations by mergeable Misra-Gries summaries.

Per language, phrases of 2 to 5 words that occur ``LEAST`` times or more inside pieces of text are scored by their
weakest cut: 1000 * a * n / (l * r), with a, l, r the counts of the phrase and of the cut's two parts, n all words.

First pass: every window of 1 to 5 words is a 64-bit hash of (language, words); its leading bits name a hash partition.
Tasks send each partition summaries of their windows (hash, count). A partition merges them as Misra-Gries summaries:
beyond the capacity, the count of rank capacity + 1 is taken from all, and what falls to 0 goes. The capacity exceeds the
partition's mass / LEAST, so all that was ever taken from one hash stays below LEAST, and every hash whose count plus
what was taken can reach LEAST survives: a superset of the frequent phrases, never less (hashes that meet only add up).
The number of partitions follows the bytes of the corpus, so a partition's mass does not grow with it.

Second pass: the survivors' bits, at most ``FILTER_BITS`` at a time (more survivors: more rounds over the texts), go to
the tasks, which count the phrases that pass per flush and send text and count; Spark sums them exactly by text. Scores,
cuts and the drop of phrases that lie in a longer one with the same count are joins on those counts.

A common phrase costs one row per flush and partition, not one per occurrence; its own partition grows by that only.

Defined results: null or empty texts have no words, a null language is ``und``. Text is compared by bytes after A-Z are
lower-cased. Rows of one doc_id, repeated or not, all count. Arithmetic is decimal(38). An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.repeats import by_block, pack24, unpack24
from ledgerlake.llm.scratch import stored
from ledgerlake.llm.words import LOWER, Words, _class, mix, slices, windows

LONGEST = 5
LEAST = 100
TOP = 2000
FLUSH = 3_000_000  # windows that a task summarises at a time
PARTITION_BYTES = 4 << 20  # bytes of text for each hash partition
FILTER_BITS = 1 << 28  # bits of the survivors' filter that a round sends to the tasks (32 MB)
MERGE = 2_000_000  # summary entries merged at a time
TAIL = 24  # bits of a hash that a summary keeps beside its partition
BREAKS = _class({ord(c) for c in ".,;:!?"} | set(range(0x0A, 0x0E)))
APART = BREAKS | _class({0x20, 0x09})
_U = np.uint64


def _languages(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    """(code per row, languages) of a batch."""
    names = [x if x is not None else "und" for x in column.to_pylist()]
    known = sorted(set(names))
    at = {x: i for i, x in enumerate(known)}
    return np.array([at[x] for x in names], np.int64), known


def _seed(language: str) -> int:
    raw = language.encode()
    return zlib.crc32(raw) << 32 | zlib.crc32(raw[::-1] + b"\x01")


def _windows(batch: pa.RecordBatch) -> Iterator[tuple[Words, np.ndarray, np.ndarray, list[str], np.ndarray]]:
    """(words, language code per word, first word of each piece, languages, word hashes) for slices of a batch."""
    texts, langs = batch.column("text"), batch.column("lang")
    for lo, part in slices(texts):
        w = Words(part, APART, LOWER)
        code, names = _languages(langs.slice(lo, len(part)))
        n = len(w.starts)
        breaks = np.zeros(len(w.raw) + 1, np.int32)
        np.cumsum(BREAKS[w.raw], out=breaks[1:])
        piece = breaks[w.starts]
        new = np.ones(n, bool)
        new[1:] = piece[1:] != piece[:-1]
        new[w.first[:-1][w.counts > 0]] = True
        first = np.append(np.flatnonzero(new), n)
        yield w, code[w.doc], first, names, w.hashes()


def _keys(h: np.ndarray, first: np.ndarray, size: int, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of language and words, starts) of the windows of ``size`` words."""
    code, good = windows(h, first, size, seed=40 + size)
    at = np.flatnonzero(good)
    return mix(code[at] ^ salt[at]), at


def _salt(lang: np.ndarray, names: list[str]) -> np.ndarray:
    return np.array([_seed(x) for x in names], np.uint64)[lang] if names else np.zeros(0, np.uint64)


def _merge(held: tuple[np.ndarray, np.ndarray], keys: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(keys, counts, count taken from each) of two summaries merged and cut to ``capacity``."""
    keys, counts = np.concatenate([held[0], keys]), np.concatenate([held[1], counts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    counts = np.add.reduceat(counts, heads) if len(heads) else counts
    keys, taken = keys[heads], 0
    if len(keys) > capacity:
        taken = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
        stay = counts > taken
        keys, counts = keys[stay], counts[stay] - taken
    return keys, counts, taken


def survivors(docs: DataFrame, log2: int, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """block, n, tails: the hashes (block and next ``TAIL`` bits) that may occur ``least`` times or more."""
    def send(held):
        key, count = np.unique(np.concatenate(held) >> _U(64 - log2 - TAIL), return_counts=True)
        block, tail = (key >> _U(TAIL)).astype(np.int64), (key & _U((1 << TAIL) - 1)).astype(np.uint32)
        out = {"block": [], "once": [], "more": [], "counts": []}
        for b, at in by_block(block, log2):
            many = count[at] > 1
            out["block"].append(b)
            out["once"].append(pack24(tail[at][~many]))
            out["more"].append(pack24(tail[at][many]))
            out["counts"].append(count[at][many].astype("<u4").tobytes())
        return pa.RecordBatch.from_arrays([pa.array(out["block"], pa.int32()), *(pa.array(out[k], pa.binary())
                                           for k in ("once", "more", "counts"))], names=list(out))

    def summarise(batches):
        held, size = [], 0
        for batch in batches:
            for _, lang, first, names, h in _windows(batch):
                salt = _salt(lang, names)
                for m in range(1, longest + 1):
                    held.append(_keys(h, first, m, salt)[0])
                    size += len(held[-1])
                if size >= FLUSH:
                    yield send(held)
                    held, size = [], 0
        if size:
            yield send(held)

    def misra_gries(table: pa.Table) -> pa.Table:
        rows = []
        for once, more, n in zip(*(table.column(c) for c in ("once", "more", "counts"))):
            a, b, n = unpack24(once.as_py()), unpack24(more.as_py()), np.frombuffer(n.as_py(), "<u4").astype(np.int64)
            rows.append((np.concatenate([a, b]), np.concatenate([np.ones(len(a), np.int64), n])))
        mass = sum(int(c.sum()) for _, c in rows)
        capacity = mass // least + 1
        held, taken, lo = (np.zeros(0, np.uint32), np.zeros(0, np.int64)), 0, 0
        while lo < len(rows):
            hi, size = lo, 0
            while hi < len(rows) and (hi == lo or size + len(rows[hi][0]) <= MERGE):
                size += len(rows[hi][0])
                hi += 1
            keys, counts, cut = _merge(held, np.concatenate([k for k, _ in rows[lo:hi]]),
                                       np.concatenate([c for _, c in rows[lo:hi]]), capacity)
            held, taken, lo = (keys, counts), taken + cut, hi
        tails = held[0][held[1] + taken >= least]
        return pa.table({"block": table.column("block")[:1], "n": pa.array([len(tails)], pa.int64()),
                         "tails": pa.array([tails.astype("<u4").tobytes()], pa.binary())})

    sent = docs.select("lang", "text").mapInArrow(summarise, "block int, once binary, more binary, counts binary")
    return sent.groupBy("block").applyInArrow(misra_gries, "block int, n long, tails binary")


def _phrases(w: Words, starts: np.ndarray, size: int) -> pa.Array:
    """The words of windows, lower-cased and joined by one space."""
    words = (starts[:, None] + np.arange(size)).ravel()
    lens = (w.ends[words] - w.starts[words] + 1).astype(np.int64)  # with a space
    lens[size - 1::size] -= 1
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    source = np.arange(total) + np.repeat(w.starts[words] - (ends - lens), lens)
    out = w.fold[w.raw[np.minimum(source, max(len(w.raw) - 1, 0))]] if total else np.zeros(0, np.uint8)
    spaces = np.ones(len(lens), bool)
    spaces[size - 1::size] = False
    out[ends[spaces] - 1] = 0x20
    bounds = np.concatenate([[0], ends[size - 1::size]]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds.tobytes()), pa.py_buffer(out.tobytes())).cast(pa.string())


def count_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f: the phrases of 1 to ``longest`` words that occur ``least`` times or more;
    lang, n: all words)."""
    spark = docs.sparkSession
    docs = docs.select("lang", "text")
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    log2 = min(30, max(4, math.ceil(math.log2(total / PARTITION_BYTES + 1))))
    kept = stored(survivors(docs, log2, least, longest), "survivors")
    found = kept.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits = min(log2 + TAIL, max(log2, (16 * found).bit_length()))  # at least 16 bits for each survivor
    rounds = max(0, bits - int(math.log2(FILTER_BITS)))  # log2
    counted = None
    for r in range(1 << rounds):
        counts = _count_round(docs, kept, log2, bits, rounds, r, longest)
        counted = counts if counted is None else counted.unionByName(counts)
    counted = stored(counted.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f"))
                     .filter((F.col("f") >= least) | (F.col("size") == 0)), "phrases")
    return counted.filter("size > 0"), counted.filter("size = 0").select("lang", F.col("f").alias("n"))


def _count_round(docs: DataFrame, kept: DataFrame, log2: int, bits: int, rounds: int, r: int, longest: int) -> DataFrame:
    """Exact counts per flush of the phrases whose hash begins with the ``rounds`` bits r and survived."""
    spark = docs.sparkSession
    step = bits - log2  # bits of a block's part of the filter, log2
    lo, hi = r << (log2 - rounds), (r + 1) << (log2 - rounds)

    def flags(batches):
        for batch in batches:
            for b, tails in zip(batch.column("block").to_pylist(), batch.column("tails")):
                part = np.zeros(1 << step, bool)
                part[np.frombuffer(tails.as_py(), "<u4") >> (TAIL - step)] = True
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([np.packbits(part, bitorder="little").tobytes()], pa.binary())],
                                                 names=["block", "bits"])

    field = np.zeros(1 << (bits - rounds), bool) if step < 3 else np.zeros((1 << (bits - rounds)) // 8, np.uint8)
    for row in kept.filter(F.col("block").between(lo, hi - 1)).mapInArrow(flags, "block int, bits binary").toLocalIterator():
        part, b = np.frombuffer(bytes(row["bits"]), np.uint8), row["block"] - lo
        if step < 3:
            field[b << step:(b + 1) << step] = np.unpackbits(part, bitorder="little")[:1 << step]
        else:
            field[(b << step) // 8:((b + 1) << step) // 8] = part
    sent = spark.sparkContext.broadcast(np.packbits(field, bitorder="little") if step < 3 else field)

    def count(batches):
        known = sent.value
        held, size = [], 0
        words: dict[str, int] = {}

        def total(held):
            t = pa.Table.from_batches(held)
            t = t.group_by(["lang", "phrase", "size"], use_threads=False).aggregate([("f", "sum")])
            return t.select(["lang", "phrase", "size", "f_sum"]).rename_columns(["lang", "phrase", "size", "f"]).combine_chunks().to_batches()

        for batch in batches:
            for w, lang, first, names, h in _windows(batch):
                salt = _salt(lang, names)
                if r == 0:
                    for code, n in zip(*np.unique(lang, return_counts=True)):
                        words[names[code]] = words.get(names[code], 0) + int(n)
                for m in range(1, longest + 1):
                    key, at = _keys(h, first, m, salt)
                    slot = key >> _U(64 - bits)
                    if rounds:
                        here = (slot >> _U(bits - rounds)) == _U(r)
                        key, at, slot = key[here], at[here], slot[here]
                        slot = slot & _U((1 << (bits - rounds)) - 1)
                    hit = (known[(slot >> _U(3)).astype(np.int64)] >> (slot & _U(7)).astype(np.uint8)) & 1 == 1
                    key, at = key[hit], at[hit]
                    if not len(at):
                        continue
                    # equal keys of equal second hashes are one phrase of this slice
                    check = windows(h, first, m, seed=90 + m)[0][at]
                    order = np.lexsort((check, key))
                    key, check, at = key[order], check[order], at[order]
                    heads = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (check[1:] != check[:-1])]))
                    n = np.diff(np.append(heads, len(at)))
                    at = at[heads]
                    held.append(pa.RecordBatch.from_arrays(
                        [pa.array(names, pa.string()).take(pa.array(lang[at])), _phrases(w, at, m),
                         pa.array(np.full(len(at), m, np.int32)), pa.array(n.astype(np.int64))], names=["lang", "phrase", "size", "f"]))
                    size += len(at)
                if size >= FLUSH // 2:
                    held = total(held)
                    size = sum(b.num_rows for b in held)
                    if size >= FLUSH // 4:
                        yield from held
                        held, size = [], 0
        if words:
            held.append(pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array([""] * len(words), pa.string()),
                                                    pa.array([0] * len(words), pa.int32()), pa.array(list(words.values()), pa.int64())],
                                                   names=["lang", "phrase", "size", "f"]))
        if held:
            yield from total(held)

    return docs.mapInArrow(count, "lang string, phrase string, size int, f long")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, same: int = 100) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases by score descending, a descending,
    phrase. same: a phrase goes if a longer candidate around it has at least this percentage of its count."""
    f, n = count_phrases(docs, least, longest)
    found = f.filter("size > 1")
    words = F.split("phrase", " ")
    # a longer candidate around a phrase contains one that is a single word longer and at least as frequent
    inner = F.explode(F.array(F.array_join(F.slice(words, F.lit(1), F.col("size") - 1), " "),
                              F.array_join(F.slice(words, F.lit(2), F.col("size") - 1), " ")))
    around = (found.filter("size > 2").select("lang", inner.alias("phrase"), F.col("f").alias("longer"))
              .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    kept = (found.join(around, ["lang", "phrase"], "left")
            .filter(F.col("longer").isNull() | (F.lit(100).cast("decimal(38,0)") * F.col("longer") < F.lit(same) * F.col("f"))))
    k = F.col("k")
    cuts = (kept.select("lang", "phrase", F.col("f").alias("a"), "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
            .select("lang", "phrase", "a", "k", F.array_join(F.slice(words, F.lit(1), k), " ").alias("head"),
                    F.array_join(F.slice(words, k + 1, F.col("size") - k), " ").alias("rest")))
    part = lambda name, count: f.select("lang", F.col("phrase").alias(name), F.col("f").alias(count))
    cuts = cuts.join(part("head", "l"), ["lang", "head"]).join(part("rest", "r"), ["lang", "rest"]).join(n, "lang")
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    cuts = cuts.withColumn("score", F.call_function("div", F.lit(1000).cast("decimal(4,0)") * (wide("a") * wide("n")), wide("l") * wide("r")))
    best = (cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("x")).select("lang", "phrase", "x.*"))
    ranked = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (best.withColumn("rank", F.row_number().over(ranked).cast("long")).filter(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
