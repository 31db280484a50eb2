"""Operator 2: quality rules by a hashed n-gram log-likelihood ratio.

Two multinomials over hashed word unigrams and bigrams are counted over every
distinct text: one of the trusted target (texts of documents whose label is quality
1), one of the raw corpus. A document's score is the mean log ratio of its n-grams
(length normalised); it is kept if no base rule fails and the score is not below
``threshold``. The rule is a fixed comparison: reruns agree. Copies count once, so a
verdict does not depend on how often the corpus repeats a text, and the smoothing
grows with the share of the target, so that an n-gram of one untrusted text alone says as
little in a corpus of trusted texts as in a raw one.

The table has more buckets than the corpus has n-grams, so a bucket holds one
n-gram at any corpus size and the smoothing counts mean the same. It is never in
one place: n-grams go to blocks of buckets, each block counts its own, and the
sums of ratios per document go back. The most frequent n-grams (at most ``HEAVY``, found
by Misra-Gries summaries) are counted where the texts are and their ratios broadcast, so
no block gets an entry per document of a common word. Ratios are rounded to 1 / ``SCALE``,
so that sums do not depend on the order of the parts.

Texts that share a hash with another row, as one bitmap of the whole corpus knows, are
reduced to one row each by a shuffle; all others stay where they are.

Defined results: null or empty texts have no words, score 0, and fail the base
rule on length. Without trusted documents the ratio is 0 everywhere, so only the
base rules decide. Null or repeated doc_ids are judged row by row; rows of one text have
one score, and the text is trusted if one of its documents is. Columns of
``documents`` other than doc_id and text are passed on untouched; result columns
replace input columns of the same name.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.repeats import find_repeats
from ledgerlake.llm.scratch import blocks_log2, small, stored
from ledgerlake.llm.words import WHITE, Words, _class, covered, mix, slices, windows

BUCKETS_LOG2 = 16  # at least
THRESHOLD = -0.17
SHRINK = 4.0  # counts added to both sides of each ratio, at least: rare buckets say little
OWN = 14.0  # ... and at least this many times the share of the target
HEAVY = 8192  # n-grams whose ratios are broadcast
SCALE = 4096
SYMBOLS = _class(set(b"#*$%&|<>"))
FLUSH = 2_000_000  # n-grams sent at a time
_DOCS_LOG2 = 14  # documents sent at a time
_BLANK = " \t\n\r\x0b\f"
_U = np.uint64


def _ngrams(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of unigrams, then bigrams; text index of each)."""
    h = w.hashes()
    two, good = windows(h, w.first, 2)
    return np.concatenate([mix(h ^ np.uint64(1)), two[good]]), np.concatenate([w.doc, w.doc[good]])


def distinct_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, trusted, a, b): one row per distinct text that is not null; a and b are hashes of it."""
    trusted = small(labels.filter("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
                    .withColumn("_trusted", F.lit(True)))
    rows = (docs.select("doc_id", "text").filter("text IS NOT NULL").join(trusted, "doc_id", "left")
            .select("text", F.coalesce("_trusted", F.lit(False)).alias("trusted"), *_text_hashes()))
    repeats = find_repeats(docs.select(_text_hashes()[0]).filter("a IS NOT NULL"),
                           lambda batch: iter([batch.column(0).to_numpy().view(_U)])).shared(docs.sparkSession)

    @F.arrow_udf("boolean")
    def again(a: pa.Array) -> pa.Array:
        return pa.array(repeats().maybe(a.to_numpy().view(_U)))

    rows = rows.withColumn("again", again("a"))
    copies = rows.filter("again").groupBy("a", "b").agg(F.any_value("text").alias("text"), F.max("trusted").alias("trusted"))
    columns = ("text", "trusted", "a", "b")
    return rows.filter("NOT again").select(*columns).unionByName(stored(copies.select(*columns), "copies"))


def _text_hashes() -> list:
    return [F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("a"), F.xxhash64(F.lit(1), "text").alias("b")]


def ngram_counts(texts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(raw, target) numbers of unigrams and bigrams over all texts, and hashes of the n-grams that may be
    among the most frequent, in order."""
    def count(batches):
        sums = np.zeros(4, np.int64)
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            flags = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for lo, piece in slices(batch.column(0)):
                w = Words(piece)
                one = w.counts
                two = np.maximum(one - 1, 0)
                mine = flags[lo: lo + len(piece)]
                sums += [one.sum(), two.sum(), one[mine].sum(), two[mine].sum()]
                # a Misra-Gries summary of the task's n-grams: what is beyond its capacity is taken from all
                k, n = np.unique(_ngrams(w)[0], return_counts=True)
                keys, at = np.unique(np.concatenate([keys, k]), return_inverse=True)
                counts = np.bincount(at, np.concatenate([counts, n]), len(keys)).astype(np.int64)
                if len(keys) > HEAVY:
                    counts = counts - np.partition(counts, len(counts) - HEAVY - 1)[len(counts) - HEAVY - 1]
                    keys, counts = keys[counts > 0], counts[counts > 0]
        key = np.concatenate([np.zeros(1, np.int64), keys.view(np.int64)])
        yield pa.RecordBatch.from_pydict({"head": pa.array(np.arange(len(key)) == 0), "key": pa.array(key), **{
            n: pa.array(np.concatenate([[v], counts if n == "a" else np.zeros(len(counts), np.int64)])) for n, v in zip("abcd", sums, strict=True)}})

    found = stored(texts.select("text", "trusted").mapInArrow(count, "head boolean, key long, a long, b long, c long, d long")
                   .groupBy("head", "key").agg(*[F.sum(n).alias(n) for n in "abcd"]), "ngrams")
    got = found.filter("head").agg(*[F.coalesce(F.sum(n), F.lit(0)) for n in "abcd"]).first()
    heavy = [r[0] for r in found.filter("NOT head").orderBy(F.desc("a"), "key").limit(HEAVY).select("key").collect()]
    return np.array(got[:2], np.int64), np.array(got[2:], np.int64), np.sort(np.array(heavy, np.int64).view(_U))


def _places(heavy: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in the sorted ``heavy``, whether it is there) of hashes."""
    if not len(heavy):
        return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
    at = np.minimum(np.searchsorted(heavy, h), len(heavy) - 1)
    return at, heavy[at] == h


def heavy_counts(texts: DataFrame, heavy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(raw, target) counts of the ``heavy`` n-grams over all texts."""
    def count(batches):
        sums = np.zeros((2, len(heavy)), np.int64)
        for batch in batches:
            flags = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for lo, piece in slices(batch.column(0)):
                h, doc = _ngrams(Words(piece))
                at, hit = _places(heavy, h)
                mine = flags[lo: lo + len(piece)][doc[hit]]
                sums[0] += np.bincount(at[hit], minlength=len(heavy))
                sums[1] += np.bincount(at[hit][mine], minlength=len(heavy))
        yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(len(heavy))), "raw": pa.array(sums[0]), "target": pa.array(sums[1])})

    raw, target = np.zeros(len(heavy)), np.zeros(len(heavy))
    for r in (texts.select("text", "trusted").mapInArrow(count, "at long, raw long, target long").groupBy("at")
              .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()):  # at most HEAVY rows
        raw[r["at"]], target[r["at"]] = r["raw"], r["target"]
    return raw, target


def smoothing(share: float) -> float:
    return max(SHRINK, OWN * share)


def log_ratio(raw: np.ndarray, target: np.ndarray, share: float) -> np.ndarray:
    """Per bucket, the log of target count over the count that the raw multinomial expects
    (``share``: target n-grams per raw n-gram)."""
    shrink = smoothing(share)
    return np.log(target + shrink) - np.log(raw * share + shrink)


def _pack(values: np.ndarray) -> bytes:
    """Numbers from 0 on as compressed byte planes, as many as the largest needs."""
    flat = np.ascontiguousarray(values, dtype="<u8")
    width = max(1, (int(flat.max()).bit_length() + 7) // 8) if len(flat) else 1
    return bytes([width]) + zlib.compress(flat.view(np.uint8).reshape(-1, 8).T[:width].tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(memoryview(data)[1:]), np.uint8).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : data[0]] = planes.T
    return out.reshape(-1).view("<u8").astype(np.int64)


def _sendings(batches, heavy: np.ndarray, known: np.ndarray):
    """(documents: trusted, a, b, n, sum of the ratios of their frequent n-grams; hashes of the other n-grams;
    document of each) of up to FLUSH n-grams."""
    most, held, n_docs, size = 1 << _DOCS_LOG2, [], 0, 0
    joined = lambda: [np.concatenate(c) for c in zip(*held, strict=True)]
    for batch in batches:
        flags = batch.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
        a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
        for lo, piece in slices(batch.column("text")):
            for at in range(0, len(piece), most):
                part = piece.slice(at, most)
                if held and (n_docs + len(part) > most or size > FLUSH):
                    yield joined()
                    held, n_docs, size = [], 0, 0
                w = Words(part)
                h, doc = _ngrams(w)
                place, hit = _places(heavy, h)
                own = np.bincount(doc[hit], known[place[hit]], minlength=len(part)).astype(np.int64)
                h, doc = h[~hit], doc[~hit]
                rows = slice(lo + at, lo + at + len(part))
                held.append((flags[rows], a[rows], b[rows], 2 * w.counts - (w.counts > 0), own, h, (doc + n_docs).astype(np.int32)))
                n_docs, size = n_docs + len(part), size + len(h)
    if held:
        yield joined()


def ngram_sums(texts: DataFrame, share: float, log2: int, heavy: np.ndarray, known: np.ndarray) -> DataFrame:
    """(a, b, total, n): per text the sum of its n-grams' log ratios, times SCALE, and their number.
    heavy, known: hashes of frequent n-grams and their ratios, which are summed at once. Of each
    sending, every block of buckets gets the documents' other n-grams and gives back one sum per
    document; the home row says which documents these are."""
    blocks = min(log2, blocks_log2(texts.sparkSession))

    def send(batches):
        for trusted, a, b, n, own, h, doc in _sendings(batches, heavy, known):
            bucket = (h >> np.uint64(64 - log2)).astype(np.int64)
            order = np.argsort(~trusted, kind="stable")  # trusted documents come first
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            code = np.sort((bucket << _DOCS_LOG2) | rank[doc])
            at = np.flatnonzero(np.r_[True, code[1:] != code[:-1]][: len(code)])
            times = np.diff(np.r_[at, len(code)])
            code = code[at]
            bucket, text = code >> _DOCS_LOG2, code & ((1 << _DOCS_LOG2) - 1)
            ends = np.searchsorted(bucket, np.arange((1 << blocks) + 1) << (log2 - blocks))
            keys = [v[order].view(_U) for v in (a, b)]
            batch = int.from_bytes(hashlib.blake2b(keys[0].tobytes() + keys[1].tobytes(), digest_size=7).digest(), "big")
            own = own[order]
            rows = [(batch & ((1 << blocks) - 1), True, _pack(keys[0]), _pack(keys[1]), _pack(n[order]) , _pack((own << 1) ^ (own >> 63)))]
            for block in np.flatnonzero(ends[1:] > ends[:-1]).tolist():
                s = slice(ends[block], ends[block + 1])
                local = bucket[s] - (block << (log2 - blocks))
                rows.append((block, False, _pack(np.diff(local, prepend=0)), _pack(text[s]), _pack(times[s]), None))
            block, home, x, y, z, v = zip(*rows, strict=True)
            yield pa.RecordBatch.from_pydict({
                "block": pa.array(block, pa.int32()), "batch": pa.array([batch] * len(rows), pa.int64()),
                "home": pa.array(home), "docs": pa.array([len(order)] * len(rows), pa.int32()),
                "trusted": pa.array([int(trusted.sum())] * len(rows), pa.int32()),
                **{n: pa.array(c, pa.binary()) for n, c in zip("xyzv", (x, y, z, v), strict=True)}})

    def rate(table: pa.Table) -> pa.Table:
        size = 1 << (log2 - blocks)
        raw, target, rows = np.zeros(size), np.zeros(size), []
        out = {n: [] for n in ("batch", "home", "x", "y", "z", "v")}
        for r in table.to_pylist():
            if r["home"]:
                for n, got in out.items():
                    got.append(r[n])
                continue
            local, text, times = np.cumsum(_unpack(r["x"])), _unpack(r["y"]), _unpack(r["z"])
            np.add.at(raw, local, times)
            mine = text < r["trusted"]
            np.add.at(target, local[mine], times[mine])
            rows.append((r["batch"], r["docs"], local, text, times))
        ratio = np.rint(log_ratio(raw, target, share) * SCALE)
        for batch, n_docs, local, text, times in rows:
            sums = np.bincount(text, ratio[local] * times, minlength=n_docs).astype(np.int64)
            for n, v in zip(out, (batch, False, _pack((sums << 1) ^ (sums >> 63)), None, None, None), strict=True):
                out[n].append(v)
        return pa.table({"batch": pa.array(out["batch"], pa.int64()), "home": pa.array(out["home"], pa.bool_()),
                         **{n: pa.array(out[n], pa.binary()) for n in "xyzv"}})

    def add(table: pa.Table) -> pa.Table:
        """Equal batches share a number: their sums and n-grams add up alike."""
        homes, total = [], 0
        signed = lambda got: (got >> 1) ^ -(got & 1)
        for home, x, y, z, v in zip(*[table.column(n).to_pylist() for n in ("home", "x", "y", "z", "v")], strict=True):
            if home:
                homes.append((_unpack(x), _unpack(y), _unpack(z)))
                total = total + signed(_unpack(v))
            else:
                total = total + signed(_unpack(x))
        n = sum(h[2] for h in homes)
        return pa.table({"a": homes[0][0], "b": homes[0][1], "total": np.zeros(len(n), np.int64) + total, "n": n})

    parts = texts.mapInArrow(
        send, "block int, batch long, home boolean, docs int, trusted int, x binary, y binary, z binary, v binary")
    return (parts.groupBy("block").applyInArrow(rate, "batch long, home boolean, x binary, y binary, z binary, v binary")
            .groupBy("batch").applyInArrow(add, "a long, b long, total long, n long")
            .groupBy("a", "b").agg(F.sum("total").alias("total"), F.sum("n").alias("n")))


def repeated_words(w: Words, size: int = 5) -> np.ndarray:
    """Words inside windows of ``size`` words that the same text holds twice or more."""
    h, good = windows(w.hashes(), w.first, size)
    marked = np.zeros(len(h), dtype=bool)
    at = np.flatnonzero(good)
    if len(at):
        key = mix(h[at] + w.doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(at), dtype=bool)
        twice[1:] |= same
        twice[:-1] |= same
        marked[at[order[twice]]] = True
    return covered(marked, size)


def per_text(w: Words, flags: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[w.first])


def duplicate_lines(texts: list) -> list[int]:
    out = []
    for t in texts:
        n = 0
        if t and "\n" in t:
            seen = set()
            for line in t.split("\n"):
                if line.strip(_BLANK):
                    if line in seen:
                        n += 1
                    seen.add(line)
        out.append(n)
    return out


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    llr (double), base_failed and kept."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    @F.arrow_udf("struct<" + ", ".join(f"{n}: bigint" for n in names) + ">")
    def judge(text: pa.Array) -> pa.Array:
        out = {n: [] for n in names}
        for _, piece in slices(text):
            w = Words(piece)
            heads = np.zeros(len(w.raw) + 1, dtype=np.int64)  # code points that lie in words
            np.cumsum(w.inside & ((w.raw & 0xC0) != 0x80), out=heads[1:])
            out["n_words"].append(w.counts)
            out["word_chars"].append(np.diff(heads[w.bounds]))
            out["n_symbols"].append(w.byte_counts(SYMBOLS))
            out["n_dup_lines"].append(np.array(duplicate_lines(piece.to_pylist()), dtype=np.int64))
            out["n_repeat_words"].append(per_text(w, repeated_words(w)))
        arrays = [pa.array(np.concatenate(v) if v else [], pa.int64()) for v in out.values()]
        return pa.StructArray.from_arrays(arrays, names=list(out))

    texts = distinct_texts(docs, labels)
    raw, target, heavy = ngram_counts(texts)
    raw, target = int(raw.sum()), int(target.sum())
    j = docs.withColumn("_judged", judge(F.col("text")))
    llr = F.lit(0.0)
    if target:
        log2, share = max(BUCKETS_LOG2, raw.bit_length()), target / raw
        known = np.rint(log_ratio(*heavy_counts(texts, heavy), share) * SCALE)
        sums = ngram_sums(texts, share, log2, heavy, known).select(
            F.col("a").alias("_a"), F.col("b").alias("_b"), F.col("total").alias("_total"), F.col("n").alias("_n"))
        a, b = _text_hashes()
        j = j.withColumns({"_a": a, "_b": b}).join(sums, ["_a", "_b"], "left")
        llr = F.coalesce(F.round(F.col("_total") / F.nullif(SCALE * F.col("_n"), F.lit(0)), 9), llr)
    cols = {n: F.col(f"_judged.{n}") for n in names} | {"llr": llr}
    failed = (cols["n_words"] < 10) | (100 * cols["n_repeat_words"] > 20 * cols["n_words"])
    return (j.withColumns(cols | {"base_failed": failed, "kept": ~failed & (cols["llr"] >= threshold)})
            .drop("_judged", "_a", "_b", "_total", "_n"))
