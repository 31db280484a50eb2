"""Operator 1: mixing sources to target weights by blocks.

The words of each source, its documents in a pseudorandom order, form one stream that
is cut into blocks of a fixed length (the last one may be shorter). Sources share the
budget by weight, none above ``cap`` times its own size. A source's share is a number
of slots in the output; the source counts of the output shards are multinomial draws,
made so that each source's total is exactly its share (first over groups of shards,
then inside each group, by seeded generators). Slot k of a source takes block
p(k mod blocks), where p is a keyed pseudorandom permutation of the source's block
numbers (a Feistel network, one key per pass over the source), so a block is never
taken more often than ``cap`` rounded up, and the join of slots and blocks is a plain
equi-join on (source, block): a source with a third of all rows is spread over its
blocks. The last slot of a source is cut to the exact word count.

Stream positions are prefix sums in two levels: inside buckets of a source, and over
the bucket totals. All draws depend on the seed, the data and the parameters only, so
reruns agree whatever the partitioning.

Defined results: null and empty texts have size 0 and are taken 0 times; a null source
is a source of its own, ordered last; without words every target is 0. Equal rows are
separate rows of the stream. Repeated doc_ids are allowed. Other columns pass on.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.scratch import stored

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
SHARE, CAP = 1.5, 2.0
BLOCK = 64  # words in a block
SHARD = 1024  # slots in an output shard, on average
GROUP = 64  # shards in a group of the two-step draw: 65,536 slots are made by one task at a time
MOST_TASKS = 100_000
BUCKETS = 4096  # per source, for the prefix sums
SEED = 20


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(key, source, source_size, target): weights repeat in the order of sources by code
    point, null last. Targets are min(cap x size, level x weight) with the one level that
    spends the budget. One row per source goes through the ordered windows."""
    own = sized.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    ranked = own.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.col("rank") % len(weights) + 1)
    limited = ranked.withColumn("w", w).withColumn("limit", cap * F.col("source_size"))
    order = Window.orderBy(F.col("limit") / F.col("w"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = ((share * F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
             / F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)))
    levels = limited.withColumn("level", level).withColumn(
        "free", F.when(F.col("level") <= F.col("limit") / F.col("w"), F.col("level")))
    # the first source that its limit does not stop sets the level of all
    fixed = levels.withColumn("all", F.coalesce(F.first("free", ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.lit(float("inf"))))
    return fixed.select("key", "source", "source_size", F.least(F.col("limit"), F.col("all") * F.col("w")).alias("target"))


def stream_positions(sized: DataFrame) -> DataFrame:
    """``sized`` with bucket, row (number in the bucket) and start (words before it in its
    source's stream)."""
    mixed = sized.withColumn("_order", F.xxhash64(F.lit(SEED), "doc_id"))
    placed = mixed.withColumn("bucket", F.pmod("_order", F.lit(BUCKETS)))
    inside = Window.partitionBy("key", "bucket").orderBy("_order", F.col("doc_id").asc_nulls_last(), "size", "tag")
    local = placed.withColumns({
        "row": F.row_number().over(inside),
        "_before": F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")})
    totals = (placed.groupBy("key", "bucket").agg(F.sum("size").alias("words"))
              .withColumn("_base", F.sum("words").over(Window.partitionBy("key").orderBy("bucket")) - F.col("words"))
              .select("key", "bucket", "_base"))
    return (local.join(totals, ["key", "bucket"]).withColumn("start", F.col("_base") + F.col("_before"))
            .drop("_order", "_before", "_base"))


def permute(at: np.ndarray, size: int, key: int) -> np.ndarray:
    """Keyed permutation of range(size): four Feistel rounds, walked until inside."""
    if size <= 1:
        return np.zeros(len(at), np.int64)
    half = max(1, (int(size - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.random.default_rng(key).integers(0, 2**63, 4, dtype=np.uint64) | np.uint64(1)

    def scramble(v: np.ndarray) -> np.ndarray:
        left, right = v >> np.uint64(half), v & mask
        for k in keys:
            f = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            f ^= f >> np.uint64(29)
            f = f * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, (left ^ (f >> np.uint64(32))) & mask
        return left << np.uint64(half) | right

    out = scramble(at.astype(np.uint64))
    while (outside := out >= size).any():
        out[outside] = scramble(out[outside])
    return out.astype(np.int64)


def _plan(size: int, target: float, block: int) -> tuple[int, int, int]:
    """(words to take, slots, blocks) of a source."""
    words, full = int(round(target)), size // block
    blocks = full + (size % block > 0)
    if not blocks:
        return 0, 0, 0
    passes, rest = divmod(words, size)
    return words, passes * blocks + (-(-rest // block) if rest <= full * block else blocks), blocks


def slots(targets: DataFrame, block: int = BLOCK, shard_slots: int = SHARD, seed: int = SEED) -> DataFrame:
    """(key, shard, slot, pass, block, take): for each slot of the output the block that
    fills it and how many of its words are taken."""
    sources = stored(targets, "targets")
    one = f"array_max(array(1L, CAST(ceil(target / {block}) AS bigint)))"
    shards = int(sources.select(F.ceil(F.coalesce(F.sum(F.expr(one)), F.lit(0)) / shard_slots)).first()[0]) or 1
    groups = -(-shards // GROUP)

    def rng(key: str, *more: int) -> np.random.Generator:
        return np.random.default_rng([seed, zlib.crc32(key.encode()), *more])

    def of_groups(batches):
        sizes = np.full(groups, GROUP, float)
        sizes[-1] = shards - GROUP * (groups - 1)
        for b in batches:
            for r in b.itertuples():
                _, n, _ = _plan(int(r.source_size), r.target, block)
                count = rng(r.key, 1).multinomial(n, sizes / shards)
                keep = np.flatnonzero(count)
                first = np.cumsum(count) - count
                yield pd.DataFrame({"key": r.key, "source_size": r.source_size, "target": r.target, "group": keep,
                                    "first": first[keep], "n": count[keep]})

    def of_shards(batches):
        for b in batches:
            for r in b.itertuples():
                width = min(GROUP, shards - GROUP * r.group)
                count = rng(r.key, 2, r.group).multinomial(r.n, np.full(width, 1 / width))
                words, _, blocks = _plan(int(r.source_size), r.target, block)
                size, full = int(r.source_size), int(r.source_size) // block
                base = GROUP * r.group + np.arange(width)
                done = 0
                for lo in range(0, r.n, 200_000):  # a group's slots, some at a time
                    k = r.first + np.arange(lo, min(r.n, lo + 200_000), dtype=np.int64)
                    if lo == 0:
                        of = np.repeat(base, count)
                    turn, at = np.divmod(k, blocks)
                    index = at.copy()
                    for t in np.unique(turn):
                        whole = (turn == t) & (at < full)
                        index[whole] = permute(at[whole], full, zlib.crc32(f"{seed}/{r.key}/{t}".encode()))
                    left = words - turn * size - at * block  # words of the share that remain for this slot
                    here = np.where(at < full, block, size - full * block)
                    yield pd.DataFrame({"key": r.key, "shard": of[done:done + len(k)], "slot": k, "pass": turn,
                                        "block": index, "take": np.minimum(here, left)})
                    done += len(k)

    drawn = sources.select("key", "source_size", "target").mapInPandas(
        of_groups, "key string, source_size long, target double, group long, first long, n long")
    # a number of its own: by their few bytes the rows would all be dealt to one task
    units = min(MOST_TASKS, max(1, groups * sources.count()))
    filled = drawn.repartition(units, "key", "group").mapInPandas(
        of_shards, "key string, shard long, slot long, pass long, block long, take long")
    return filled.hint("merge")  # its size is guessed from the few rows it grows from: never broadcast it


def sized_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with size (words), key (the source, null marked apart) and tag (a hash of the text)."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.withColumns({"size": size, "tag": F.xxhash64("text"),
                             "key": F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), "source"))})


def pieces(placed: DataFrame, block: int = BLOCK, words: str | None = None) -> DataFrame:
    """The parts of documents that lie in each block: block, offset (words of the block
    before the part), from_word (words of the document before it), n; documents without
    words have one row without a block. words: an array column, which is replaced by
    text, the words of the part: each row carries its own words only."""
    first = F.floor(F.col("start") / block)

    def part(b):
        begin = F.greatest(F.col("start"), b * block)
        from_word, n = begin - F.col("start"), F.least(F.col("start") + F.col("size"), (b + 1) * block) - begin
        own = [] if words is None else [F.array_join(F.slice(words, (from_word + 1).cast("int"), n.cast("int")), " ").alias("text")]
        return F.struct(b.alias("block"), (begin - b * block).alias("offset"), from_word.alias("from_word"), n.alias("n"), *own)

    parts = F.transform(F.sequence(first, F.floor((F.col("start") + F.col("size") - 1) / block)), part)
    kept = [c for c in placed.columns if words is None or c not in (words, "text")]
    return placed.select(*kept, F.explode_outer(F.when(F.col("size") > 0, parts)).alias("_part")).select(*kept, "_part.*")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, block: int = BLOCK) -> DataFrame:
    """The mix: one row per slot and part of a document in it, with all columns of docs
    (text holds the taken words only), and shard, slot, pass, from_word, taken."""
    added = ("shard", "slot", "pass", "from_word", "taken")
    names = [c for c in docs.columns if c not in added]
    others = F.struct(*[F.col(c) for c in names if c != "text"])  # packed: their names cannot clash with ours
    sized = sized_documents(docs.select(others.alias("_others"), "doc_id", "source", "text"))
    targets = source_targets(sized.select("key", "source", "size"), weights, share, cap)
    placed = stream_positions(sized)
    # a text is split once and cut into its parts before the explode
    placed = placed.withColumn("_words", F.filter(F.split("text", BLANKS), lambda w: w != "")).drop("text")
    parts = pieces(placed, block, "_words").filter("block IS NOT NULL")
    met = parts.join(slots(targets, block), ["key", "block"])
    taken = F.greatest(F.lit(0), F.least(F.col("n"), F.col("take") - F.col("offset")))
    out = met.withColumn("taken", taken).filter("taken > 0")
    cut = F.array_join(F.slice(F.split("text", " "), 1, F.col("taken").cast("int")), " ")
    whole = F.when(F.col("taken") == F.col("n"), F.col("text")).otherwise(cut)  # only the last slot of a source is cut
    return out.select(*[whole.alias(c) if c == "text" else F.col("_others")[c].alias(c) for c in names], *added)


def mixed_amounts(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP,
                  block: int = BLOCK) -> DataFrame:
    """Per row of docs: doc_id, source, size, source_size, target and taken (the words of
    it that the mix holds, repeats counted)."""
    sized = stored(sized_documents(docs).select("doc_id", "source", "key", "size", "tag"), "sizes")
    targets = stored(source_targets(sized, weights, share, cap), "targets")
    parts = pieces(stream_positions(sized), block)
    met = parts.join(slots(targets, block), ["key", "block"], "left")
    taken = F.greatest(F.lit(0), F.least(F.coalesce("n", F.lit(0)), F.coalesce("take", F.lit(0)) - F.col("offset")))
    rows = (met.groupBy("key", "bucket", "row").agg(F.first("doc_id").alias("doc_id"), F.first("size").alias("size"),
                                                    F.sum(taken).cast("long").alias("taken")))
    return (rows.join(targets, "key")
            .select("doc_id", "source", "size", "source_size", "target", "taken"))
