"""Operator 6: benchmark decontamination by a prefix-filtered set join (DataFrame functions only).

A window is 10 consecutive words of a benchmark item (a shorter item is one window).
To contain a window a text must contain every word of it, so one necessary token per
window is enough to find candidates: its rarest word, rarity being the word's count
over the whole corpus. Corpus words are joined with these prefix words by hash; the
position of the word in the window fixes where the window would start, the length
bound (the window must fit into the text) and the neighbouring words drop most
candidates, and the remaining ones are compared word by word.

Words are runs of ASCII letters and digits and of all characters beyond ASCII, with
A-Z lower-cased. Defined results: null and empty texts have no words and no hits;
items without words have no window; a null item_id is listed as an empty string.
Rows are judged one by one: rows that share a doc_id and a text share one result.
The benchmark's windows are broadcast only if a count proves them few; else corpus
words are shuffled with the words that a window around them can reach, not the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.scratch import small, stored

SIZE = 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text; null has none. Lower-casing comes first, so A-Z are letters here."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), _GAP)
    return F.filter(parts, lambda w: w != "")


def item_windows(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """(window, items): the distinct windows with the sorted ids of their items."""
    w = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    return (w.filter(F.size("w") > 0).select("item", "w", F.explode(starts).alias("at"))
            .select("item", F.slice("w", F.col("at"), F.lit(size)).alias("window"))
            .groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items")))


def prefix_tokens(windows: DataFrame, docs: DataFrame) -> DataFrame:
    """``windows`` with token (hash of the necessary word) and offset (words before it):
    the word with the smallest count over all documents, the first such in the window."""
    vocabulary = windows.select(F.explode("window").alias("word")).distinct()
    counts = (docs.select(F.explode(words(F.col("text"))).alias("word")).join(small(vocabulary), "word", "left_semi")
              .groupBy("word").count())
    places = windows.select("window", "items", F.posexplode("window").alias("offset", "word"))
    ranked = places.join(counts, "word", "left").groupBy("window").agg(
        F.first("items").alias("items"),
        F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "offset", "word")).alias("rare"))
    return ranked.select("window", "items", F.xxhash64("rare.word").alias("token"), F.col("rare.offset").alias("offset"))


def window_hits(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """(id columns of docs, start, n, items) for every occurrence of a window; docs has
    doc_id, tag (a hash of the text) and text."""
    windows = stored(item_windows(benchmark, size), "windows")
    tokens = stored(prefix_tokens(windows, docs), "prefix-tokens")
    few = small(tokens)
    spread = docs.select("doc_id", "tag", words(F.col("text")).alias("w")).select("doc_id", "tag", "w", F.explode(
        F.when(F.size("w") > 0, F.sequence(F.lit(0), F.size("w") - 1))).alias("pos"))
    spread = spread.withColumn("token", F.xxhash64(F.get("w", F.col("pos")))).withColumn("first", F.lit(0))
    if few is tokens:  # they are shuffled
        first = F.greatest(F.col("pos") - (size - 1), F.lit(0))
        near = F.slice("w", first + 1, F.lit(2 * size - 1))
        spread = spread.select("doc_id", "tag", near.alias("w"), "pos", "token", first.alias("first"))
    met = spread.join(few, "token")
    start = F.col("pos") - F.col("offset")
    n = F.size("window")
    at = start - F.col("first")  # in the words at hand, which begin at the text's word ``first``
    fits = (at >= 0) & (at + n <= F.size("w"))
    return (met.filter(fits & (F.slice("w", at + 1, n) == F.col("window")))
            .select("doc_id", "tag", start.alias("start"), n.alias("n"), "items"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, tag, n_words, n_hit, items (sorted ids as strings) and contaminated, one
    row per row of docs; tag is a hash of the text."""
    tagged = docs.select("doc_id", F.xxhash64("text").alias("tag"), "text")
    hits = window_hits(tagged, benchmark, size)
    found = hits.groupBy("doc_id", "tag").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)))))
        .alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    found = found.withColumnsRenamed({"doc_id": "_doc_id", "tag": "_tag"})
    counted = tagged.select("doc_id", "tag", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    both = counted.join(found, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("tag") == F.col("_tag")), "left")
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    return both.select("doc_id", "tag", "n_words", n_hit.alias("n_hit"),
                       F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                       (n_hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """``docs`` without the documents that contain a window of the benchmark."""
    tagged = docs.drop("_id", "_bad").withColumn("_tag", F.xxhash64("text"))
    hits = window_hits(tagged.select("doc_id", F.col("_tag").alias("tag"), "text"), benchmark, size)
    bad = small(stored(hits.select(F.col("doc_id").alias("_id"), F.col("tag").alias("_bad")).distinct(), "contaminated"))
    return tagged.join(bad, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_tag") == F.col("_bad")),
                       "left_anti").drop("_tag")
