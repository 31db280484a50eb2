"""Growth: time linear in a text, work spread over tasks."""

import time

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import mixing, pii


def _seconds(f, *args):
    best = 1e9
    for _ in range(3):
        began = time.perf_counter()
        f(*args)
        best = min(best, time.perf_counter() - began)
    return best


@pytest.mark.parametrize("text", ["7" * 500_000, "x" * 500_000 + "@ ", "x" * 500_000 + " (at) ", "1." * 250_000, "+1(" * 150_000, "a@" * 250_000,
                                  "1 " * 250_000], ids=lambda t: f"{t[:3]}...{t[-4:]}")
def test_personal_data_in_time_linear_in_the_text(text):
    def spans(t):
        return pii.further_spans(t, pii.base_spans(t))
    one, two = _seconds(spans, text), _seconds(spans, text + text)
    assert two <= 3 * one + 0.05 and two < 10


def test_slots_are_made_by_many_tasks(spark):
    """Sources of millions of words: no task makes more slots than one group has."""
    targets = spark.createDataFrame([(k, 40_000_000, 30_000_000.0) for k in "abcd"], "key string, source_size long, target double")
    made = mixing.slots(targets).groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()
    total, most = sum(r.n for r in made), max(r.n for r in made)
    assert total == 4 * 30_000_000 // mixing.BLOCK
    assert len(made) >= 10 and most <= 6 * mixing.GROUP * mixing.SHARD  # hashing may put a few groups of one source together


def test_parts_carry_their_own_words_only(spark):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(1000)), "en", "a", 0), (2, None, "en", "a", 0), (3, "x", "en", "a", 0)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    placed = mixing.stream_positions(mixing.sized_documents(docs)).withColumn("_words", F.filter(F.split("text", " "), lambda w: w != ""))
    rows = mixing.pieces(placed, 64, "_words").filter("block IS NOT NULL").collect()
    assert "_words" not in rows[0].asDict() and sum(r.n for r in rows) == 1001
    assert all(len(r["text"].split()) == r.n <= 64 for r in rows)
