"""Adapter from the driver's TPC-H-style test tables to raw spending rows.

The test tables hold no spending data, so every job starts from this
projection: one raw text row per order, built only from integer arithmetic
and string formatting so that Spark and the DuckDB oracle agree exactly.
Rows are dirtied by rule so that rejects, checks and insights have work to do, and
written as raw files in two load batches, which the loader reads like any other input.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from .raw_files import RAW_SCHEMA

TEST_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Value lists of the adapter (indexes are taken modulo the list length).
CATEGORIES = ["Food", "Transport", "Groceries", "Entertainment", "Shopping",
              "Utilities", "Healthcare", "Education", "Fitness", "Dining"]
LOCATIONS = ["Shopee", "Grab", "Lazada", "MRT Station", "Bus Interchange", "Hawker Centre",
             "KFC", "Cinema", "Clinic", "Gym", "NTUC FairPrice", "Netflix"]
PAYMENT_METHODS = ["Cash", "Credit Card", "Debit Card", "PayNow", "GrabPay",
                   "Mobile Payment", "Bank Transfer", "Apple Pay", "Google Pay", "EZ-Link"]
DATE_STYLES = ["dd/MM/yyyy", "dd-MMM-yyyy", "yyyy-MM-dd", "dd-MM-yyyy", "yyyy-MM-dd '10:30:00'", "yyyy-MM-dd'T10:30:00'",
               "dd.MM.yyyy", "dd MMM yy", "dd-MMMM-yyyy", "MMM dd yyyy", "dd/MM/yy"]

# Dirt by rule: (modulus of the order key, value)
BAD_AMOUNT_MOD, BAD_AMOUNT = 97, "n/a"
BAD_DATE_MOD, BAD_DATE = 89, "31/02/2024"
NULL_LOCATION_MOD, NULL_PERSON_MOD, BLANK_CATEGORY_MOD = 83, 101, 103
REPEATED_MOD = 107  # such a row is there twice
PADDED_AMOUNT_MOD, PADDED_DATE_MOD, PAD = 59, 61, "\u00a0"
LAST_MONTH_MOD, LAST_MONTH = 29, "2001-08-01"  # such a row is dated in the last month, so that all persons have one
# Load batches, in loading order: (id, loaded at); rows of the first have keys divisible by 3.
BATCHES = [("LOAD_20251018_000000", _dt.datetime(2025, 10, 18, 12)), ("LOAD_20251020_000000", _dt.datetime(2025, 10, 20, 12))]
FIRST_BATCH_MOD = 3
RAW_NAME = "daily_spending.parquet"


def load_tables(spark: SparkSession, sf_dir: str, names=("orders", "customer", "nation")) -> dict:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def _pick(values, idx):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _every(mod: int):
    return F.pmod(F.col("key"), F.lit(mod)) == 0


def order_rows(tables: dict) -> DataFrame:
    """The orders that raw rows are made of, with key, copy and batch (its position in BATCHES)."""
    o = tables["orders"].select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = tables["customer"].select("c_custkey", "c_nationkey")
    n = tables["nation"].select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    copies = F.when(_every(REPEATED_MOD), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return j.withColumnRenamed("o_orderkey", "key").select(
        "key", F.explode(copies).alias("copy"), F.when(_every(FIRST_BATCH_MOD), 0).otherwise(1).alias("batch"),
        "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority", "n_name")


def spending_texts(orders: DataFrame) -> DataFrame:
    """The raw rows of ``order_rows``, row by row and in their order."""
    k, every = F.col("key"), _every
    d = F.when(every(LAST_MONTH_MOD), F.date_add(F.lit(LAST_MONTH).cast("date"), F.pmod(k, F.lit(28)).cast("int"))) \
        .otherwise(F.col("o_orderdate").cast("date"))
    date_txt = F.date_format(d, DATE_STYLES[0])
    for i, style in enumerate(DATE_STYLES):
        date_txt = F.when(F.pmod(k, F.lit(len(DATE_STYLES))) == i, F.date_format(d, style)).otherwise(date_txt)
    cents = F.lit(152) + F.pmod(F.round(F.col("o_totalprice") * 100).cast("bigint"), F.lit(49809))
    num = F.concat(F.floor(cents / 100).cast("bigint").cast("string"), F.lit("."),
                   F.lpad(F.pmod(cents, F.lit(100)).cast("string"), 2, "0"))
    style = F.pmod(F.expr("key div 4"), F.lit(4))
    amount_txt = (F.when(style == 0, F.concat(F.lit("$"), num))
                  .when(style == 1, num)
                  .when(style == 2, F.concat(num, F.lit(" SGD")))
                  .otherwise(F.concat(F.lit("SGD "), num)))
    amount_txt = F.when(every(BAD_AMOUNT_MOD), F.lit(BAD_AMOUNT)).otherwise(amount_txt)
    amount_txt = F.when(every(PADDED_AMOUNT_MOD), F.concat(amount_txt, F.lit(PAD))).otherwise(amount_txt)
    date_txt = F.when(every(BAD_DATE_MOD), F.lit(BAD_DATE)).otherwise(date_txt)
    date_txt = F.when(every(PADDED_DATE_MOD), F.concat(F.lit(PAD), date_txt)).otherwise(date_txt)
    location = _pick(LOCATIONS, F.pmod(F.col("o_custkey"), F.lit(len(LOCATIONS))))
    return orders.select(
        "key", "copy", "batch",
        F.when(every(NULL_PERSON_MOD), F.lit(None)).otherwise(F.col("n_name")).alias("person_name"),
        date_txt.alias("spending_date"),
        F.when(every(BLANK_CATEGORY_MOD), F.lit("  "))
         .otherwise(_pick(CATEGORIES, F.pmod(k, F.lit(len(CATEGORIES))))).alias("category"),
        amount_txt.alias("amount"),
        F.when(every(NULL_LOCATION_MOD), F.lit(None)).otherwise(location).alias("location"),
        F.when(every(20), F.lit(None)).otherwise(F.col("o_orderpriority")).alias("description"),
        _pick(PAYMENT_METHODS, F.pmod(F.col("o_custkey"), F.lit(len(PAYMENT_METHODS)))).alias("payment_method"),
    )


def raw_spending(tables: dict) -> DataFrame:
    """The seven text columns of a raw row, with key, copy and batch (its position in BATCHES), in key
    order over as many partitions as the input has. The orders are sampled, dealt out and sorted; the texts,
    longer and dearer, are made once, from the sorted orders."""
    return spending_texts(order_rows(tables).repartitionByRange("key").sortWithinPartitions("key", "copy"))


def write_raw_files(rows: DataFrame, root: str, batches=tuple(BATCHES)) -> list[str]:
    """The raw input a deployment would receive: a folder of files per load batch, the
    same name in each, ``raw_spending`` in its order.
    Returns the folders in loading order."""
    out = []
    for batch, _ in batches:
        path, i = f"{root}/raw/{batch}/{RAW_NAME}", [b for b, _ in BATCHES].index(batch)
        rows.filter(F.col("batch") == i).select(*RAW_SCHEMA.fieldNames()).write.mode("overwrite").parquet(path)
        out.append(path)
    return out


def adapter_config(**changes) -> Config:
    """The run parameters that go with the test tables."""
    values = dict(
        as_of=_dt.datetime(2025, 10, 22), report_as_of=_dt.date(2001, 9, 1), load_batch_id=BATCHES[-1][0],
        transform_batch_id="STG_20251020_000000", validation_run_id="VAL_20251022_000000",
        snapshot_dates=(_dt.date(2025, 8, 20), _dt.date(2025, 10, 21)), snapshot_cutoffs=(_dt.date(2000, 1, 1), None),
        version=1, version_pair=(1, 2), person="NATION_5", category="Dining", snapshot_date=_dt.date(2025, 10, 21),
        year=2000, month=6)
    return Config(**values | changes)
