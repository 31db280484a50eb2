"""Incremental ingest loads each file once and keeps ids unique, retries included."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.sources import fixture
from ledgerlake.sources.raw_files import RAW_SCHEMA, SOURCE
from ledgerlake.sources.tables import TableStore, run_folder
from ledgerlake.streaming import incremental

SF_SMALL = "/root/testdata/sf0.001"
AT = dt.datetime(2025, 10, 20, 12)


def test_available_now_loads_each_file_once(spark):
    root = run_folder(spark)
    src, ckpt, store = f"{root}/incoming", f"{root}/ckpt", TableStore(spark, root)
    raw = fixture.raw_spending(fixture.load_tables(spark, SF_SMALL)).select("key", *RAW_SCHEMA.fieldNames())
    first, second = (raw.filter(F.col("key") % 2 == i).drop("key") for i in (0, 1))
    first.coalesce(2).write.parquet(src)
    incremental.incremental_ingest(spark, src, root, ckpt, AT)
    n = first.count()
    assert store.read(SOURCE).count() == n
    incremental.incremental_ingest(spark, src, root, ckpt, AT)  # nothing new: no duplicates
    assert store.read(SOURCE).count() == n
    second.coalesce(1).write.mode("append").parquet(src)
    incremental.incremental_ingest(spark, src, root, ckpt, AT)
    out = store.read(SOURCE)
    assert out.count() == out.select("src_id").distinct().count() == raw.count()
    assert out.agg(F.min("src_id")).first()[0] == 1
    assert out.select("load_batch_id").distinct().count() >= 2
    batch = incremental.file_position(spark.read.schema(RAW_SCHEMA).parquet(src)).limit(5)
    first_batch = "load_batch_id = 'LOAD_STREAM_000000'"
    others = {r.src_id for r in out.filter(f"NOT {first_batch}").select("src_id").collect()}
    incremental._batch_writer(root, AT)(batch, 0)  # a retry replaces its own partition and nothing else
    after = store.read(SOURCE)
    assert after.filter(first_batch).count() == 5
    assert {r.src_id for r in after.filter(f"NOT {first_batch}").select("src_id").collect()} == others


def test_errors_are_raised(spark):
    with pytest.raises(Exception):  # noqa: B017
        incremental.incremental_ingest(spark, "/nonexistent/folder", run_folder(spark), f"{run_folder(spark)}/c", AT)
