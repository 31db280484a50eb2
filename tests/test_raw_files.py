"""Batch loader: ids unique over files, folders and batches, stable when a batch is loaded again."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.operators import checks as K
from ledgerlake.operators import ingest as N
from ledgerlake.sources.fixture import adapter_config
from ledgerlake.sources.raw_files import MARKS, RAW_SCHEMA, SOURCE, load_batch
from ledgerlake.sources.tables import TableStore, run_folder

AT = dt.datetime(2025, 10, 20, 12)


def _files(spark, store, folder, n):
    """Two sub-folders that hold files of the same name."""
    rows = spark.range(n).select(*[F.concat(F.lit(c + folder), F.col("id")).alias(c) for c in RAW_SCHEMA.fieldNames()])
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    for sub in ("x", "y"):
        path = f"{store.root}/in/{folder}/{sub}"
        rows.coalesce(1).write.parquet(path)
        p = fs.Path(path)
        f = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        part = next(s.getPath() for s in f.listStatus(p) if s.getPath().getName().startswith("part-"))
        assert f.rename(part, fs.Path(f"{path}/part-same.parquet"))
    return f"{store.root}/in/{folder}/*"


def test_ids_over_folders_batches_and_reloads(spark):
    store = TableStore(spark, run_folder(spark))
    a, b = _files(spark, store, "a", 10), _files(spark, store, "b", 7)
    load_batch(store, a, "LOAD_A", AT)
    load_batch(store, b, "LOAD_B", AT)
    before = {r.src_id: r.amount for r in store.read(SOURCE).collect()}
    assert sorted(before) == list(range(1, 35))
    load_batch(store, a, "LOAD_A", AT)  # loaded again: same rows, same ids
    assert {r.src_id: r.amount for r in store.read(SOURCE).collect()} == before
    assert store.read(MARKS).count() == 2


def test_a_short_load_is_logged_as_failed(spark):
    offered = spark.createDataFrame([("A", 10), ("B", 5)], "load_batch_id string, file_rows long")
    src = spark.createDataFrame([("A",)] * 10 + [("B",)] * 3, "load_batch_id string")
    log = {r.validation_run_id: r for r in K.load_event_log(N.ingest_reconcile(offered, src), adapter_config()).collect()}
    assert log["A"].check_status == "PASSED" and log["A"].records_failed is None
    assert (log["B"].check_name, log["B"].check_status, log["B"].records_failed) == ("DATA_LOAD_FAILURE", "FAILED", 2)
    assert log["B"].error_message == "Loaded 3 of 5 rows"
