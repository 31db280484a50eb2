"""Partition-scoped writes: idempotent publish, prune, batch delete, CSV sink, SQL function."""

import csv
import datetime as dt
import os

import pytest

from pyspark.sql import functions as F

from ledgerlake.sources.fixture import adapter_config
from ledgerlake.operators import curated as U
from ledgerlake.operators import maintenance as MT
from ledgerlake.plans.pipeline import Spend
from ledgerlake.sources.tables import TableStore, run_folder

SF_SMALL = "/root/testdata/sf0.001"


def test_publish_is_idempotent_and_prune_keeps_latest(spark):
    cfg = adapter_config()
    store = TableStore(spark, run_folder(spark))
    complete = Spend(spark, SF_SMALL, cfg, store).complete
    n = complete.count()
    assert MT.publish_next(store, complete, dt.date(2025, 8, 1), cfg) == 1
    assert MT.publish_next(store, complete, dt.date(2025, 10, 21), cfg) == 2
    assert MT.publish_next(store, complete, dt.date(2025, 10, 21), cfg) == 2   # retry: same version, same rows
    cur = MT.read_snapshots(store)
    assert cur.count() == 2 * n
    assert [r[0] for r in cur.filter("is_latest = 1").select("snapshot_version").distinct().collect()] == [2]
    assert MT.prune_snapshots(store, cfg) == [1]                               # older than 30 days, not latest
    assert MT.read_snapshots(store).select("snapshot_version").distinct().count() == 1
    assert MT.prune_snapshots(store, cfg) == []                                # latest is never pruned
    assert MT.publish_next(store, complete, dt.date(2025, 10, 22), cfg) == 3


def test_gate_refuses_bad_snapshots(spark):
    cfg, store = adapter_config(), TableStore(spark, run_folder(spark))
    complete = Spend(spark, SF_SMALL, cfg, store).complete
    for bad in (complete.limit(0), complete.withColumn("amount_cleaned", F.lit(-1).cast("decimal(12,2)")),
                complete.withColumn("amount_cleaned", F.lit(None).cast("decimal(12,2)"))):
        with pytest.raises(MT.SnapshotRefused):
            MT.publish_next(store, bad, dt.date(2025, 10, 21), cfg)
    assert not store.exists(MT.CURATED)


def test_marts_last_by_source_version(spark):
    """Two runs on one store: versions go on, marts of both versions stay, reads take the newest."""
    root = run_folder(spark)
    a = Spend(spark, SF_SMALL, adapter_config(), TableStore(spark, root))
    rows = a.mss.count()
    later = adapter_config(snapshot_dates=(dt.date(2025, 10, 22), dt.date(2025, 10, 23)))
    b = Spend(spark, SF_SMALL, later, TableStore(spark, root))
    assert b.mss.count() == rows
    assert [int(v) for v in b.store.partition_values(MT.CURATED, "snapshot_version")] == [1, 2, 3, 4]
    assert [int(v) for v in b.store.partition_values("dst_monthly_spending_summary", "snapshot_version_source")] == [2, 4]
    again = Spend(spark, SF_SMALL, later, TableStore(spark, root))  # a retry changes nothing
    assert again.mss.count() == rows and len(again.store.partition_values(MT.CURATED, "snapshot_version")) == 4


def test_delete_batch_and_csv_export(spark):
    store = TableStore(spark, run_folder(spark))
    s = Spend(spark, SF_SMALL, adapter_config(), store)
    src = s.src
    assert src.count() > 0
    deleted = MT.delete_load_batch(store, "src_daily_spending", adapter_config().load_batch_id)
    assert len(deleted) == 1 and not os.path.exists(deleted[0].replace("file:", ""))
    s2 = Spend(spark, SF_SMALL, adapter_config(), TableStore(spark, run_folder(spark)))
    out = f"{s2.store.root}/export_csv"
    U.export_csv(s2.latest, out)
    back = spark.read.option("header", True).csv(out)
    assert back.count() == s2.latest.count() and len(back.columns) == len(U.EXPORT_COLUMNS)


def test_exported_files_are_in_order(spark):
    """Files read by name are in the order of the query; more than one task sorts."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    s = Spend(spark, SF_SMALL, adapter_config(), TableStore(spark, run_folder(spark)))
    out = f"{s.store.root}/export_csv"
    U.export_csv(s.latest, out)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    lines = []
    files = sorted(f for f in os.listdir(out.replace("file:", "")) if f.startswith("part-"))
    for f in files:
        with open(f"{out.replace('file:', '')}/{f}", newline="") as h:
            lines += [(r["spending_date"], r["person_name"]) for r in csv.DictReader(h)]
    assert len(files) > 1 and len(lines) == s.latest.count()
    assert lines == sorted(sorted(lines, key=lambda x: x[1]), key=lambda x: x[0], reverse=True)


def test_versions_are_compared_without_a_shuffle(spark):
    """Snapshots are bucketed by id: the joins and the count by id plan no exchange on it."""
    s = Spend(spark, SF_SMALL, adapter_config(), TableStore(spark, run_folder(spark)))
    cur = s.curated
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df, key in ((U.hq22_diff_versions(cur, 1, 2), "stg_spending_id"), (U.cv_cross_version_ids(cur), "stg_spending_id"),
                        (U.hq11_new_per_version(cur), "stg_spending_id")):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert not [x for x in plan.splitlines() if "Exchange" in x and key in x], plan
            assert "Bucketed: true" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    files = [f for _, _, fs in os.walk(s.store.path(MT.CURATED).replace("file:", "")) for f in fs if f.startswith("part-") and f.endswith(".parquet")]
    assert len(files) == 2 * MT.LEAST_BUCKETS  # one file per bucket and version: no task holds a month, or all


def test_sql_trend_function(spark):
    MT.register_sql_functions(spark)
    got = [r[0] for r in spark.sql(
        "SELECT get_trend_direction(x) FROM VALUES (NULL), (5.01), (-5.01), (5.00), (0) AS t(x)").collect()]
    assert got == ["NO_DATA", "INCREASING", "DECREASING", "STABLE", "STABLE"]


def test_shuffle_partitions_do_not_change_results(spark):
    from ledgerlake.operators import insights as I
    rows = {}
    for n in (3, 11):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        s = Spend(spark, SF_SMALL, adapter_config(), TableStore(spark, run_folder(spark)))
        rows[n] = [sorted(tuple(str(v) for v in r) for r in df.collect())
                   for df in (s.ct, s.pa, I.health_scorecard(s.pa))]
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert rows[3] == rows[11] and all(len(x) > 0 for x in rows[3])
    _ = F
