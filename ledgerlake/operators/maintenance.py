"""Table maintenance a Spark user runs on the stored tables.

A snapshot version, a mart version or a load batch is one partition, which a write replaces in
one step, so re-running a job (after a failure or a lost executor) is idempotent and a
half-written version is never visible. Version numbers come from a ledger, so that jobs that
publish at the same time get numbers of their own.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..sources.tables import TableStore
from . import refresh as RF
from . import snapshots as S

CURATED, VERSIONS = "curated_spending_snapshots", "curated_versions"
BUCKET_ROWS = 20_000_000  # rows for each file of a snapshot version ...
LEAST_BUCKETS, MOST_BUCKETS = 8, 100_000  # ... within these numbers


class SnapshotRefused(ValueError):
    """The gate before a snapshot found rows that must not be published, or none at all."""


def gate(complete: DataFrame) -> list:
    """Publish only if there are rows and no amount is negative or missing; returns the marks per month."""
    marks = RF.month_marks(complete).collect()  # a row per calendar month
    rows, bad = sum(m.rows for m in marks), sum(m.bad for m in marks)
    if not rows or bad:
        raise SnapshotRefused(f"{rows} rows, {bad} of them without an amount of 0 or more")
    return marks


def claim_version(store: TableStore, snapshot_date: _dt.date) -> int:
    """The version of a snapshot date: the one it has, or has claimed in a run that failed, else the next one.
    Numbers and dates are in a ledger, so the history of snapshots is not read."""
    claims, day = store.ledger(VERSIONS), snapshot_date.isoformat()
    live = {int(v) for v in store.partition_values(CURATED, "snapshot_version")}

    def mine(known):
        return next((e["snapshot_version"] for e in reversed(known) if e["snapshot_date"] == day
                     and (e["snapshot_version"] in live or e["snapshot_version"] > max(live, default=0))), None)

    def claim(last):
        known = claims.entries() if last else []
        if mine(known):
            return None
        return {"snapshot_version": max([*live, *(e["snapshot_version"] for e in known)], default=0) + 1, "snapshot_date": day}

    claims.append(claim)
    return mine(claims.entries())


def publish_snapshot(store: TableStore, rows: DataFrame, version: int, marks: list) -> None:
    """Replace one version partition. Rows are dealt by id to files of a bounded number of rows, sorted by date for
    month filters; all versions have the same buckets, so that versions are compared without a shuffle."""
    held, n = store.manifest(CURATED), sum(m.rows for m in marks)
    buckets = held["buckets"][2] if held and held.get("buckets") else min(MOST_BUCKETS, max(LEAST_BUCKETS, -(-n // BUCKET_ROWS)))
    store.write_part(rows, CURATED, "snapshot_version", version, buckets=("stg_spending_id", "spending_date", buckets))
    kept = store.spark.createDataFrame([(version, m.month, m.rows, m.mark) for m in marks],
                                       "snapshot_version int, month int, rows long, mark decimal(38,0)")
    store.write_part(kept.coalesce(1), RF.MARKS, "snapshot_version", version)


def publish_next(store: TableStore, complete: DataFrame, snapshot_date: _dt.date, cfg: Config) -> int:
    """Gate, then publish the next version; a snapshot of the same date that is published
    again (a retry) keeps its version. Returns the version."""
    marks = gate(complete)
    version = claim_version(store, snapshot_date)
    publish_snapshot(store, S.create_snapshot(complete, version, snapshot_date, cfg), version, marks)
    return version


def rewrite_snapshot(store: TableStore, version: int, kept: Column) -> None:
    """Replace a version by those of its rows that fulfil ``kept``; without any the version goes."""
    rows = store.read(CURATED, parts=[f"snapshot_version={version}"]).filter(kept)
    marks = RF.month_marks(rows).collect()  # a row per calendar month
    if marks:
        publish_snapshot(store, rows, version, marks)
    else:
        store.drop_partitions(CURATED, "snapshot_version", [version])
        store.drop_partitions(RF.MARKS, "snapshot_version", [version])


def read_version(store: TableStore, version: int) -> DataFrame | None:
    """Rows of one version as the mart jobs take them; None if there is no such version."""
    if str(version) not in store.partition_values(CURATED, "snapshot_version"):
        return None
    return store.read(CURATED, parts=[f"snapshot_version={version}"]).withColumn("is_latest", F.lit(1)).select(*S.CURATED_COLUMNS)


def read_snapshots(store: TableStore) -> DataFrame:
    """All versions, with is_latest from one folder listing."""
    newest = store.max_partition_value(CURATED, "snapshot_version")
    flag = F.when(F.col("snapshot_version") == F.lit(newest), 1).otherwise(0)
    return store.read(CURATED).withColumn("is_latest", flag).select(*S.CURATED_COLUMNS)


def read_latest(curated: DataFrame, store: TableStore) -> DataFrame:
    newest = store.max_partition_value(CURATED, "snapshot_version")
    return curated.filter(F.col("snapshot_version") == F.lit(newest)).withColumn("is_latest", F.lit(1))


def publish_mart(store: TableStore, name: str, mart: DataFrame) -> None:
    """Replace the mart rows built from one snapshot version (DELETE WHERE
    version = v; INSERT) as one partition overwrite."""
    store.append_partition(mart, name, ["snapshot_version_source"])


def read_mart(store: TableStore, name: str) -> DataFrame:
    """The mart rows of the newest snapshot version."""
    newest = store.max_partition_value(name, "snapshot_version_source")
    rows = store.read(name)
    return rows if newest is None else rows.filter(F.col("snapshot_version_source") == F.lit(newest))


def prune_snapshots(store: TableStore, cfg: Config) -> list:
    """Drop versions older than keep_days that are not the latest; returns
    the dropped versions (the planning query is snapshot_prune)."""
    victims = [r.snapshot_version for r in S.snapshot_prune(read_snapshots(store), cfg)
               .select("snapshot_version").distinct().collect()]  # a handful of version numbers
    store.drop_partitions(CURATED, "snapshot_version", victims)
    return sorted(victims)


def delete_load_batch(store: TableStore, table: str, batch_id: str) -> list:
    """Remove one bad load batch from the source table alone (``lineage.delete_batch``: from all tables)."""
    return store.drop_partitions(table, "load_batch_id", [batch_id])


TREND_SQL = """CREATE OR REPLACE TEMPORARY FUNCTION get_trend_direction(percent_change DECIMAL(18,2))
RETURNS STRING
RETURN CASE WHEN percent_change IS NULL THEN 'NO_DATA'
            WHEN percent_change > 5 THEN 'INCREASING'
            WHEN percent_change < -5 THEN 'DECREASING'
            ELSE 'STABLE' END"""


def register_sql_functions(spark: SparkSession) -> None:
    """SQL-callable get_trend_direction(pct): a SQL function that Catalyst
    inlines into the calling plan (no Python, no per-row call)."""
    spark.sql(TREND_SQL)
