"""Curated snapshots: versioned full copies of the denormalised staging data.

Snapshots are append-only partitions of ``snapshot_version``; ``is_latest``
is derived (version = max version) instead of being updated in place, so a
failed run can never leave the table without a latest version.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions import clean as X
from ..functions.period import round2

CURATED_COLUMNS = [
    "snapshot_id", "snapshot_version", "snapshot_date", "snapshot_batch_id", "is_latest", "src_id",
    "stg_spending_id", "person_id", "category_id", "location_id", "payment_method_id", "person_name",
    "category_name", "category_group", "location_name", "location_type", "payment_method_name",
    "payment_type", "spending_date", "spending_year", "spending_month", "spending_quarter",
    "spending_day_of_week", "amount_cleaned", "currency_code", "description", "data_quality_score",
    "created_at",
]

ID_SPAN = 10 ** 12  # snapshot_id = version * ID_SPAN + stg_spending_id


def create_snapshot(complete: DataFrame, version: int, snapshot_date: _dt.date, cfg: Config) -> DataFrame:
    """Rows of one snapshot version (before ``is_latest`` is derived)."""
    return complete.select(
        (F.lit(version).cast("bigint") * ID_SPAN + F.col("spending_id")).alias("snapshot_id"),
        F.lit(version).alias("snapshot_version"),
        F.lit(snapshot_date).alias("snapshot_date"),
        F.lit(f"SNAP_{snapshot_date:%Y%m%d}_v{version}").alias("snapshot_batch_id"),
        "src_id", F.col("spending_id").alias("stg_spending_id"),
        "person_id", "category_id", "location_id", "payment_method_id",
        "person_name", "category_name", "category_group", "location_name", "location_type",
        "payment_method_name", "payment_type", "spending_date", "spending_year", "spending_month",
        "spending_quarter", X.iso_weekday(F.col("spending_date")).alias("spending_day_of_week"),
        "amount_cleaned", "currency_code", "description", "data_quality_score",
        F.lit(cfg.as_of).cast("timestamp_ntz").alias("created_at"),
    )


# --------------------------------------------------------------------------
# snapshot job reports
# --------------------------------------------------------------------------

def next_version(curated: DataFrame) -> DataFrame:
    return curated.agg(
        (F.coalesce(F.max("snapshot_version"), F.lit(0)) + 1).alias("next_version"),
        F.countDistinct("snapshot_version").alias("version_count"),
        F.max("snapshot_version").alias("current_latest"),
    )


def snapshot_precheck(complete: DataFrame) -> DataFrame:
    return complete.agg(
        F.count(F.lit(1)).alias("stg_rows"),
        (F.count(F.lit(1)) > 0).alias("stg_not_empty"),
        F.min("spending_date").alias("min_date"),
        F.max("spending_date").alias("max_date"),
        F.countDistinct("person_name").alias("distinct_persons"),
        F.countDistinct("category_name").alias("distinct_categories"),
        F.count_if(F.coalesce(F.col("amount_cleaned") < 0, F.lit(True))).alias("bad_amounts"),
    )


def snapshot_verify(curated: DataFrame, complete: DataFrame, version: int) -> DataFrame:
    """Rows inserted for the version vs rows in staging; exactly one latest version."""
    per_version = curated.agg(
        F.count_if(F.col("snapshot_version") == version).alias("found_rows"),
        F.countDistinct(F.when(F.col("is_latest") == 1, F.col("snapshot_version"))).alias("latest_versions"),
    )
    expected = complete.agg(F.count(F.lit(1))).scalar()
    return per_version.select(
        F.lit(version).alias("snapshot_version"), expected.alias("staging_rows"), "found_rows", "latest_versions",
        ((F.col("latest_versions") == 1)).alias("one_latest"),
    )


def snapshot_stats(curated: DataFrame) -> DataFrame:
    return curated.agg(
        F.countDistinct("snapshot_version").alias("total_versions"),
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("is_latest") == 1).alias("latest_rows"),
        F.count_if(F.col("is_latest") == 0).alias("historical_rows"),
    )


def version_counts(curated: DataFrame) -> DataFrame:
    """Per-version aggregate: a handful of rows, the input of every global window."""
    return curated.groupBy("snapshot_version", "snapshot_date").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.sum("amount_cleaned").cast("decimal(18,2)").alias("total_spending"),
    )


def snapshot_growth(curated: DataFrame, last: int = 5) -> DataFrame:
    v = version_counts(curated)
    w = Window.orderBy("snapshot_version")  # tens of rows after aggregation
    g = v.select(
        "snapshot_version", "snapshot_date", "record_count",
        F.lag("record_count").over(w).alias("prev_count"),
    ).withColumn("growth", F.col("record_count") - F.coalesce(F.col("prev_count"), F.lit(0)))
    g = g.withColumn("growth_pct", F.when(F.col("prev_count").isNull(), F.lit(0).cast("decimal(18,2)"))
                     .otherwise(round2((F.col("record_count") - F.col("prev_count")).cast("decimal(20,0)") * 100
                                       / F.nullif(F.col("prev_count"), F.lit(0)))))
    top = g.withColumn("_rn", F.row_number().over(Window.orderBy(F.desc("snapshot_version"))))
    return top.filter(F.col("_rn") <= last).drop("_rn")


def snapshot_prune(curated: DataFrame, cfg: Config) -> DataFrame:
    """Versions a retention run would drop: older than keep_days and not latest."""
    cutoff = F.date_sub(F.lit(cfg.as_of).cast("date"), cfg.keep_days)
    return (curated.filter((F.col("snapshot_date") < cutoff) & (F.col("is_latest") == 0))
            .groupBy("snapshot_version", "snapshot_date")
            .agg(F.count(F.lit(1)).alias("rows_to_drop")))
