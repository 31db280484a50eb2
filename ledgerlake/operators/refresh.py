"""Refreshing marts by the months that changed.

Every published snapshot version leaves a mark per month: its rows and a sum of hashes over
all columns that a mart reads. Two versions whose marks differ in some months differ there and
nowhere else, whatever the reason: a new load batch, a deleted one, a dimension's changed class.
A mart of the newer version then recomputes those months and the months that look back on
them (a month ago, a year ago, rolling windows), reads the snapshot for these and the months they
look back on only, and carries all other rows over from the mart of the older version.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.period import month_idx
from ..sources.tables import TableStore

MARKS = "curated_month_marks"
LOOKS_BACK = (1, 2, 3, 4, 5, 12)  # months: the previous one, rolling windows of 3 and 6, the year before
READ = ["person_name", "category_name", "category_group", "location_name", "location_type", "payment_method_name",
        "payment_type", "spending_date", "amount_cleaned", "data_quality_score"]


def month_marks(rows: DataFrame) -> DataFrame:
    """month (year * 12 + month), rows, bad (no amount of 0 or more), mark."""
    return rows.groupBy(month_idx(F.col("spending_year"), F.col("spending_month")).cast("int").alias("month")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.coalesce(F.col("amount_cleaned") < 0, F.lit(True))).alias("bad"),
        F.sum(F.xxhash64(*READ).cast("decimal(38,0)")).alias("mark"))


def changed_months(store: TableStore, old: int, new: int) -> set[int] | None:
    """Months in which two versions differ; None if one of them has no marks."""
    versions = store.partition_values(MARKS, "snapshot_version")
    if not {str(old), str(new)} <= set(versions):
        return None
    of = lambda v: {(r.month, r.rows, r.mark) for r in store.read(MARKS, parts=[f"snapshot_version={v}"]).collect()}  # noqa: E731  a row per month
    return {m for m, _, _ in of(old) ^ of(new)}


def _within(months: set[int]) -> Column:
    """Whether spending_date lies in one of the months: one range of days for each run of months."""
    runs: list[list[int]] = []
    for m in sorted(months):
        if runs and m == runs[-1][1] + 1:
            runs[-1][1] = m
        else:
            runs.append([m, m])
    first = lambda m: _dt.date((m - 1) // 12, (m - 1) % 12 + 1, 1)
    day = F.col("spending_date")
    return reduce(lambda a, b: a | b, [(day >= F.lit(first(a))) & (day < F.lit(first(b + 1))) for a, b in runs], F.lit(False))


def refreshed(mart: DataFrame, rows: DataFrame, build: Callable[[DataFrame, Config], DataFrame], changed: set[int], new: int,
              cfg: Config) -> DataFrame:
    """The mart of version ``new`` (snapshot ``rows``) from that of an older version and the changed months."""
    affected = changed | {m + back for m in changed for back in LOOKS_BACK}
    needed = affected | {m - back for m in affected for back in LOOKS_BACK}
    here = month_idx(F.col("year"), F.col("month")).isin(*sorted(affected))
    carried = mart.filter(~here).withColumn("snapshot_version_source", F.lit(new))
    return build(rows.filter(_within(needed)), cfg).filter(here).unionByName(carried.select(*mart.columns))


def mart_of(store: TableStore, name: str, rows: DataFrame, build: Callable[[DataFrame, Config], DataFrame], new: int,
            cfg: Config) -> DataFrame:
    """The mart of version ``new``: refreshed from the newest older one where there is one, else built in full."""
    older = [int(v) for v in store.partition_values(name, "snapshot_version_source") if int(v) < new]
    changed = changed_months(store, max(older), new) if older else None
    if changed is None:
        return build(rows, cfg)
    mart = store.read(name, parts=[f"snapshot_version_source={max(older)}"])
    if not changed:
        return mart.withColumn("snapshot_version_source", F.lit(new))
    return refreshed(mart, rows, build, changed, new, cfg)
