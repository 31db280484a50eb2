"""Deleting a load batch with all that came from it.

Source and staging tables are partitioned by load batch, so a batch leaves them by its
partition. Snapshots hold rows of all batches: a row's source id lies in the range that its
batch has reserved, the ranges prune the scan by the ids' statistics, and only versions that
hold such rows are written anew, in one step each. Marts of those versions are built again.
Dimensions lose the names that no other batch has; the names that stay keep their keys.

Every step can be repeated: a delete that failed half way goes on when it is called again,
because a batch's id ranges are never given away.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Config
from ..sources.raw_files import SOURCE, id_ranges
from ..sources.tables import TableStore
from . import dimensions as D
from . import maintenance as MT
from . import marts as M
from . import staging as G
from .ingest import STATES

STAGED = ("stg_transformed", "stg_dim_pairs", "stg_fact_spending", "stg_spending_complete", STATES)
MARTS = {"dst_monthly_spending_summary": M.monthly_summary, "dst_category_trends": M.category_trends,
         "dst_person_analytics": M.person_analytics, "dst_payment_method_summary": M.payment_summary}


def of_batch(ranges: list[tuple[int, int]]) -> Column:
    """Whether a row's source id lies in one of the ranges."""
    return reduce(lambda a, b: a | b, [F.col("src_id").between(lo, hi - 1) for lo, hi in ranges], F.lit(False))


def versions_with(store: TableStore, ranges: list[tuple[int, int]]) -> list[int]:
    """Snapshot versions that hold rows of the ranges; files without such ids are skipped by their statistics."""
    if not ranges or not store.exists(MT.CURATED):
        return []
    found = store.read(MT.CURATED).filter(of_batch(ranges)).select("snapshot_version").distinct().collect()
    return sorted(r[0] for r in found)  # version numbers


def delete_batch(store: TableStore, batch_id: str, cfg: Config) -> dict[str, list]:
    """Remove the batch from every table; returns what was written anew or dropped, by table."""
    ranges = id_ranges(store, batch_id)
    done: dict[str, list] = {}
    for table in (SOURCE, *STAGED):
        if store.exists(table):
            done[table] = store.drop_partitions(table, "load_batch_id", [batch_id])
    if store.exists("stg_dim_pairs"):
        pairs = store.read("stg_dim_pairs")
        for dim in G.DIM_SPECS:
            if store.exists(f"stg_dim_{dim}"):
                done[f"stg_dim_{dim}"] = D.shrink(store, dim, G.dimension(pairs, dim))
    versions = versions_with(store, ranges)
    for v in versions:
        MT.rewrite_snapshot(store, v, ~of_batch(ranges))
    done[MT.CURATED] = versions
    for table, build in MARTS.items():
        built = [v for v in versions if str(v) in store.partition_values(table, "snapshot_version_source")]
        for v in built:
            rows = MT.read_version(store, v)
            if rows is None:
                store.drop_partitions(table, "snapshot_version_source", [v])
            else:
                MT.publish_mart(store, table, build(rows, cfg))
        done[table] = built
    for table in done:
        if store.manifest(table):
            store.vacuum(table)
    return done
