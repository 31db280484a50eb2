"""Lasting dimensions: a keyed merge that rewrites only the buckets it touches (SCD type 1).

A dimension is stored by buckets of its name. A load's names are compared with the stored
ones: a known name keeps its key and takes the load's class, a new one is added with the
load's key. Buckets without a difference are carried over untouched, so a load that
brings nothing new writes nothing. Two loads that touch the same bucket at once do not
lose a row: the slower one finds the bucket changed and merges again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import Conflict, TableStore
from .staging import DIM_SPECS

BUCKETS = 16  # of a new dimension: about the bytes of the dimension / 128 MB, at least this many


def _table(dim: str) -> str:
    return f"stg_dim_{dim}"


def _bucket(name: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(buckets)).cast("int")


def _differences(held: DataFrame, incoming: DataFrame, dim: str) -> DataFrame:
    """Rows that the stored dimension lacks or holds with another class; known names with their key."""
    name, attr, key = DIM_SPECS[dim]
    old = held.select(F.col(name).alias("_name"), F.col(key).alias("_key"), *([F.col(attr).alias("_attr")] if attr else []))
    both = incoming.join(old, F.col(name) == F.col("_name"), "left")
    other = F.col("_key").isNull()
    if attr:
        other = other | ~F.col(attr).eqNullSafe(F.col("_attr"))
    return both.filter(other).select(F.coalesce("_key", key).alias(key), name, *([attr] if attr else []))


def _rewrite(store: TableStore, dim: str, rows: DataFrame, gone: DataFrame, buckets: int) -> list[int]:
    """Replace the buckets that ``rows`` or the names of ``gone`` are in; returns them."""
    name = DIM_SPECS[dim][0]
    while True:
        base = store.version(_table(dim))
        out = rows.withColumn("bucket", _bucket(name, buckets))
        names = gone.select(name).withColumn("bucket", _bucket(name, buckets)).unionByName(out.select(name, "bucket"))
        touched = sorted(r[0] for r in names.select("bucket").distinct().collect())  # bucket numbers
        if not touched:
            return []
        parts = [f"bucket={b}" for b in touched]
        held = store.read(_table(dim), parts=parts).join(names.select(name), name, "left_anti")
        try:
            store.write(held.select(*out.columns).unionByName(out), _table(dim), partition_by=["bucket"], base=base, parts=parts)
            return touched
        except Conflict:
            continue


def upsert(store: TableStore, dim: str, incoming: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Merge ``incoming`` (key, name, class) into the stored dimension; returns the buckets written."""
    name = DIM_SPECS[dim][0]
    if not store.exists(_table(dim)):
        try:
            store.write(incoming.withColumn("bucket", _bucket(name, buckets)), _table(dim), partition_by=["bucket"], base=0,
                        properties={"buckets_of_names": buckets})
            return sorted(int(b) for b in store.partition_values(_table(dim), "bucket"))
        except Conflict:  # another load was the first
            pass
    buckets = store.manifest(_table(dim))["properties"]["buckets_of_names"]
    return _rewrite(store, dim, _differences(read(store, dim), incoming, dim), incoming.limit(0), buckets)


def shrink(store: TableStore, dim: str, remaining: DataFrame) -> list[int]:
    """Drop the names that ``remaining`` does not have and take its classes; keys stay. Returns the buckets written."""
    name = DIM_SPECS[dim][0]
    buckets = store.manifest(_table(dim))["properties"]["buckets_of_names"]
    held = read(store, dim)
    return _rewrite(store, dim, _differences(held, remaining, dim), held.join(remaining.select(name), name, "left_anti"), buckets)


def read(store: TableStore, dim: str) -> DataFrame:
    return store.read(_table(dim)).drop("bucket")
