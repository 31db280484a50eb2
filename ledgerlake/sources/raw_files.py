"""Raw spending files -> source table rows (batch form of the loader).

``src_id`` is unique over all load batches: every batch owns a range of ids, kept as
one entry per batch in a ledger, and inside the batch a row's id is the batch's
first id plus the rows of earlier files (by full path) plus its position in its own
file. Loading a batch again gives the same ids. The mark is written before the rows, so
a load that fails in between only leaves a reserved range behind.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import TableStore

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in
                           ["person_name", "spending_date", "category", "amount", "location", "description",
                            "payment_method"]])
SOURCE, MARKS = "src_daily_spending", "src_load_marks"


def file_position(files: DataFrame) -> DataFrame:
    """Expose the file's path and the row's position inside its file."""
    return files.select("*", F.col("_metadata.file_path").alias("source_file"),
                        F.col("_metadata.row_index").alias("_row"))


def with_ids(rows: DataFrame, first_id: int | Column) -> DataFrame:
    """``src_id`` = first_id + rows of earlier files + position. The window runs over one
    row per file, the listing that planning the scan holds anyway, and these go to the rows: the
    rows stay where they are read."""
    counts = rows.groupBy("source_file").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("source_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("source_file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    return (rows.join(F.broadcast(offsets), "source_file")
            .withColumn("src_id", (F.lit(first_id) + F.col("_off") + F.col("_row")).cast("bigint")).drop("_off", "_row"))


def reserve_ids(store: TableStore, batch_id: str, rows: int) -> int:
    """First id of the batch's range. A batch that is loaded again keeps its range, unless it has grown past
    it; any other batch starts after the highest reserved id. Loaders that start together get ranges of
    their own: each entry of the ledger is taken once."""
    marks = store.ledger(MARKS)

    def mark(last):
        known = marks.entries() if last else []
        own = next((m for m in reversed(known) if m["load_batch_id"] == batch_id), None)
        if own and rows <= own["row_count"]:
            return None
        first = max((m["first_id"] + m["row_count"] for m in known), default=1)
        return {"first_id": first, "row_count": rows, "load_batch_id": batch_id}

    marks.append(mark)
    return id_ranges(store, batch_id)[-1][0]


def id_ranges(store: TableStore, batch_id: str) -> list[tuple[int, int]]:
    """(first id, first id after it) of the ranges that a batch has reserved, the newest last."""
    return [(m["first_id"], m["first_id"] + m["row_count"]) for m in store.ledger(MARKS).entries()
            if m["load_batch_id"] == batch_id]


def landed(rows: DataFrame, batch_id: str, loaded_at, source_file: str | None = None) -> DataFrame:
    """Rows with ids in the columns of the source table."""
    name = F.col("source_file") if source_file is None else F.lit(source_file)
    return rows.select("src_id", *RAW_SCHEMA.fieldNames(), name.alias("source_file"),
                       F.lit(loaded_at).cast("timestamp_ntz").alias("loaded_at"), F.lit(batch_id).alias("load_batch_id"))


def load_batch(store: TableStore, path: str, batch_id: str, loaded_at: _dt.datetime, source_file: str | None = None) -> None:
    """Load all files under ``path`` as one batch partition of the source table."""
    spark: SparkSession = store.spark
    raw = file_position(spark.read.schema(RAW_SCHEMA).parquet(path))
    first = reserve_ids(store, batch_id, raw.count())
    store.append_partition(landed(with_ids(raw, first), batch_id, loaded_at, source_file), SOURCE, ["load_batch_id"])
