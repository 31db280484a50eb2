"""Incremental ingest (A90): load every new raw file exactly once.

A file-source stream with ``trigger(availableNow=True)`` and a checkpoint remembers
which files were consumed; each micro-batch becomes one load batch: it reserves a range
of ids in the mark table (one row per batch, so a batch never scans the table it adds
to) and replaces only its own partition. A batch that is retried, after a lost executor
or a driver restart, keeps its range and rewrites the same partition. Errors of the
storage are raised, never taken for a missing table. No watermark or state is needed:
the stream is append-only files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.raw_files import RAW_SCHEMA, SOURCE, file_position, landed, reserve_ids, with_ids
from ..sources.tables import TableStore


def _batch_writer(root: str, loaded_at):
    def write(batch: DataFrame, number: int) -> None:
        store = TableStore(batch.sparkSession, root)
        name = f"LOAD_STREAM_{number:06d}"
        first = reserve_ids(store, name, batch.count())
        store.append_partition(landed(with_ids(batch, first), name, loaded_at), SOURCE, ["load_batch_id"])
    return write


def incremental_ingest(spark: SparkSession, source_dir: str, root: str, checkpoint: str, loaded_at,
                       max_files_per_batch: int = 1000) -> None:
    """Run until every file currently in ``source_dir`` has been loaded once into the
    source table under ``root``; ``max_files_per_batch`` is the size of a micro-batch."""
    stream = file_position(spark.readStream.schema(RAW_SCHEMA).option("maxFilesPerTrigger", max_files_per_batch)
                           .parquet(source_dir))
    q = (stream.writeStream.foreachBatch(_batch_writer(root, loaded_at))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
