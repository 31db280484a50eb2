"""Parquet footers, read where the executors are: row groups and their statistics without a scan.

The listing is Spark's own (``binaryFile`` without its content column); each task opens the
files of its share through Arrow and reads their footers only. Arrow opens local and HDFS
paths and object stores by their URI; of a scheme that it does not know an error says so.
"""

from __future__ import annotations

import sys
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package
GROUPS = ("file_path string, file_size_bytes long, row_group int, row_count long, total_bytes long, "
          "columns array<struct<name: string, bytes: long, nulls: long, min: string, max: string>>")


def _metadata(path: str):
    import pyarrow.fs
    import pyarrow.parquet as pq
    if path.startswith("file:"):
        return pq.read_metadata("/" + path[5:].lstrip("/"))
    system, inner = pyarrow.fs.FileSystem.from_uri(path)
    with system.open_input_file(inner) as f:
        return pq.ParquetFile(f).metadata


def _text(value) -> str | None:
    return value.decode("utf-8", "replace") if isinstance(value, bytes) else None if value is None else str(value)


def _groups(batches):
    for batch in batches:
        for path, size in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist()):
            meta = _metadata(path)
            out = []
            for g in range(meta.num_row_groups):
                group = meta.row_group(g)
                columns = []
                for c in range(group.num_columns):
                    chunk = group.column(c)
                    s = chunk.statistics
                    known = s is not None and s.has_min_max
                    columns.append((chunk.path_in_schema, chunk.total_compressed_size,
                                    s.null_count if s is not None and s.has_null_count else None,
                                    _text(s.min) if known else None, _text(s.max) if known else None))
                names = ("name", "bytes", "nulls", "min", "max")
                out.append((path, size, g, group.num_rows, group.total_byte_size, [dict(zip(names, c)) for c in columns]))
            if out:
                kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.struct(
                    [("name", pa.string()), ("bytes", pa.int64()), ("nulls", pa.int64()), ("min", pa.string()), ("max", pa.string())])))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                                 names=["file_path", "file_size_bytes", "row_group", "row_count", "total_bytes", "columns"])


def row_groups(spark: SparkSession, path: str) -> DataFrame:
    """One row per row group of the Parquet files under ``path`` (files without rows have none)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
             .load(path).select("path", "length"))
    return files.mapInArrow(_groups, GROUPS)


def batch_row_groups(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """``row_groups`` of the raw files of several load batches, with the batch."""
    return reduce(DataFrame.unionByName, [row_groups(spark, path).withColumn("load_batch_id", F.lit(batch)) for batch, path in paths.items()])
