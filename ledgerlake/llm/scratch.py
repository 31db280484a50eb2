"""Lineage cuts and size-checked broadcasts shared by the operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sources.tables import run_folder

BROADCAST_ROWS = 1_000_000  # narrow key tables up to this many rows may be broadcast


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the session's shared checkpoint folder and
    read it back: a lost executor recomputes from these files, not from the start."""
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{name}-{uuid.uuid4().hex[:8]}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(df: DataFrame, *kept: str) -> DataFrame:
    """``kept`` columns, and all others in one struct column, where their names cannot
    clash with those that an operator adds."""
    others = [F.col(c) for c in df.columns if c not in kept]
    return df.select(*[c for c in kept if c in df.columns], F.struct(F.lit(0).alias("_"), *others).alias("_others"))


def unpacked(df: DataFrame, columns: list[str], *kept: str) -> DataFrame:
    """The columns of a packed table again, in the given order."""
    return df.select(*[F.col(c) if c in kept else F.col("_others")[c].alias(c) for c in columns])


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if a count proves that it has at most ``rows``
    rows; else unchanged, so that Spark joins it by a shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def blocks_log2(spark: SparkSession) -> int:
    """log2 of the number of hash blocks: four for each shuffle partition at least."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions")) * 4
    return min(22, max(4, (n - 1).bit_length()))
