"""Table storage: partitioned Parquet tables under one shared root folder.

The root is the cluster's ``spark.checkpoint.dir``, a file system every executor can
reach. Without that setting there is no safe default, so an error is raised; a local
program (tests, bench) names its own folder with ``use_root``.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .ledger import Ledger


def configured_root(spark: SparkSession) -> str | None:
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
            or spark.sparkContext.getCheckpointDir())


def shared_root(spark: SparkSession) -> str:
    root = configured_root(spark)
    if not root:
        raise ValueError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
    return root.rstrip("/")


def use_root(spark: SparkSession, folder: str) -> str:
    """Take ``folder`` as the session's root where none is configured."""
    if not configured_root(spark):
        spark.sparkContext.setCheckpointDir(folder)
    return shared_root(spark)


def file_marks(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, size, modification time) of the files under ``path``, from a listing."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(p, True)
    out = []
    while found.hasNext():
        f = found.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(out)


def run_folder(spark: SparkSession) -> str:
    """A fresh folder for one run's tables under the shared root."""
    return f"{shared_root(spark)}/ledgerlake-{uuid.uuid4().hex[:12]}"


class Conflict(RuntimeError):
    """Another writer has replaced a partition since it was read."""


class TableStore:
    """Tables that runs write, each a folder of written data and a ledger of manifests.

    A write puts its rows into a folder of its own, ``<table>/written=<mark>/[col=value/]``, and then
    adds a manifest that names the folders that are the table now: one step, after which readers see
    the new rows, and before which they see the old ones. A write that fails leaves the table as it
    was. Writes of a partitioned table replace the partitions they hold and carry the others over,
    also those that another writer has added meanwhile. What no manifest names any more stays for
    readers that began earlier, until ``vacuum``.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def ledger(self, name: str) -> Ledger:
        """A ledger of its own under ``name``; ``read`` gives its entries as rows."""
        return Ledger(self.spark, f"{self.path(name)}/entries")

    def _commits(self, name: str) -> Ledger:
        return Ledger(self.spark, f"{self.path(name)}/commits")

    def manifest(self, name: str) -> dict | None:
        """schema, parts ({"col=value": folder}; one part "" without partitions), by, buckets."""
        return self._commits(name).last()[1]

    def version(self, name: str) -> int:
        """Number of the newest manifest, for ``write(..., base=...)``."""
        return self._commits(name).last()[0]

    def _commit(self, name: str, change) -> None:
        """Add the manifest that ``change`` makes of the newest one."""
        self._commits(name).append(lambda last: change(last or {"parts": {}}))

    def write(self, df: DataFrame, name: str, partition_by=None, base: int | None = None, parts=None, properties=None) -> None:
        """Replace the table or, of a partitioned one, the partitions that ``df`` has rows of (parts: these, also
        where no row is left). base: the manifest that ``df`` was read from; a Conflict is raised if another
        writer has replaced one of the partitions since. properties: kept with the table."""
        by = list(partition_by or [])
        before = self._commits(name).entry(base)["parts"] if base else {}
        folder = f"written={uuid.uuid4().hex}"
        w = df.write.option("compression", "snappy")
        (w.partitionBy(*by) if by else w).parquet(f"{self.path(name)}/{folder}")
        if by:
            fs, pattern = self._fs(f"{self.path(name)}/{folder}/{'/'.join('*=*' for _ in by)}")
            found = ["/".join(s.getPath().toString().split("/")[-len(by):]) for s in fs.globStatus(pattern) or []]
        else:
            found = [""]
        new = {p: f"{folder}/{p}".rstrip("/") for p in found}
        replaced = {*found, *(parts or [])}
        schema = df.schema.jsonValue()

        def change(last):
            if base is not None and any(last["parts"].get(p) != before.get(p) for p in replaced):
                raise Conflict(name)
            kept = {p: f for p, f in last["parts"].items() if by and p not in replaced}
            return {"schema": schema, "by": by, "parts": kept | new, "properties": last.get("properties", {}) | (properties or {})}

        self._commit(name, change)

    def write_part(self, df: DataFrame, name: str, column: str, value, buckets: tuple[str, str, int] | None = None,
                   properties=None) -> None:
        """Replace the partition column = value by ``df``, which has that value in all rows and keeps its order.
        buckets: (id column, sort column, number): rows are dealt to one file per bucket of the id; the
        table keeps the number it has from its first partition on."""
        folder = f"written={uuid.uuid4().hex}"
        part, path = f"{column}={value}", f"{self.path(name)}/{folder}/{column}={value}"
        out = df.drop(column)
        if buckets:
            key, order, n = buckets
            scratch = f"write_{uuid.uuid4().hex}"
            (out.repartition(n, key).write.option("compression", "snappy").bucketBy(n, key).sortBy(order)
             .option("path", path).format("parquet").saveAsTable(scratch))
            self.spark.sql(f"DROP TABLE {scratch}")  # the files stay
        else:
            out.write.option("compression", "snappy").parquet(path)
        schema = df.schema.jsonValue()
        self._commit(name, lambda last: {"schema": schema, "by": [column], "parts": {**last["parts"], part: f"{folder}/{part}"},
                                         "buckets": list(buckets) if buckets else None, "properties": last.get("properties", {}) | (properties or {})})

    def read(self, name: str, parts=None) -> DataFrame:
        """The table as its newest manifest has it (parts: of these partitions only). A ledger gives its entries."""
        number, manifest = self._commits(name).last()
        if manifest is None:
            fs, entries = self._fs(f"{self.path(name)}/entries")
            return self.spark.read.json(entries.toString()) if fs.exists(entries) else self.spark.read.parquet(self.path(name))
        live = {p: f for p, f in manifest["parts"].items() if parts is None or p in parts}
        schema = T.StructType.fromJson(manifest["schema"])
        if not live:
            return self.spark.createDataFrame([], schema)
        if manifest.get("buckets") and parts is None:
            return self._bucketed(name, number, manifest, schema)
        data = [f for f in schema.fields if f.name not in manifest["by"]]
        keys = [schema[c] for c in manifest["by"]]
        return (self.spark.read.schema(T.StructType([*data, *keys, T.StructField("written", T.StringType())]))
                .option("basePath", self.path(name)).parquet(*[f"{self.path(name)}/{f}" for f in live.values()]).drop("written"))

    def _bucketed(self, name: str, number: int, manifest: dict, schema: T.StructType) -> DataFrame:
        """The live partitions as a table of the session's catalog, where Spark knows the buckets: joins and
        aggregations by the id need no shuffle."""
        key, order, n = manifest["buckets"]
        (by,) = manifest["by"]
        table = f"t_{hashlib.md5(f'{self.path(name)}/{number}'.encode()).hexdigest()}"
        if not self.spark.catalog.tableExists(table):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*[f for f in schema if f.name != by], schema[by]])
            self.spark.sql(f"CREATE TABLE {table} ({columns}, written STRING) USING parquet PARTITIONED BY (written, `{by}`) "
                           f"CLUSTERED BY (`{key}`) SORTED BY (`{order}`) INTO {n} BUCKETS LOCATION '{self.path(name)}'")
            live = " ".join(f"PARTITION (written='{f.split('/')[0].split('=')[1]}', `{by}`='{p.split('=', 1)[1]}')"
                            for p, f in manifest["parts"].items())
            self.spark.sql(f"ALTER TABLE {table} ADD {live}")
        return self.spark.table(table).drop("written")

    def exists(self, name: str) -> bool:
        """Whether the table or ledger has been written."""
        fs, p = self._fs(f"{self.path(name)}/entries")
        return self.manifest(name) is not None or fs.exists(p)

    def materialize(self, name: str, build, partition_by=None) -> DataFrame:
        self.write(build(), name, partition_by=partition_by)
        return self.read(name)

    def partition_values(self, name: str, column: str) -> list[str]:
        """Values of a table's partition column, from its manifest; empty if there is no such table."""
        parts = (self.manifest(name) or {"parts": {}})["parts"]
        return sorted({v for p in parts for c, v in [x.split("=", 1) for x in p.split("/") if "=" in x] if c == column})

    def max_partition_value(self, name: str, column: str) -> int | None:
        """Newest version of a table whose partitions are numbered; None without any."""
        return max(map(int, self.partition_values(name, column)), default=None)

    def append_partition(self, df: DataFrame, name: str, partition_by) -> None:
        """Add or replace the partitions of ``df`` (a load batch, a version): a retry replaces just those."""
        self.write(df, name, partition_by=partition_by)

    def drop_partitions(self, name: str, column: str, values) -> list:
        """Delete whole partitions (retention, bad load batch): first the manifest without them, then their
        folders. Returns the deleted paths."""
        gone = {f"{column}={v}" for v in values}
        held = (self.manifest(name) or {"parts": {}})["parts"]
        folders = [f for p, f in held.items() if gone & set(p.split("/"))]
        if folders:
            self._commit(name, lambda last: {**last, "parts": {p: f for p, f in last["parts"].items() if not gone & set(p.split("/"))}})
        deleted = []
        for folder in folders:
            fs, p = self._fs(f"{self.path(name)}/{folder}")
            fs.delete(p, True)
            deleted.append(p.toString())
        return deleted

    def vacuum(self, name: str) -> list[str]:
        """Delete what the newest manifest does not name (earlier and failed writes). Not while a write runs."""
        live = set(self.manifest(name)["parts"].values())
        fs, p = self._fs(self.path(name))
        deleted = []
        for s in fs.listStatus(p):
            mark = s.getPath().getName()
            if not mark.startswith("written="):
                continue
            kept = {f for f in live if f.split("/")[0] == mark}
            if not kept:
                fs.delete(s.getPath(), True)
                deleted.append(mark)
                continue
            for part in fs.listStatus(s.getPath()) if mark not in kept else []:
                folder = f"{mark}/{part.getPath().getName()}"
                if part.isDirectory() and not any(f.startswith(folder) for f in kept):
                    fs.delete(part.getPath(), True)
                    deleted.append(folder)
        return sorted(deleted)

    def drop(self) -> None:
        """Delete the whole folder of this store."""
        fs, p = self._fs(self.root)
        if fs.exists(p):
            fs.delete(p, True)
