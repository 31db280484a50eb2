"""The end-to-end plan: raw files -> source -> staging -> snapshots -> marts.

``Spend`` writes every stage once as Parquet under a shared folder and reads it back,
which cuts lineage the way a production run does: reports scan small marts, and a lost
executor recomputes from the last written table. Snapshots and marts are partitioned by
version and last from run to run if runs share a store.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..operators import checks as K
from ..operators import dimensions as D
from ..operators import ingest as N
from ..operators import maintenance as MT
from ..operators import marts as M
from ..operators import refresh as RF
from ..operators import staging as G
from ..sources import fixture
from ..sources.footers import batch_row_groups
from ..sources.raw_files import RAW_SCHEMA, SOURCE, load_batch
from ..sources.tables import TableStore

BY_BATCH = ["load_batch_id"]  # the lineage of source and staging tables


class Spend:
    """batches: the load batches that this run loads, in loading order (all by default)."""

    def __init__(self, spark: SparkSession, sf_dir: str, cfg: Config, store: TableStore, batches=None):
        self.batches = list(batches or fixture.BATCHES)
        self.spark = spark
        self.sf_dir = sf_dir
        self.cfg = cfg
        self.store = store

    # -- helpers -----------------------------------------------------------
    def _stage(self, name: str, build, partition_by=None) -> DataFrame:
        return self.store.materialize(name, build, partition_by=partition_by)

    @cached_property
    def tables(self) -> dict:
        return fixture.load_tables(self.spark, self.sf_dir)

    # -- source and staging ------------------------------------------------
    @cached_property
    def raw(self) -> DataFrame:
        return fixture.raw_spending(self.tables)

    @cached_property
    def raw_paths(self) -> list[str]:
        """The raw files of each load batch, as a deployment receives them."""
        return fixture.write_raw_files(self.raw, self.store.root, self.batches)

    @cached_property
    def offered(self) -> DataFrame:
        """(load_batch_id, file_rows): rows in the raw files of each batch."""
        counts = [self.spark.read.schema(RAW_SCHEMA).parquet(path).agg(F.count(F.lit(1)).alias("file_rows"))
                  .select(F.lit(batch).alias("load_batch_id"), "file_rows")
                  for path, (batch, _) in zip(self.raw_paths, self.batches, strict=True)]
        return reduce(DataFrame.unionByName, counts)

    @cached_property
    def src(self) -> DataFrame:
        for path, (batch, loaded_at) in zip(self.raw_paths, self.batches, strict=True):
            load_batch(self.store, path, batch, loaded_at, fixture.RAW_NAME)
        return self.store.read(SOURCE)

    @cached_property
    def profile_states(self) -> DataFrame:
        """Partial profiles per load batch, kept; a batch is scanned once."""
        _ = self.src  # loaded first
        return N.store_profiles(self.store)

    @cached_property
    def row_groups(self) -> DataFrame:
        """Footers of the raw files of all batches."""
        return batch_row_groups(self.spark, {batch: path for path, (batch, _) in zip(self.raw_paths, self.batches, strict=True)})

    @cached_property
    def stg(self) -> DataFrame:
        """Cleaned and classified rows (loadable and rejected). Stored once, so
        the text parsing runs once per row and downstream filters on the parse
        flags become Parquet pushdowns."""
        return self._stage("stg_transformed", lambda: G.stg_transform(self.src, self.cfg), partition_by=BY_BATCH)

    @cached_property
    def dim_pairs(self) -> DataFrame:
        return self._stage("stg_dim_pairs", lambda: G.dimension_pairs(self.stg), partition_by=BY_BATCH)

    @cached_property
    def dims(self) -> dict:
        """The stored dimensions after this load's names are merged in."""
        for d in G.DIM_SPECS:
            D.upsert(self.store, d, G.dimension(self.dim_pairs, d))
        return {d: D.read(self.store, d) for d in G.DIM_SPECS}

    @cached_property
    def fact(self) -> DataFrame:
        return self._stage("stg_fact_spending", lambda: G.fact_spending(self.stg, self.dims, self.cfg), partition_by=BY_BATCH)

    @cached_property
    def complete(self) -> DataFrame:
        """The fact with names and classes; stored once, every snapshot and report reads it."""
        return self._stage("stg_spending_complete", lambda: G.spending_complete(self.fact, self.dims),
                           partition_by=BY_BATCH)

    @cached_property
    def check_log(self) -> DataFrame:
        """The stored rows of the seven source checks."""
        return self.validation_log.filter(F.col("validation_run_id") == self.cfg.validation_run_id)

    @cached_property
    def validation_log(self) -> DataFrame:
        """Check log of this load and validation run (appended per run id, never truncated)."""
        return self._stage("log_validation_results", lambda: K.validation_log(self.src, self.offered, self.cfg),
                           partition_by=["validation_run_id"])

    @cached_property
    def rejects(self) -> DataFrame:
        return G.stg_rejects(self.stg)

    # -- curated -----------------------------------------------------------
    @cached_property
    def curated(self) -> DataFrame:
        """All snapshot versions; the test run publishes two, one per snapshot date."""
        for date, cutoff in zip(self.cfg.snapshot_dates, self.cfg.snapshot_cutoffs, strict=True):
            rows = self.complete if cutoff is None else self.complete.filter(F.col("spending_date") < F.lit(cutoff))
            MT.publish_next(self.store, rows, date, self.cfg)
        return MT.read_snapshots(self.store)

    @cached_property
    def latest(self) -> DataFrame:
        """Rows of the newest version: it is looked up first, so the scan prunes to it."""
        return MT.read_latest(self.curated, self.store)

    # -- marts, one partition per snapshot version they are built from ---------
    def _mart(self, name: str, build) -> DataFrame:
        rows = self.latest
        newest = self.store.max_partition_value(MT.CURATED, "snapshot_version")
        MT.publish_mart(self.store, name, RF.mart_of(self.store, name, rows, build, newest, self.cfg))
        return MT.read_mart(self.store, name)

    @cached_property
    def mss(self) -> DataFrame:
        return self._mart("dst_monthly_spending_summary", M.monthly_summary)

    @cached_property
    def ct(self) -> DataFrame:
        return self._mart("dst_category_trends", M.category_trends)

    @cached_property
    def pa(self) -> DataFrame:
        return self._mart("dst_person_analytics", M.person_analytics)

    @cached_property
    def ps(self) -> DataFrame:
        return self._mart("dst_payment_method_summary", M.payment_summary)
