"""Input-file profile against pyarrow footers and file sizes of the raw files."""

import glob
import os

import pyarrow.parquet as pq

from pyspark.sql import functions as F

from ledgerlake.operators import ingest as N
from ledgerlake.sources import fixture
from ledgerlake.sources.fixture import adapter_config
from ledgerlake.sources.footers import row_groups
from ledgerlake.plans.pipeline import Spend
from ledgerlake.plans.registry import JOBS
from ledgerlake.sources.raw_files import RAW_SCHEMA, load_batch
from ledgerlake.sources.tables import TableStore, run_folder

SF_SMALL = "/root/testdata/sf0.001"


def test_profile_file_matches_footers(spark):
    s = Spend(spark, SF_SMALL, adapter_config(), TableStore(spark, run_folder(spark)))
    files = {b: glob.glob(p.replace("file:", "") + "/*.parquet") for p, (b, _) in zip(s.raw_paths, s.batches)}
    metas = {b: {os.path.basename(f): pq.ParquetFile(f).metadata for f in fs} for b, fs in files.items()}
    assert len(files) == 2
    got = JOBS["profile_file"](s).collect()
    assert {(r.load_batch_id, r.total_rows) for r in got} == {(b, sum(m.num_rows for m in ms.values())) for b, ms in metas.items()}
    for b in metas:
        mine = sorted((r for r in got if r.load_batch_id == b), key=lambda r: r.ordinal)
        assert [r.column_name for r in mine] == RAW_SCHEMA.fieldNames()
    sizes = {(r.load_batch_id, os.path.basename(r.file_path)): (r.row_count, r.file_size_bytes, r.num_row_groups)
             for r in JOBS["profile_file_sizes"](s).collect()}
    assert sizes == {(b, os.path.basename(f)): (m.num_rows, os.path.getsize(f), m.num_row_groups)
                     for b, fs in files.items() for f in fs for m in [metas[b][os.path.basename(f)]] if m.num_rows}


def test_row_groups_come_from_footers(spark):
    """Files of many row groups: one row each with the footer's statistics, and no column is scanned."""
    path = f"{run_folder(spark)}/groups"
    spark.range(30_000).select("id", F.concat(F.lit("é"), F.col("id")).alias("name"), F.when(F.col("id") % 3 == 0, 1).alias("third")) \
        .coalesce(2).write.option("parquet.block.size", 20_000).option("parquet.page.size.row.check.min", 10).parquet(path)
    got = row_groups(spark, path)
    rows = {(os.path.basename(r.file_path), r.row_group): r for r in got.collect()}
    want = {}
    for f in glob.glob(path.replace("file:", "") + "/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            want[os.path.basename(f), g] = meta.row_group(g)
    assert set(rows) == set(want) and len(want) > 4
    for k, g in want.items():
        assert (rows[k].row_count, rows[k].total_bytes) == (g.num_rows, g.total_byte_size)
        by_name = {c.name: c for c in rows[k].columns}
        assert int(by_name["id"].min) == g.column(0).statistics.min and by_name["third"].nulls == g.column(2).statistics.null_count
        assert by_name["name"].max.startswith("é")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,length:bigint>" in plan  # a listing: no contents


def test_profiles_add_up_batch_by_batch(spark):
    """A batch is scanned once; merged states equal a profile of all rows; a batch loaded anew is scanned again."""
    store = TableStore(spark, run_folder(spark))
    s = Spend(spark, SF_SMALL, adapter_config(), store)
    both = N.profile_columns(s.profile_states)
    whole = N.profile_columns(N.profile_state(s.src))
    assert sorted(map(str, both.collect())) == sorted(map(str, whole.collect()))
    exact = s.src.agg(*[F.countDistinct(c).alias(c) for c in ["src_id", *N.RAW_TEXT]]).first().asDict()
    for r in N.profile_distinct(s.profile_states).collect():
        assert abs(r.distinct_values - exact[r.column_name]) <= max(1, 0.05 * exact[r.column_name])
    at = store.version(N.STATES)
    N.store_profiles(store)
    assert store.version(N.STATES) == at  # nothing new: nothing written
    load_batch(store, s.raw_paths[0], s.batches[0][0], s.batches[0][1], fixture.RAW_NAME)
    N.store_profiles(store)
    assert store.version(N.STATES) == at + 1
