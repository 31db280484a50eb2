"""Tables behind manifests, ledgers, lasting dimensions, concurrent publishers, deleting a batch with its rows."""

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import dimensions as D
from ledgerlake.operators import lineage as L
from ledgerlake.operators import maintenance as MT
from ledgerlake.plans.pipeline import Spend
from ledgerlake.sources import fixture
from ledgerlake.sources.fixture import adapter_config
from ledgerlake.sources.ledger import Ledger
from ledgerlake.sources.raw_files import SOURCE, id_ranges, reserve_ids
from ledgerlake.sources.tables import Conflict, TableStore, run_folder

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture()
def store(spark):
    return TableStore(spark, run_folder(spark))


def _rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(*sorted(df.columns)).collect())


def _together(*jobs):
    """Run jobs at the same time; their results, or the errors they raised."""
    out, gate = [None] * len(jobs), threading.Barrier(len(jobs))

    def run(k, job):
        gate.wait()
        try:
            out[k] = job()
        except Exception as e:  # noqa: BLE001
            out[k] = e
    threads = [threading.Thread(target=run, args=x) for x in enumerate(jobs)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    return out


def test_a_number_is_taken_once(spark, store):
    ledger = Ledger(spark, f"{store.root}/numbers")
    jobs = [lambda k=k: [ledger.append(lambda last: {"k": k, "n": (last or {"n": 0})["n"] + 1})[1]["n"] for _ in range(5)] for k in range(6)]
    taken = [n for got in _together(*jobs) for n in got]
    assert sorted(taken) == list(range(1, 31)) and [e["n"] for e in ledger.entries()] == list(range(1, 31))
    assert ledger.append(lambda last: None) == (30, ledger.entries()[-1])


def test_a_failed_write_leaves_the_table(spark, store):
    store.write(spark.range(10).withColumn("p", F.col("id") % 2), "t")
    store.write(spark.range(10).withColumn("p", F.col("id") % 2), "parted", partition_by=["p"])
    half = spark.range(1000, 1, -1, 4).withColumn("p", F.when(F.col("id") < 20, F.raise_error(F.lit("lost"))).otherwise(F.lit(0)).cast("long"))
    for name, by in (("t", None), ("parted", ["p"])):
        with pytest.raises(Exception, match="lost"):
            store.write(half, name, partition_by=by)
        assert store.read(name).count() == 10 and store.read(name).agg(F.sum("id")).first()[0] == 45
    store.write(spark.range(3).withColumn("p", F.lit(1).cast("long")), "parted", partition_by=["p"])
    assert _rows(store.read("parted").groupBy("p").count()) == [("3", "1"), ("5", "0")]
    assert len(store.vacuum("parted")) >= 1 and store.read("parted").count() == 8
    store.write(spark.range(0), "t")  # an empty reload is an empty table
    assert store.read("t").count() == 0 and store.read("t").columns == ["id"]


def test_readers_keep_what_they_began_with(spark, store):
    store.write(spark.range(10), "t")
    before = store.read("t")
    store.write(spark.range(5), "t")
    assert before.count() == 10 and store.read("t").count() == 5


def test_two_publishers_get_two_versions(spark, store):
    cfg = adapter_config()
    complete = Spend(spark, SF_SMALL, cfg, store).complete
    days = [dt.date(2025, 8, 1), dt.date(2025, 8, 2), dt.date(2025, 8, 1)]
    got = _together(*[lambda d=d: MT.publish_next(store, complete, d, cfg) for d in days])
    assert sorted(set(got)) == [1, 2] and got[0] == got[2] != got[1]  # a date has one version
    n = complete.count()
    assert _rows(store.read(MT.CURATED).groupBy("snapshot_version").count()) == [(str(n), "1"), (str(n), "2")]
    assert MT.publish_next(store, complete, dt.date(2025, 8, 3), cfg) == 3


def test_two_loaders_get_ranges_of_their_own(store):
    firsts = _together(*[lambda k=k: reserve_ids(store, f"LOAD_{k}", 100) for k in range(4)])
    assert sorted(firsts) == [1, 101, 201, 301]
    assert reserve_ids(store, "LOAD_2", 80) == firsts[2]  # a smaller reload keeps its range
    assert reserve_ids(store, "LOAD_2", 120) == 401 and len(id_ranges(store, "LOAD_2")) == 2


def _dimension(spark, rows):
    return spark.createDataFrame(rows, "location_id long, location_name string, location_type string")


def test_second_load_merges_into_the_stored_dimension(spark, store):
    first = [(k, f"place {k}", "SHOP") for k in range(1, 41)]
    D.upsert(store, "location", _dimension(spark, first))
    folders = store.manifest("stg_dim_location")["parts"]
    second = [(900, "place 7", "FOOD"), (901, "place 8", "SHOP"), (902, "new place", "FOOD")]
    touched = D.upsert(store, "location", _dimension(spark, second))
    got = {r.location_name: (r.location_id, r.location_type) for r in D.read(store, "location").collect()}
    assert got["place 7"] == (7, "FOOD") and got["place 8"] == (8, "SHOP") and got["new place"] == (902, "FOOD") and len(got) == 41
    after = store.manifest("stg_dim_location")["parts"]
    assert 1 <= len(touched) <= 2 and {p for p in after if after[p] != folders.get(p)} == {f"bucket={b}" for b in touched}
    for p in set(folders) - {f"bucket={b}" for b in touched}:  # the files of other buckets are the same
        assert os.path.isdir(f"{store.path('stg_dim_location')}/{folders[p]}".replace("file:", ""))
    at = store.version("stg_dim_location")
    assert D.upsert(store, "location", _dimension(spark, second)) == [] and store.version("stg_dim_location") == at  # a retry
    nulled = D.upsert(store, "location", _dimension(spark, [(1, "place 1", None)]))
    assert len(nulled) == 1 and D.read(store, "location").filter("location_type IS NULL").count() == 1
    D.shrink(store, "location", _dimension(spark, first[:5]))
    assert {r.location_name for r in D.read(store, "location").collect()} == {f"place {k}" for k in range(1, 6)}
    assert D.upsert(store, "location", _dimension(spark, [])) == []


def test_loads_that_merge_at_once_lose_nothing(spark, store):
    D.upsert(store, "person", spark.createDataFrame([(1, "a")], "person_id long, person_name string"), buckets=1)
    loads = [spark.createDataFrame([(10 + k, f"p{k}")], "person_id long, person_name string") for k in range(3)]
    _together(*[lambda d=d: D.upsert(store, "person", d) for d in loads])
    assert {r.person_name for r in D.read(store, "person").collect()} == {"a", "p0", "p1", "p2"}
    with pytest.raises(Conflict):
        store.write(loads[0].withColumn("bucket", F.lit(0)), "stg_dim_person", partition_by=["bucket"], base=1)


def test_a_deleted_batch_was_never_loaded(spark, store):
    """After the delete no table has a row of the batch; all equal a run without it."""
    cfg = adapter_config()
    whole = Spend(spark, SF_SMALL, cfg, store)
    marts = ("mss", "ct", "pa", "ps")
    for m in marts:
        getattr(whole, m).count()
    whole.profile_states.count()
    batch = fixture.BATCHES[1][0]
    (lo, hi), = id_ranges(store, batch)
    assert store.read(SOURCE).filter(F.col("src_id").between(lo, hi - 1)).count() > 0
    done = L.delete_batch(store, batch, cfg)
    assert done[MT.CURATED] == [1, 2] and len(done["stg_spending_complete"]) == 1
    for table in (SOURCE, "stg_transformed", "stg_fact_spending", "stg_spending_complete", MT.CURATED):
        assert store.read(table).filter(F.col("src_id").between(lo, hi - 1)).count() == 0, table
    never = Spend(spark, SF_SMALL, cfg, TableStore(spark, run_folder(spark)), batches=fixture.BATCHES[:1])
    for name, df in (("stg_transformed", never.stg), ("stg_fact_spending", never.fact), ("stg_spending_complete", never.complete)):
        assert _rows(store.read(name)) == _rows(df), name
    for d in ("person", "location", "category", "payment_method"):
        assert _rows(D.read(store, d)) == _rows(never.dims[d]), d
    assert _rows(MT.read_snapshots(store)) == _rows(never.curated)
    for m, table in zip(marts, L.MARTS, strict=True):
        assert _rows(MT.read_mart(store, table)) == _rows(getattr(never, m)), table
    again = L.delete_batch(store, batch, cfg)  # a repeated delete finds nothing
    assert again[MT.CURATED] == [] and not any(again[t] for t in L.MARTS)
    held = " ".join(r for r, _, _ in os.walk(store.root.replace("file:", "")))
    assert f"src_daily_spending/written={done}" not in held and held.count(batch) == held.count(f"raw/{batch}")


def test_deleting_the_only_batch_empties_the_chain(spark, store):
    cfg = adapter_config()
    only = Spend(spark, SF_SMALL, cfg, store, batches=fixture.BATCHES[:1])
    only.ps.count()
    L.delete_batch(store, fixture.BATCHES[0][0], cfg)
    for table in (SOURCE, "stg_fact_spending", MT.CURATED, "dst_payment_method_summary"):
        assert store.read(table).count() == 0, table
    assert D.read(store, "person").count() == 0
