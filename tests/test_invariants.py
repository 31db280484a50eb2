"""Pipeline invariants: reconciliations, shares, reruns, shuffle-free staging."""

from pyspark.sql import functions as F

from ledgerlake.sources.fixture import adapter_config
from ledgerlake.operators import curated as U
from ledgerlake.operators import quality as Q
from ledgerlake.operators import staging as G
from ledgerlake.plans.pipeline import Spend
from ledgerlake.sources.tables import TableStore, run_folder

SF = "/root/testdata/sf0.01"


def _stored(spark):
    return Spend(spark, SF, adapter_config(), TableStore(spark, run_folder(spark)))


def test_verdicts_and_shares(spark):
    s = _stored(spark)
    assert Q.dv_verdict(s.latest, s.mss, s.ct, s.pa, s.ps).first().validation_passed
    cv = U.cv_verdict(s.curated, s.latest, s.fact, s.cfg).first()
    assert cv.validation_passed, cv.issues
    shares = s.ct.groupBy("year", "month").agg(F.sum("percent_of_total_spending").alias("p"),
                                               F.count(F.lit(1)).alias("n"))
    off = shares.filter(F.abs(F.col("p") - 100) > F.col("n") * 0.005).count()
    assert off == 0
    assert s.curated.filter("is_latest = 1").select("snapshot_version").distinct().count() == 1


def test_rerun_gives_same_marts(spark):
    a, b = _stored(spark), _stored(spark)
    for x, y in ((a.mss, b.mss), (a.pa, b.pa), (a.ps, b.ps)):
        assert x.drop("created_at", "updated_at").exceptAll(y.drop("created_at", "updated_at")).count() == 0
        assert x.count() == y.count()


def test_staging_over_stored_source_has_no_shuffle(spark):
    s = _stored(spark)
    plan = G.stg_transform(s.src, s.cfg)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
