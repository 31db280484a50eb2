"""Marts refreshed by changed months equal marts built in full, and read those months only."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import lineage as L
from ledgerlake.operators import maintenance as MT
from ledgerlake.operators import refresh as RF
from ledgerlake.plans.pipeline import Spend
from ledgerlake.sources.fixture import adapter_config
from ledgerlake.sources.tables import TableStore, run_folder

SF_SMALL = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(*sorted(df.columns)).collect())


@pytest.mark.parametrize("change", ["months", "class", "nothing"])
def test_refreshed_marts_equal_full_ones(spark, change):
    cfg, store = adapter_config(), TableStore(spark, run_folder(spark))
    complete = Spend(spark, SF_SMALL, cfg, store).complete
    if change == "months":  # rows of two months come later
        before = complete.filter("NOT (spending_year = 1996 AND spending_month = 3) AND NOT (spending_year = 1997 AND spending_month = 11 AND src_id % 2 = 0)")
    elif change == "class":
        before = complete.withColumn("category_group", F.when(F.expr("spending_year = 1995 AND spending_month = 1 AND category_name = 'Food'"),
                                                              F.lit("Other")).otherwise(F.col("category_group")))
    else:
        before = complete
    assert MT.publish_next(store, before, dt.date(2025, 10, 1), cfg) == 1
    for name, build in L.MARTS.items():
        MT.publish_mart(store, name, RF.mart_of(store, name, MT.read_version(store, 1), build, 1, cfg))
    assert MT.publish_next(store, complete, dt.date(2025, 10, 2), cfg) == 2
    months = {"months": {1996 * 12 + 3, 1997 * 12 + 11}, "class": {1995 * 12 + 1}, "nothing": set()}[change]
    assert RF.changed_months(store, 1, 2) == months
    rows = MT.read_version(store, 2)
    for name, build in L.MARTS.items():
        got = RF.mart_of(store, name, rows, build, 2, cfg)
        assert _rows(got) == _rows(build(rows, cfg)), name
        plan = got._jdf.queryExecution().executedPlan().toString()
        if change == "months":
            assert "GreaterThanOrEqual(spending_date,1995-03-01)" in plan or "1995-03-01" in plan.split("PushedFilters")[1], name


def test_marts_of_a_second_run_are_refreshed(spark):
    """A second run on the same store carries the months over that did not change."""
    root = run_folder(spark)
    a = Spend(spark, SF_SMALL, adapter_config(), TableStore(spark, root))
    full = _rows(a.pa.drop("snapshot_version_source"))
    later = adapter_config(snapshot_dates=(dt.date(2025, 10, 22), dt.date(2025, 10, 23)))
    b = Spend(spark, SF_SMALL, later, TableStore(spark, root))
    assert _rows(b.pa.drop("snapshot_version_source")) == full
    assert RF.changed_months(b.store, 2, 4) == set()
