"""Physical-plan properties that matter at scale."""

from ledgerlake.sources.fixture import adapter_config
from ledgerlake.plans.pipeline import Spend
from ledgerlake.sources.tables import TableStore, run_folder

SF_SMALL = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_staging_is_one_projection(spark):
    p = _plan(Spend(spark, SF_SMALL, adapter_config(), TableStore(spark, run_folder(spark))).stg.select("src_id", "amount_cleaned", "spending_date"))
    assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_latest_prunes_partitions_and_marts_read_few_columns(spark):
    s = Spend(spark, SF_SMALL, adapter_config(), TableStore(spark, run_folder(spark)))
    p = _plan(s.latest.select("amount_cleaned"))
    assert "PartitionFilters: [isnotnull(snapshot_version" in p
    assert "ReadSchema: struct<amount_cleaned:decimal(12,2)>" in p


def test_month_filter_is_pushed_and_medians_need_no_value_maps(spark):
    from ledgerlake.operators import marts as M
    s = Spend(spark, SF_SMALL, adapter_config(), TableStore(spark, run_folder(spark)))
    for column, value in (("spending_year", 2001), ("spending_month", 8)):
        assert f"EqualTo({column},{value})" in _plan(s.latest.filter(f"{column} = {value}").select("amount_cleaned"))
    p = _plan(M.person_analytics(s.latest, s.cfg))
    assert "percentile" not in p and "collect_set(location_name" not in p and "collect_set(payment" not in p


def test_a_root_is_needed(spark):
    import pytest
    from ledgerlake.sources import tables

    class Bare:
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})()
        sparkContext = type("S", (), {"getConf": staticmethod(lambda: {}), "getCheckpointDir": staticmethod(lambda: None)})()

    with pytest.raises(ValueError):
        tables.run_folder(Bare())
