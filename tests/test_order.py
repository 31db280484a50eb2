"""Reports and views come in their documented order; the rows do not depend on it."""

import pytest

from ledgerlake.plans.ordering import ORDER, SEVERITIES
from ledgerlake.plans.pipeline import Spend
from ledgerlake.plans.registry import JOBS
from ledgerlake.sources.fixture import adapter_config
from ledgerlake.sources.tables import TableStore, run_folder


@pytest.fixture(scope="module")
def run(spark):
    return Spend(spark, "/root/testdata/sf0.001", adapter_config(), TableStore(spark, run_folder(spark)))


@pytest.mark.parametrize("key", ["hq05_person", "hq06_monthly", "health_scorecard", "x_health_month", "dq_person_spending",
                                 "hq12_person_category", "lifestyle_plan"])
def test_rows_are_ordered(run, key):
    columns = ORDER[key].split()
    rows = JOBS[key](run).collect()
    assert len(rows) > 1
    for a, b in zip(rows, rows[1:], strict=False):
        for c in columns:
            x, y = a[c.lstrip("-")], b[c.lstrip("-")]
            if x != y:
                assert (x > y) if c[0] == "-" else (x < y)
                break


def test_alerts_by_severity(run):
    ranks = [SEVERITIES.index(r.alert_severity) for r in JOBS["budget_alerts"](run).collect()]
    assert ranks and ranks == sorted(ranks)


def test_every_ordered_key_has_its_columns(run):
    for key, text in ORDER.items():
        assert {c.lstrip("-") for c in text.split()} <= set(JOBS[key](run).columns), key
