"""Hand rows for prior-period, rolling, bucket and health-score rules."""

import datetime as dt
from decimal import Decimal

from ledgerlake.sources.fixture import adapter_config
from ledgerlake.operators import insights as I
from ledgerlake.operators import marts as M
from ledgerlake.operators import snapshots as S


def _latest(spark, rows):
    """rows: (date, amount, category_group, person)"""
    data = []
    for i, (d, amt, grp, person) in enumerate(rows):
        data.append((2, i, person, "Cat" + grp[:3], grp, "Loc", "Physical", "Card", "Card", d, d.year, d.month,
                     (d.month - 1) // 3 + 1, d.isoweekday(), Decimal(amt), 100))
    return spark.createDataFrame(data, "snapshot_version int, stg_spending_id long, person_name string, "
                                 "category_name string, category_group string, location_name string, "
                                 "location_type string, payment_method_name string, payment_type string, "
                                 "spending_date date, spending_year int, spending_month int, spending_quarter int, "
                                 "spending_day_of_week int, amount_cleaned decimal(12,2), data_quality_score int")


def test_mom_and_rolling(spark):
    rows = [(dt.date(2024, 1, 10), "100.00", "Essential", "A"), (dt.date(2024, 2, 10), "110.00", "Essential", "A"),
            (dt.date(2024, 4, 10), "50.00", "Essential", "A")]
    ct = {(r.month): r for r in M.category_trends(_latest(spark, rows), adapter_config()).collect()}
    assert ct[2].mom_percent_change == Decimal("10.00") and ct[2].mom_trend_direction == "INCREASING"
    assert ct[4].prev_month_spending is None and ct[4].mom_trend_direction == "NO_DATA"
    assert ct[4].rolling_3month_avg == Decimal("80.00")


def test_buckets(spark):
    rows = [(dt.date(2024, 1, d), a, "Essential", "A") for d, a in [(1, "9.99"), (2, "10.00"), (3, "100.00"),
                                                                    (4, "500.00")]]
    r = M.person_analytics(_latest(spark, rows), adapter_config()).collect()[0]
    assert (r.small_transactions_count, r.medium_transactions_count, r.large_transactions_count,
            r.xlarge_transactions_count) == (1, 1, 1, 1)
    assert r.median_transaction_amount == Decimal("55.00")


def test_health_score_100(spark):
    pa = spark.createDataFrame(
        [("A", 2024, 1, Decimal("100.00"), Decimal("35.00"), Decimal("20.00"), Decimal("35.00"), Decimal("20.00"),
          Decimal("1.75"), Decimal("-1.00"), "Food", 7, 10)],
        "person_name string, year int, month int, total_spending decimal(18,2), essential_spending decimal(18,2), "
        "discretionary_spending decimal(18,2), essential_percent decimal(18,2), discretionary_percent decimal(18,2), "
        "essential_to_discretionary_ratio decimal(18,2), mom_percent_change decimal(18,2), top_category string, "
        "unique_categories_count long, transaction_count long")
    assert I.health_scorecard(pa).collect()[0].health_score == 100


def test_version_growth(spark):
    cur = spark.createDataFrame([(v, dt.date(2025, 10, v), Decimal("1.00"))
                                 for v, n in [(1, 500), (2, 550), (3, 580)] for _ in range(n)],
                                "snapshot_version int, snapshot_date date, amount_cleaned decimal(12,2)")
    got = {r.snapshot_version: r.growth for r in S.snapshot_growth(cur).collect()}
    assert got == {1: 500, 2: 50, 3: 30}
