"""Result order of the reports and views: columns, descending with a leading minus.

Ties are broken by the other columns of the list. Reports that already pick a top k
are ordered there. Results of the size of a snapshot (``hq21_export``, ``hq22_diff_versions``)
are sorted like the others: Spark range-partitions them by sampled bounds, so no task sorts all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDER = {
    # versions
    "hq03_versions": "-snapshot_version", "hq09_compare_adjacent": "-older_version",
    "hq10_version_growth": "-snapshot_version", "hq11_new_per_version": "-snapshot_version",
    "hq18_person_versions": "-snapshot_version", "hq19_category_versions": "-snapshot_version",
    "snapshot_growth": "-snapshot_version", "cv_version_history": "-snapshot_version",
    "cv_growth_pct": "-snapshot_version", "cv_quality_by_version": "-snapshot_version",
    "cv_duplicate_ids": "-snapshot_version -duplicate_count stg_spending_id",
    # helper queries
    "hq05_person": "-total_spent person_name", "hq06_monthly": "-spending_year -spending_month",
    "hq07_weekday": "spending_day_of_week", "hq12_person_category": "person_name -total_spent category_name",
    "hq13_payment_pref": "person_name -usage_count payment_method_name", "hq15_quarterly": "-spending_year -spending_quarter",
    "hq17_quality_category": "-avg_quality_score category_name",
    "hq21_export": "-spending_date person_name",
    # staging quality report
    "dq_person_spending": "-total_spending person_name", "dq_category_spending": "-total_amount category_name",
    "dq_payment_usage": "-transactions payment_method_name", "dq_monthly_trend": "-month",
    "dq_location_type": "-total_amount location_type", "stg_month_category": "-spending_year -spending_month -total_amount category_name",
    "stg_payment_analysis": "-usage_count payment_method_name", "validation_failed_detail": "severity_order -records_failed check_name",
    # marts
    "ps_market_share": "-total_amt payment_method_name", "dst_share_year": "-total_amount payment_method_name",
    "dst_category_mom": "-total_spending category_name", "dst_ed_month": "-total_spending person_name",
    "dst_rolling_year": "category_name -month_start_date",
    # insight views and the queries on them
    "health_scorecard": "-year -month health_score person_name",
    "spending_recommendations": "person_name priority", "category_insights": "-opportunity_score -total_spending category_name",
    "lifestyle_plan": "-monthly_savings_potential person_name", "x_health_month": "health_score person_name",
    "x_person_top3": "priority", "x_person_top5": "priority", "x_alerts_high": "person_name spike_category",
    "x_alerts_high_medium": "severity_rank person_name spike_category", "x_opportunity_60": "-opportunity_score category_name",
    "x_plans_200": "-monthly_savings_potential person_name", "x_plans_100": "-monthly_savings_potential person_name",
    "x_health_with_top_rec": "health_score person_name",
}
SEVERITIES = ["HIGH", "MEDIUM", "LOW"]


def ordered(key: str, df: DataFrame) -> DataFrame:
    """The report in its order; other keys unchanged."""
    if key == "budget_alerts":
        rank = F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), F.col("alert_severity"))
        return df.orderBy(rank, "person_name", "spike_category")
    if key == "hq22_diff_versions":
        return df.orderBy("status", F.desc(F.coalesce("v1_date", "v2_date")), "spending_id")
    if key not in ORDER:
        return df
    return df.orderBy(*[F.desc(c[1:]) if c[0] == "-" else F.asc(c) for c in ORDER[key].split()])
