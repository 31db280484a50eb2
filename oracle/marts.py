"""Oracle CTEs for the four marts, written the reference's way (self joins
for prior periods and rolling windows) with exact integer rounding."""

from __future__ import annotations

from .base import AS_OF, cents, money, qdiv

_ms = "make_date(b.year, b.month, 1)"


def _avg_c(col: str) -> str:
    return qdiv(f"SUM({cents(col)})", f"100 * COUNT({col})", 2)


def _chg(cur: str, prev: str) -> str:
    return f"CASE WHEN {prev} > 0 THEN {qdiv(f'100 * ({cents(cur)} - {cents(prev)})', cents(prev), 2)} END"


def _trend(cur: str, prev: str) -> str:
    d = f"(({cur}) - ({prev})) * 100"
    return (f"CASE WHEN {prev} IS NULL THEN 'NO_DATA' WHEN {prev} = 0 THEN 'STABLE' "
            f"WHEN ({prev} > 0 AND {d} > 5 * {prev}) OR ({prev} < 0 AND {d} < 5 * {prev}) THEN 'INCREASING' "
            f"WHEN ({prev} > 0 AND {d} < -5 * {prev}) OR ({prev} < 0 AND {d} > -5 * {prev}) THEN 'DECREASING' "
            f"ELSE 'STABLE' END")


def _prev_join(alias: str, keys, months_back: int) -> str:
    cond = " AND ".join(f"{alias}.{k} = b.{k}" for k in keys)
    return (f"LEFT JOIN {{base}} {alias} ON {cond} AND "
            f"{alias}.year * 12 + {alias}.month = b.year * 12 + b.month - {months_back}")


MSS = f"""mss_base AS (
  SELECT spending_year AS year, spending_month AS month, person_name, category_name, category_group,
    location_name, location_type,
    {money('SUM(amount_cleaned)')} AS total_spending,
    COUNT(*) AS transaction_count,
    {_avg_c('amount_cleaned')} AS avg_transaction_amount,
    {money('MIN(amount_cleaned)')} AS min_transaction_amount,
    {money('MAX(amount_cleaned)')} AS max_transaction_amount,
    {qdiv('SUM(data_quality_score)', 'COUNT(data_quality_score)', 2)} AS avg_quality_score,
    MAX(snapshot_version) AS snapshot_version_source
  FROM latest
  GROUP BY spending_year, spending_month, person_name, category_name, category_group, location_name, location_type
),
mss AS (
  SELECT b.year, b.month, CAST(quarter({_ms}) AS INTEGER) AS quarter, {_ms} AS month_start_date,
    last_day({_ms}) AS month_end_date, b.person_name, b.category_name, b.category_group,
    b.location_name, b.location_type, b.total_spending, b.transaction_count, b.avg_transaction_amount,
    b.min_transaction_amount, b.max_transaction_amount,
    pm.total_spending AS prev_month_spending,
    {money('b.total_spending - COALESCE(pm.total_spending, 0)')} AS mom_absolute_change,
    {_chg('b.total_spending', 'pm.total_spending')} AS mom_percent_change,
    py.total_spending AS prev_year_spending,
    {money('b.total_spending - COALESCE(py.total_spending, 0)')} AS yoy_absolute_change,
    {_chg('b.total_spending', 'py.total_spending')} AS yoy_percent_change,
    b.avg_quality_score, b.snapshot_version_source, {AS_OF} AS created_at, {AS_OF} AS updated_at
  FROM mss_base b
  {_prev_join('pm', ['person_name', 'category_name', 'location_name'], 1).format(base='mss_base')}
  {_prev_join('py', ['person_name', 'category_name', 'location_name'], 12).format(base='mss_base')}
)"""

CT = f"""ct_base AS (
  SELECT spending_year AS year, spending_month AS month, category_name, category_group,
    {money('SUM(amount_cleaned)')} AS total_spending,
    COUNT(*) AS transaction_count,
    COUNT(DISTINCT person_name) AS unique_persons,
    {_avg_c('amount_cleaned')} AS avg_transaction_amount,
    MAX(snapshot_version) AS snapshot_version_source
  FROM latest GROUP BY spending_year, spending_month, category_name, category_group
),
ct_r AS (
  SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY year, month ORDER BY total_spending DESC, category_name) AS INTEGER) AS rk,
    SUM(total_spending) OVER (PARTITION BY year, month) AS month_total
  FROM ct_base
),
ct_roll AS (
  SELECT a.year, a.month, a.category_name,
    {qdiv(f"SUM({cents('c.total_spending')}) FILTER (WHERE c.year * 12 + c.month >= a.year * 12 + a.month - 2)",
          "100 * COUNT(*) FILTER (WHERE c.year * 12 + c.month >= a.year * 12 + a.month - 2)", 2)} AS r3,
    {qdiv(f"SUM({cents('c.total_spending')})", "100 * COUNT(*)", 2)} AS r6
  FROM ct_base a JOIN ct_base c ON a.category_name = c.category_name
    AND c.year * 12 + c.month BETWEEN a.year * 12 + a.month - 5 AND a.year * 12 + a.month
  GROUP BY a.year, a.month, a.category_name
),
ct AS (
  SELECT b.year, b.month, CAST(quarter({_ms}) AS INTEGER) AS quarter, {_ms} AS month_start_date,
    b.category_name, b.category_group, b.total_spending, b.transaction_count, b.unique_persons,
    b.avg_transaction_amount,
    pm.total_spending AS prev_month_spending,
    {money('b.total_spending - COALESCE(pm.total_spending, 0)')} AS mom_absolute_change,
    {_chg('b.total_spending', 'pm.total_spending')} AS mom_percent_change,
    {_trend('b.total_spending', 'pm.total_spending')} AS mom_trend_direction,
    py.total_spending AS prev_year_spending,
    {money('b.total_spending - COALESCE(py.total_spending, 0)')} AS yoy_absolute_change,
    {_chg('b.total_spending', 'py.total_spending')} AS yoy_percent_change,
    {_trend('b.total_spending', 'py.total_spending')} AS yoy_trend_direction,
    ro.r3 AS rolling_3month_avg, ro.r6 AS rolling_6month_avg,
    b.rk AS category_rank_current, pm.rk AS category_rank_prev_month,
    CAST(COALESCE(pm.rk, b.rk) - b.rk AS INTEGER) AS rank_change,
    {qdiv(f"100 * {cents('b.total_spending')}", cents('b.month_total'), 2)} AS percent_of_total_spending,
    b.snapshot_version_source, {AS_OF} AS created_at, {AS_OF} AS updated_at
  FROM ct_r b
  {_prev_join('pm', ['category_name'], 1).format(base='ct_r')}
  {_prev_join('py', ['category_name'], 12).format(base='ct_r')}
  LEFT JOIN ct_roll ro ON ro.year = b.year AND ro.month = b.month AND ro.category_name = b.category_name
)"""


def _gsum(g: str) -> str:
    return money(f"SUM(CASE WHEN category_group = '{g}' THEN amount_cleaned ELSE 0 END)")


_dim = f"day(last_day({_ms}))"

PA = f"""pa_base AS (
  SELECT spending_year AS year, spending_month AS month, person_name,
    {money('SUM(amount_cleaned)')} AS total_spending,
    COUNT(*) AS transaction_count,
    {_avg_c('amount_cleaned')} AS avg_transaction_amount,
    {qdiv(f"CAST(2 * quantile_cont({cents('amount_cleaned')}, 0.5) AS HUGEINT)", '200', 2)} AS median_transaction_amount,
    {_gsum('Essential')} AS essential_spending,
    {_gsum('Discretionary')} AS discretionary_spending,
    {_gsum('Transport')} AS transport_spending,
    {_gsum('Healthcare')} AS healthcare_spending,
    {_gsum('Education')} AS education_spending,
    {money("SUM(CASE WHEN category_group = 'Other' OR category_group IS NULL THEN amount_cleaned ELSE 0 END)")} AS other_spending,
    COUNT(DISTINCT category_name) AS unique_categories_count,
    COUNT(DISTINCT location_name) AS unique_locations_count,
    COUNT(DISTINCT payment_method_name) AS unique_payment_methods_count,
    {money('SUM(CASE WHEN spending_day_of_week BETWEEN 1 AND 5 THEN amount_cleaned ELSE 0 END)')} AS weekday_spending,
    {money('SUM(CASE WHEN spending_day_of_week IN (6, 7) THEN amount_cleaned ELSE 0 END)')} AS weekend_spending,
    COUNT(*) FILTER (WHERE amount_cleaned < 10) AS small_transactions_count,
    COUNT(*) FILTER (WHERE amount_cleaned >= 10 AND amount_cleaned < 100) AS medium_transactions_count,
    COUNT(*) FILTER (WHERE amount_cleaned >= 100 AND amount_cleaned < 500) AS large_transactions_count,
    COUNT(*) FILTER (WHERE amount_cleaned >= 500) AS xlarge_transactions_count,
    COUNT(DISTINCT spending_date) AS days_with_spending,
    {qdiv('SUM(data_quality_score)', 'COUNT(data_quality_score)', 2)} AS avg_quality_score,
    MAX(snapshot_version) AS snapshot_version_source
  FROM latest GROUP BY spending_year, spending_month, person_name
),
pa_cat AS (
  SELECT spending_year AS year, spending_month AS month, person_name, category_name,
    {money('SUM(amount_cleaned)')} AS cat_total,
    ROW_NUMBER() OVER (PARTITION BY spending_year, spending_month, person_name
                       ORDER BY SUM(amount_cleaned) DESC, category_name) AS rn
  FROM latest GROUP BY spending_year, spending_month, person_name, category_name
),
pa AS (
  SELECT b.year, b.month, CAST(quarter({_ms}) AS INTEGER) AS quarter, {_ms} AS month_start_date, b.person_name,
    b.total_spending, b.transaction_count, b.avg_transaction_amount, b.median_transaction_amount,
    t.category_name AS top_category, t.cat_total AS top_category_spending,
    {qdiv(f"100 * {cents('t.cat_total')}", cents('b.total_spending'), 2)} AS top_category_percent,
    b.essential_spending, b.discretionary_spending, b.transport_spending, b.healthcare_spending,
    b.education_spending, b.other_spending,
    {qdiv(f"100 * {cents('b.essential_spending')}", cents('b.total_spending'), 2)} AS essential_percent,
    {qdiv(f"100 * {cents('b.discretionary_spending')}", cents('b.total_spending'), 2)} AS discretionary_percent,
    {qdiv(cents('b.essential_spending'), cents('b.discretionary_spending'), 2)} AS essential_to_discretionary_ratio,
    b.unique_categories_count, b.unique_locations_count, b.unique_payment_methods_count,
    b.weekday_spending, b.weekend_spending,
    {qdiv(f"100 * {cents('b.weekend_spending')}", cents('b.total_spending'), 2)} AS weekend_spending_percent,
    CAST(NULL AS DECIMAL(18,2)) AS morning_spending, CAST(NULL AS DECIMAL(18,2)) AS afternoon_spending,
    CAST(NULL AS DECIMAL(18,2)) AS evening_spending, CAST(NULL AS DECIMAL(18,2)) AS night_spending,
    b.small_transactions_count, b.medium_transactions_count, b.large_transactions_count,
    b.xlarge_transactions_count,
    {qdiv(cents('b.total_spending'), f'100 * {_dim}', 2)} AS avg_daily_spending,
    {qdiv(cents('b.total_spending'), '433', 2)} AS avg_weekly_spending,
    b.days_with_spending,
    {qdiv('100 * b.days_with_spending', _dim, 2)} AS spending_frequency_percent,
    pm.total_spending AS prev_month_total,
    {money('b.total_spending - COALESCE(pm.total_spending, 0)')} AS mom_absolute_change,
    {_chg('b.total_spending', 'pm.total_spending')} AS mom_percent_change,
    py.total_spending AS prev_year_total,
    {money('b.total_spending - COALESCE(py.total_spending, 0)')} AS yoy_absolute_change,
    {_chg('b.total_spending', 'py.total_spending')} AS yoy_percent_change,
    b.avg_quality_score, b.snapshot_version_source, {AS_OF} AS created_at, {AS_OF} AS updated_at
  FROM pa_base b
  LEFT JOIN pa_cat t ON t.year = b.year AND t.month = b.month AND t.person_name = b.person_name AND t.rn = 1
  {_prev_join('pm', ['person_name'], 1).format(base='pa_base')}
  {_prev_join('py', ['person_name'], 12).format(base='pa_base')}
)"""

PS = f"""ps_base AS (
  SELECT spending_year AS year, spending_month AS month, payment_method_name, payment_type,
    COUNT(*) AS transaction_count,
    COUNT(DISTINCT person_name) AS unique_persons_count,
    {money('SUM(amount_cleaned)')} AS total_amount,
    {_avg_c('amount_cleaned')} AS avg_transaction_amount,
    {money('MIN(amount_cleaned)')} AS min_transaction_amount,
    {money('MAX(amount_cleaned)')} AS max_transaction_amount,
    MAX(snapshot_version) AS snapshot_version_source
  FROM latest GROUP BY spending_year, spending_month, payment_method_name, payment_type
),
ps_tot AS (
  SELECT year, month, SUM(transaction_count) AS mt, SUM(total_amount) AS ma FROM ps_base GROUP BY year, month
),
ps_cat AS (
  SELECT spending_year AS year, spending_month AS month, payment_method_name, category_name,
    {money('SUM(amount_cleaned)')} AS amt,
    ROW_NUMBER() OVER (PARTITION BY spending_year, spending_month, payment_method_name
                       ORDER BY SUM(amount_cleaned) DESC, category_name) AS rn
  FROM latest GROUP BY spending_year, spending_month, payment_method_name, category_name
),
ps_rank AS (
  SELECT year, month, payment_method_name,
    CAST(ROW_NUMBER() OVER (PARTITION BY year, month ORDER BY total_amount DESC, payment_method_name) AS INTEGER) AS rk
  FROM ps_base
),
ps AS (
  SELECT b.year, b.month, CAST(quarter({_ms}) AS INTEGER) AS quarter, {_ms} AS month_start_date,
    b.payment_method_name, b.payment_type, b.transaction_count, b.unique_persons_count, b.total_amount,
    b.avg_transaction_amount, b.min_transaction_amount, b.max_transaction_amount,
    {qdiv('100 * b.transaction_count', 't.mt', 2)} AS percent_of_transactions,
    {qdiv(f"100 * {cents('b.total_amount')}", cents('t.ma'), 2)} AS percent_of_spending,
    c1.category_name AS top_category_1, c1.amt AS top_category_1_amount,
    c2.category_name AS top_category_2, c2.amt AS top_category_2_amount,
    c3.category_name AS top_category_3, c3.amt AS top_category_3_amount,
    pm.transaction_count AS prev_month_transaction_count,
    CASE WHEN pm.transaction_count > 0
         THEN {qdiv('100 * (b.transaction_count - pm.transaction_count)', 'pm.transaction_count', 2)} END
      AS mom_transaction_change_percent,
    pm.total_amount AS prev_month_amount,
    {_chg('b.total_amount', 'pm.total_amount')} AS mom_amount_change_percent,
    r.rk AS payment_method_rank,
    b.snapshot_version_source, {AS_OF} AS created_at, {AS_OF} AS updated_at
  FROM ps_base b
  JOIN ps_tot t ON t.year = b.year AND t.month = b.month
  JOIN ps_rank r ON r.year = b.year AND r.month = b.month AND r.payment_method_name = b.payment_method_name
  LEFT JOIN ps_cat c1 ON c1.year = b.year AND c1.month = b.month AND c1.payment_method_name = b.payment_method_name AND c1.rn = 1
  LEFT JOIN ps_cat c2 ON c2.year = b.year AND c2.month = b.month AND c2.payment_method_name = b.payment_method_name AND c2.rn = 2
  LEFT JOIN ps_cat c3 ON c3.year = b.year AND c3.month = b.month AND c3.payment_method_name = b.payment_method_name AND c3.rn = 3
  {_prev_join('pm', ['payment_method_name'], 1).format(base='ps_base')}
)"""

MARTS = [MSS, CT, PA, PS]
