"""Oracle SQL per registered key (DuckDB dialect)."""

from __future__ import annotations

from .base import cents, money, qdiv, with_chain
from .marts import MARTS

W = with_chain(*MARTS)


def sel(body: str) -> str:
    return W + body


def avg_c(col: str) -> str:
    return qdiv(f"SUM({cents(col)})", f"100 * COUNT({col})", 2)


def avg_i(col: str) -> str:
    return qdiv(f"SUM({col})", f"COUNT({col})", 2)


def pct_i(part: str, whole: str) -> str:
    return qdiv(f"100 * ({part})", whole, 2)


P = {"year": 2000, "month": 6, "person": "NATION_5", "category": "Dining"}

SQL: dict[str, str] = {}

# -- staging ------------------------------------------------------------------
SQL["clean_amount"] = sel(
    "SELECT src_id, amount_raw, amount_cleaned, currency_code, is_amount_parsed_successfully FROM stg")
SQL["clean_date"] = sel(
    "SELECT src_id, spending_date_raw, spending_date, is_date_parsed_successfully FROM stg")
SQL["date_parts"] = sel(
    "SELECT src_id, spending_date, spending_year, spending_month, spending_day, spending_quarter, "
    "spending_day_of_week FROM stg")
SQL["classify_location"] = sel("SELECT src_id, location_name, location_type FROM stg")
SQL["classify_payment"] = sel("SELECT src_id, payment_method_name, payment_type FROM stg")
SQL["classify_category"] = sel("SELECT src_id, category_name, category_group FROM stg")
SQL["quality_score"] = sel("SELECT src_id, data_quality_score FROM stg")
SQL["stg_transform"] = sel("SELECT * FROM stg")
SQL["stg_reject_counts"] = sel(" UNION ALL ".join(
    f"SELECT '{name}' AS reject_reason, COUNT(*) FILTER (WHERE {bad}) AS row_count FROM stg" for name, bad in (
        ("invalid_amount", "amount_cleaned IS NULL"), ("invalid_date", "spending_date IS NULL"),
        ("missing_person", "person_name IS NULL"), ("missing_location", "location_name IS NULL"),
        ("missing_category", "category_name IS NULL"), ("missing_payment_method", "payment_method_name IS NULL"))))
SQL["stg_rejects"] = sel(
    "SELECT src_id, person_name, spending_date_raw, amount_raw, location_name, reject_reason "
    "FROM stg_r WHERE reject_reason IS NOT NULL")
_ok = "is_amount_parsed_successfully AND is_date_parsed_successfully"
SQL["stg_transform_stats"] = sel(f"""SELECT COUNT(*) AS total_rows,
  COUNT(*) FILTER (WHERE is_amount_parsed_successfully) AS amount_parsed,
  {pct_i('COUNT(*) FILTER (WHERE is_amount_parsed_successfully)', 'COUNT(*)')} AS amount_success_pct,
  COUNT(*) FILTER (WHERE is_date_parsed_successfully) AS date_parsed,
  {pct_i('COUNT(*) FILTER (WHERE is_date_parsed_successfully)', 'COUNT(*)')} AS date_success_pct,
  COUNT(*) FILTER (WHERE {_ok}) AS valid_rows,
  {pct_i(f'COUNT(*) FILTER (WHERE {_ok})', 'COUNT(*)')} AS valid_pct,
  COUNT(*) - COUNT(*) FILTER (WHERE {_ok}) AS rejected_rows,
  {avg_i('data_quality_score')} AS avg_quality_score,
  MIN(CASE WHEN {_ok} THEN spending_date END) AS min_date,
  MAX(CASE WHEN {_ok} THEN spending_date END) AS max_date
FROM stg""")
SQL["dim_person"] = sel("SELECT * FROM dim_person")
SQL["dim_location"] = sel("SELECT * FROM dim_location")
SQL["dim_category"] = sel("SELECT * FROM dim_category")
SQL["dim_payment_method"] = sel("SELECT * FROM dim_payment_method")
SQL["fact_spending"] = sel("SELECT * FROM fact")
SQL["spending_complete"] = sel(
    "SELECT spending_id, person_name, spending_date, spending_year, spending_month, spending_quarter, "
    "spending_day_of_week, category_name, category_group, amount_cleaned, currency_code, location_name, "
    "location_type, description, payment_method_name, payment_type, data_quality_score, src_id, transformed_at "
    "FROM complete")
SQL["stg_load_stats"] = sel(f"""SELECT
  (SELECT COUNT(*) FROM dim_person) AS dim_person_rows,
  (SELECT COUNT(*) FROM dim_location) AS dim_location_rows,
  (SELECT COUNT(*) FROM dim_category) AS dim_category_rows,
  (SELECT COUNT(*) FROM dim_payment_method) AS dim_payment_method_rows,
  COUNT(*) AS fact_rows, (SELECT COUNT(*) FROM src) AS source_rows,
  {pct_i('COUNT(*)', '(SELECT COUNT(*) FROM src)')} AS load_success_pct,
  {avg_i('data_quality_score')} AS avg_score, MIN(data_quality_score) AS min_score,
  MAX(data_quality_score) AS max_score, {avg_c('amount_cleaned')} AS avg_amount,
  {money('SUM(amount_cleaned)')} AS total_amount, MIN(spending_date) AS min_date, MAX(spending_date) AS max_date
FROM fact""")
SQL["stg_top_categories"] = sel(f"""SELECT category_name, COUNT(*) AS transactions,
  {money('SUM(amount_cleaned)')} AS total_amount, {avg_c('amount_cleaned')} AS avg_amount
FROM complete GROUP BY category_name ORDER BY total_amount DESC, category_name LIMIT 5""")
SQL["stg_recent_sample"] = sel("""SELECT person_name, spending_date, category_name, amount_cleaned, location_name,
  payment_method_name, src_id FROM complete ORDER BY spending_date DESC, src_id DESC LIMIT 10""")
SQL["stg_person_history"] = sel(f"""SELECT spending_id, person_name, spending_date, spending_year, spending_month,
  spending_quarter, spending_day_of_week, category_name, category_group, amount_cleaned, currency_code,
  location_name, location_type, description, payment_method_name, payment_type, data_quality_score, src_id
FROM complete WHERE person_name = '{P['person']}'""")
SQL["stg_month_category"] = sel(f"""SELECT spending_year, spending_month, category_name, COUNT(*) AS transactions,
  {money('SUM(amount_cleaned)')} AS total_amount FROM complete GROUP BY spending_year, spending_month, category_name""")
SQL["stg_top_locations"] = sel(f"""SELECT location_name, location_type, COUNT(*) AS visits,
  {money('SUM(amount_cleaned)')} AS total_spent FROM complete GROUP BY location_name, location_type
ORDER BY total_spent DESC, location_name LIMIT 10""")
SQL["stg_payment_analysis"] = sel(f"""SELECT payment_method_name, payment_type, COUNT(*) AS usage_count,
  {avg_c('amount_cleaned')} AS avg_transaction FROM complete GROUP BY payment_method_name, payment_type""")

# -- marts --------------------------------------------------------------------
SQL["mart_monthly_summary"] = sel("SELECT * FROM mss")
SQL["mart_category_trends"] = sel("SELECT * FROM ct")
SQL["mart_person_analytics"] = sel("SELECT * FROM pa")
SQL["mart_payment_summary"] = sel("SELECT * FROM ps")

# -- mart reports -------------------------------------------------------------
_lp = "(SELECT MAX(year * 100 + month) FROM mss)"


def _top_name(table, name, measure):
    return (f"(SELECT {name} FROM {table} WHERE year * 100 + month = {_lp} "
            f"ORDER BY {measure} DESC, {name} LIMIT 1)")


SQL["mart_dashboard"] = sel(f"""SELECT COUNT(DISTINCT person_name) AS total_persons,
  COUNT(DISTINCT category_name) AS total_categories, {money('SUM(total_spending)')} AS total_spending,
  CAST(SUM(transaction_count) AS BIGINT) AS total_transactions, {avg_c('avg_transaction_amount')} AS avg_transaction_size,
  {_top_name('ct', 'category_name', 'total_spending')} AS top_category,
  {_top_name('pa', 'person_name', 'total_spending')} AS top_spender,
  {_top_name('ps', 'payment_method_name', 'total_amount')} AS top_payment_method,
  year, month, month_start_date, MAX(snapshot_version_source) AS snapshot_version
FROM mss WHERE year * 100 + month = {_lp} GROUP BY year, month, month_start_date""")


def _dir(x):
    return f"CASE WHEN {x} IS NULL THEN 'NO_DATA' WHEN {x} > 5 THEN 'INCREASING' WHEN {x} < -5 THEN 'DECREASING' ELSE 'STABLE' END"


SQL["trend_direction"] = sel(f"""SELECT year, month, category_name, mom_percent_change,
  {_dir('mom_percent_change')} AS mom_direction, yoy_percent_change, {_dir('yoy_percent_change')} AS yoy_direction
FROM ct""")
SQL["ms_source_info"] = sel("""SELECT snapshot_version, COUNT(*) AS rows, MIN(spending_date) AS min_date,
  MAX(spending_date) AS max_date FROM latest GROUP BY snapshot_version""")
SQL["ms_reconcile"] = sel(f"""SELECT c.curated_total, m.mart_total, abs(c.curated_total - m.mart_total) < 0.01 AS match
FROM (SELECT {money('SUM(amount_cleaned)')} AS curated_total FROM latest) c,
     (SELECT {money('SUM(total_spending)')} AS mart_total FROM mss) m""")
SQL["ms_stats"] = sel(f"""SELECT COUNT(*) AS total_records, COUNT(DISTINCT person_name) AS unique_persons,
  COUNT(DISTINCT category_name) AS unique_categories, COUNT(DISTINCT location_name) AS unique_locations,
  COUNT(DISTINCT CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0')) AS unique_months,
  CAST(SUM(transaction_count) AS BIGINT) AS total_transactions, {avg_c('total_spending')} AS avg_monthly_spending,
  MIN(total_spending) AS min_spending, MAX(total_spending) AS max_spending FROM mss""")
SQL["ms_top_samples"] = sel("""SELECT year, month, person_name, category_name, location_name, total_spending,
  transaction_count, mom_percent_change, yoy_percent_change FROM mss
ORDER BY total_spending DESC, year, month, person_name, category_name, location_name LIMIT 5""")
SQL["ct_top"] = sel(f"""SELECT category_name, {money('SUM(total_spending)')} AS total,
  {avg_c('percent_of_total_spending')} AS avg_share,
  string_agg(DISTINCT mom_trend_direction, ', ' ORDER BY mom_trend_direction) AS trends
FROM ct GROUP BY category_name ORDER BY total DESC, category_name LIMIT 5""")
SQL["ct_growing"] = sel("""SELECT year, month, category_name, mom_percent_change, total_spending FROM ct
WHERE mom_percent_change IS NOT NULL ORDER BY mom_percent_change DESC, year, month, category_name LIMIT 5""")
SQL["ct_declining"] = sel("""SELECT year, month, category_name, mom_percent_change, total_spending FROM ct
WHERE mom_percent_change IS NOT NULL ORDER BY mom_percent_change ASC, year, month, category_name LIMIT 5""")
SQL["pa_ed_summary"] = sel(f"""SELECT {avg_c('essential_percent')} AS avg_essential_pct,
  {avg_c('discretionary_percent')} AS avg_discretionary_pct, {avg_c('essential_to_discretionary_ratio')} AS avg_ed_ratio,
  COUNT(*) FILTER (WHERE discretionary_percent > 40) AS high_discretionary_rows, COUNT(*) AS total_rows FROM pa""")
SQL["pa_top_spenders"] = sel("""SELECT year, month, person_name, total_spending, essential_percent,
  discretionary_percent, top_category FROM pa ORDER BY total_spending DESC, year, month, person_name LIMIT 5""")
SQL["pa_alerts"] = sel("""SELECT year, month, person_name, discretionary_percent, discretionary_spending, total_spending
FROM pa WHERE discretionary_percent > 35 ORDER BY discretionary_percent DESC, year, month, person_name LIMIT 5""")
SQL["ps_market_share"] = sel(f"""SELECT payment_method_name, payment_type,
  CAST(SUM(transaction_count) AS BIGINT) AS total_txns, {money('SUM(total_amount)')} AS total_amt,
  {avg_c('percent_of_transactions')} AS avg_txn_share, {avg_c('percent_of_spending')} AS avg_spending_share
FROM ps GROUP BY payment_method_name, payment_type""")
SQL["ps_trends"] = sel("""SELECT year, month, payment_method_name, mom_transaction_change_percent,
  mom_amount_change_percent, total_amount FROM ps WHERE mom_amount_change_percent IS NOT NULL
ORDER BY mom_amount_change_percent DESC, year, month, payment_method_name LIMIT 5""")
SQL["ps_preferences"] = sel("""SELECT year, month, payment_method_name, top_category_1, top_category_1_amount,
  top_category_2, top_category_3, total_amount FROM ps ORDER BY total_amount DESC, year, month, payment_method_name LIMIT 5""")
_ym = f"year = {P['year']} AND month = {P['month']}"
SQL["dst_ed_month"] = sel(f"""SELECT person_name, total_spending, essential_spending, discretionary_spending,
  essential_percent, discretionary_percent, essential_to_discretionary_ratio FROM pa WHERE {_ym}""")
SQL["dst_category_mom"] = sel(f"""SELECT category_name, total_spending, mom_percent_change, mom_trend_direction
FROM ct WHERE {_ym} ORDER BY mom_percent_change DESC NULLS LAST, category_name LIMIT 5""")
SQL["dst_person_yoy"] = sel(f"""SELECT person_name, year, month, total_spending, yoy_percent_change
FROM pa WHERE month = {P['month']}""")
SQL["dst_rolling_year"] = sel(f"""SELECT category_name, month_start_date, total_spending, rolling_3month_avg,
  rolling_6month_avg FROM ct WHERE year = {P['year']}""")
SQL["dst_top_spenders_month"] = sel(f"""SELECT person_name, total_spending, essential_percent, discretionary_percent,
  top_category FROM pa WHERE {_ym} ORDER BY total_spending DESC, person_name LIMIT 10""")
SQL["dst_fastest_growing"] = sel(f"""SELECT category_name, total_spending, mom_percent_change, yoy_percent_change
FROM ct WHERE {_ym} AND mom_percent_change IS NOT NULL ORDER BY mom_percent_change DESC, category_name LIMIT 10""")
SQL["dst_high_discretionary"] = sel("""SELECT person_name, year, month, total_spending, discretionary_percent,
  essential_to_discretionary_ratio FROM pa WHERE discretionary_percent > 40""")
SQL["dst_share_year"] = sel(f"""SELECT payment_method_name, payment_type, CAST(SUM(transaction_count) AS BIGINT) AS total_transactions,
  {money('SUM(total_amount)')} AS total_amount, {avg_c('percent_of_spending')} AS avg_market_share
FROM ps WHERE year = {P['year']} GROUP BY payment_method_name, payment_type""")
SQL["dst_raw_monthly_category"] = sel(f"""SELECT CAST(date_trunc('month', spending_date) AS DATE) AS month, category_name,
  {money('SUM(amount_cleaned)')} AS total FROM latest GROUP BY 1, 2""")
SQL["dst_mart_monthly_category"] = sel(f"""SELECT month_start_date AS month, category_name, total_spending AS total
FROM ct WHERE year = {P['year']}""")

# -- insight views --------------------------------------------------------------
from .insights import VIEWS  # noqa: E402
from .marts import MARTS as _M  # noqa: E402
from .base import with_chain as _wc  # noqa: E402

WV = _wc(*_M, *VIEWS)


def vsel(body: str) -> str:
    return WV + body


SQL["health_scorecard"] = vsel("SELECT * FROM health")
SQL["spending_recommendations"] = vsel("SELECT * FROM recs")
SQL["budget_alerts"] = vsel("SELECT * FROM alerts")
SQL["category_insights"] = vsel("SELECT * FROM catins")
SQL["lifestyle_plan"] = vsel("SELECT * FROM plan")
SQL["x_health_bottom3"] = vsel("""SELECT person_name, year, month, health_grade, health_score, discretionary_percent,
  potential_monthly_savings FROM health ORDER BY health_score, year DESC, month DESC, person_name LIMIT 3""")
SQL["x_top_recommendation"] = vsel("""SELECT person_name, recommendation_title, potential_monthly_savings
FROM recs WHERE priority = 1 ORDER BY person_name LIMIT 3""")
SQL["x_high_alerts"] = vsel("""SELECT person_name, alert_title, spike_category FROM alerts WHERE alert_severity = 'HIGH'
ORDER BY person_name, spike_category NULLS FIRST LIMIT 3""")
SQL["x_top_opportunities"] = vsel("""SELECT category_name, total_spending, opportunity_score FROM catins
ORDER BY opportunity_score DESC, total_spending DESC, category_name LIMIT 3""")
SQL["x_top_plans"] = vsel("""SELECT person_name, monthly_savings_potential, action_1_priority FROM plan
ORDER BY monthly_savings_potential DESC, person_name LIMIT 3""")
SQL["x_health_month"] = vsel(f"""SELECT person_name, health_grade, health_score, discretionary_percent,
  potential_monthly_savings FROM health WHERE year = {P['year']} AND month = {P['month']}""")
SQL["x_person_top3"] = vsel(f"""SELECT priority, recommendation_title, recommendation_detail, potential_monthly_savings,
  implementation_difficulty FROM recs WHERE person_name = '{P['person']}' AND priority <= 3""")
SQL["x_alerts_high"] = vsel("""SELECT person_name, alert_title, alert_message, recommended_action, spike_category
FROM alerts WHERE alert_severity = 'HIGH'""")
SQL["x_opportunity_50"] = vsel("""SELECT category_name, total_spending, opportunity_score, insight_summary, recommended_action
FROM catins WHERE opportunity_score > 50 ORDER BY opportunity_score DESC, total_spending DESC, category_name LIMIT 5""")
SQL["x_plans_200"] = vsel("""SELECT person_name, financial_health_status, monthly_savings_potential, action_1_priority,
  lifestyle_change_1, week_1_savings_target FROM plan WHERE monthly_savings_potential > 200""")
SQL["x_health_dashboard"] = vsel(f"""SELECT person_name, health_grade, health_score, discretionary_percent,
  potential_monthly_savings, top_category FROM health WHERE year = {P['year']} AND month = {P['month']}
ORDER BY health_score, person_name LIMIT 10""")
SQL["x_person_top5"] = vsel(f"""SELECT priority, recommendation_title, category_name, current_monthly_spending,
  potential_monthly_savings, implementation_difficulty FROM recs WHERE person_name = '{P['person']}' AND priority <= 5""")
SQL["x_alerts_high_medium"] = vsel("""SELECT person_name, alert_severity, alert_title, recommended_action,
  discretionary_percent, spike_category, CASE alert_severity WHEN 'HIGH' THEN 1 ELSE 2 END AS severity_rank
FROM alerts WHERE alert_severity IN ('HIGH', 'MEDIUM')""")
SQL["x_opportunity_60"] = vsel("""SELECT category_name, category_group, total_spending, opportunity_score,
  insight_summary, recommended_action FROM catins WHERE opportunity_score > 60""")
SQL["x_plans_100"] = vsel("""SELECT person_name, financial_health_status, current_monthly_spending,
  monthly_savings_potential, annual_savings_potential, action_1_priority, action_2_priority, action_3_priority,
  lifestyle_change_1, lifestyle_change_2, week_1_savings_target FROM plan WHERE monthly_savings_potential > 100""")
SQL["x_health_with_top_rec"] = vsel(f"""SELECT h.person_name, h.health_grade, h.health_score, h.discretionary_percent,
  r.recommendation_title, r.potential_monthly_savings
FROM health h LEFT JOIN LATERAL (SELECT recommendation_title, potential_monthly_savings FROM recs r
  WHERE r.person_name = h.person_name ORDER BY priority LIMIT 1) r ON true
WHERE h.year = {P['year']} AND h.month = {P['month']} AND h.health_score < 70""")

# -- ingest, profile, source checks ---------------------------------------------
from .base import AS_OF as _AS_OF  # noqa: E402

SQL["ingest_raw"] = sel("SELECT * FROM src")
SQL["ingest_reconcile"] = sel("""SELECT load_batch_id, COUNT(*) AS file_rows, COUNT(*) AS loaded_rows, 'MATCH' AS status
FROM src GROUP BY load_batch_id""")
_LOADLOG = f"""SELECT load_batch_id AS validation_run_id, {_AS_OF} AS validation_timestamp, 'SRC' AS stage,
  'src_daily_spending' AS table_name, 'DATA_LOAD_SUCCESS' AS check_name, 'ERROR' AS check_type, 'PASSED' AS check_status,
  COUNT(*) AS records_checked, CAST(NULL AS BIGINT) AS records_failed, CAST(NULL AS DECIMAL(18,2)) AS failure_percentage,
  'Successfully loaded ' || CAST(COUNT(*) AS VARCHAR) || ' rows' AS error_message, CAST(NULL AS VARCHAR) AS sample_failed_ids
FROM src GROUP BY load_batch_id"""
SQL["load_event_log"] = sel(_LOADLOG)
_RAW_COLUMNS = ["person_name", "spending_date", "category", "amount", "location", "description", "payment_method"]
SQL["profile_file"] = sel(" UNION ALL ".join(
    f"""SELECT load_batch_id, {i} AS ordinal, '{c}' AS column_name, 'string' AS data_type, COUNT(*) AS total_rows,
  {len(_RAW_COLUMNS)} AS total_columns FROM src GROUP BY load_batch_id""" for i, c in enumerate(_RAW_COLUMNS, 1)))
SQL["load_sample"] = sel("""SELECT src_id, person_name, spending_date, category, amount FROM src
WHERE load_batch_id = 'LOAD_20251020_000000' ORDER BY src_id LIMIT 5""")
_cols = [("src_id", "bigint", True)] + [(c, "string", False) for c in
                                        ["person_name", "spending_date", "category", "amount", "location", "description", "payment_method"]]
SQL["profile_columns"] = sel(" UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, '{t}' AS data_type, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count,
  {pct_i(f'COUNT(*) FILTER (WHERE {c} IS NULL)', 'COUNT(*)')} AS null_pct, COUNT({c}) AS non_null_count,
  CAST(MIN({c}) AS VARCHAR) AS min_value, CAST(MAX({c}) AS VARCHAR) AS max_value,
  {f'CAST(SUM({c}) AS DECIMAL(38,0))' if num else 'CAST(NULL AS DECIMAL(38,0))'} AS sum_value,
  {qdiv(f'SUM({c})', f'COUNT({c})', 2) if num else 'CAST(NULL AS DECIMAL(18,2))'} AS mean_value FROM src"""
    for c, t, num in _cols))
SQL["profile_integrity"] = sel("""SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE amount_p < 0) AS negative_amounts,
  (SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) FROM (SELECT COUNT(*) AS n FROM src
     GROUP BY person_name, spending_date, category, amount, location, description, payment_method)) AS duplicate_rows,
  COUNT(*) FILTER (WHERE date_p IS NULL) AS invalid_dates FROM stg0""")
SQL["profile_value_counts"] = sel("""SELECT 'person_name' AS field, person_name AS value, COUNT(*) AS row_count,
  CAST(NULL AS INTEGER) AS rank FROM src GROUP BY person_name UNION ALL """ + " UNION ALL ".join(
    f"""SELECT * FROM (SELECT '{c}' AS field, {c} AS value, COUNT(*) AS row_count,
  CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, {c} NULLS FIRST) AS INTEGER) AS rank FROM src GROUP BY {c}) WHERE rank <= 5"""
    for c in ["category", "payment_method"]))

_RUN = f"'VAL_20251022_000000' AS validation_run_id, {_AS_OF} AS validation_timestamp, 'SRC' AS stage, 'src_daily_spending' AS table_name"


def _chk(name, ctype, cond, den, msg, sample_expr="CAST(src_id AS VARCHAR)"):
    where = f"WHERE {den}" if den else ""
    f = f"COUNT(*) FILTER (WHERE {cond})"
    return f"""SELECT {_RUN}, '{name}' AS check_name, '{ctype}' AS check_type,
  CASE WHEN {f} = 0 THEN 'PASSED' ELSE 'FAILED' END AS check_status, COUNT(*) AS records_checked,
  {f} AS records_failed, {qdiv(f'100 * {f}', 'COUNT(*)', 2)} AS failure_percentage, '{msg}' AS error_message,
  (SELECT string_agg(t, ', ' ORDER BY src_id) FROM (SELECT src_id, {sample_expr} AS t FROM src WHERE {cond}
     ORDER BY src_id LIMIT 10)) AS sample_failed_ids
FROM src {where}"""


_bl = lambda x: f"trim({x}) = ''"
_CHECKS = {
    "chk_null_required": _chk("NULL_CHECK_REQUIRED_FIELDS", "ERROR",
                              "person_name IS NULL OR spending_date IS NULL OR category IS NULL OR amount IS NULL", None,
                              "Critical fields (person_name, spending_date, category, amount) cannot be NULL"),
    "chk_empty_string": _chk("EMPTY_STRING_CHECK", "ERROR",
                             f"{_bl('person_name')} OR {_bl('spending_date')} OR {_bl('category')} OR {_bl('amount')}",
                             "person_name IS NOT NULL", "Required fields cannot be empty strings or whitespace"),
    "chk_metadata": _chk("METADATA_COMPLETENESS_CHECK", "ERROR", "source_file IS NULL OR load_batch_id IS NULL", None,
                         "ETL metadata (source_file, load_batch_id) must not be NULL"),
    "chk_amount_format": _chk("AMOUNT_FORMAT_CHECK", "WARNING", "NOT regexp_matches(amount, '^[0-9.,$ SGD]+$')",
                              "amount IS NOT NULL",
                              "Amount field contains unusual characters or format (expected: numbers, dots, commas, $, SGD)",
                              "CAST(src_id AS VARCHAR) || ':' || amount"),
    "chk_optional_fields": _chk("OPTIONAL_FIELDS_COMPLETENESS", "WARNING",
                                "location IS NULL OR description IS NULL OR payment_method IS NULL", None,
                                "Optional fields (location, description, payment_method) have missing values"),
}
_CHECKS["chk_duplicates"] = f"""SELECT {_RUN}, 'DUPLICATE_RECORDS_CHECK' AS check_name, 'ERROR' AS check_type,
  CASE WHEN COUNT(*) = 0 THEN 'PASSED' ELSE 'FAILED' END AS check_status, (SELECT COUNT(*) FROM src) AS records_checked,
  CAST(COALESCE(SUM(dup_count), 0) AS BIGINT) AS records_failed,
  {qdiv('100 * COALESCE(SUM(dup_count), 0)', '(SELECT COUNT(*) FROM src)', 2)} AS failure_percentage,
  'Duplicate records found based on (person_name, spending_date, category, amount, location)' AS error_message,
  (SELECT string_agg(substring(ids, 1, 50), '; ' ORDER BY first_id)
     FROM (SELECT * FROM dups ORDER BY first_id LIMIT 3)) AS sample_failed_ids
FROM dups"""
_CHECKS["chk_freshness"] = f"""SELECT {_RUN}, 'DATA_FRESHNESS_CHECK' AS check_name, 'WARNING' AS check_type,
  CASE WHEN secs < 48 * 3600 THEN 'PASSED' ELSE 'FAILED' END AS check_status, CAST(1 AS BIGINT) AS records_checked,
  CAST(CASE WHEN secs >= 48 * 3600 THEN 1 ELSE 0 END AS BIGINT) AS records_failed,
  CAST(CASE WHEN secs >= 48 * 3600 THEN 100 ELSE 0 END AS DECIMAL(18,2)) AS failure_percentage,
  'Data is older than 48 hours. Last load: ' || strftime(m, '%Y-%m-%d %H:%M:%S') || ' (' || CAST({qdiv('secs', '3600', 1)} AS VARCHAR) || ' hours ago)' AS error_message,
  CAST(NULL AS VARCHAR) AS sample_failed_ids
FROM (SELECT MAX(loaded_at) AS m, date_diff('second', MAX(loaded_at), {_AS_OF}) AS secs FROM src)"""
_DUPS = """dups AS (SELECT person_name, spending_date, category, amount, location, COUNT(*) AS dup_count,
  MIN(src_id) AS first_id, string_agg(CAST(src_id AS VARCHAR), ', ' ORDER BY src_id) AS ids
  FROM src GROUP BY person_name, spending_date, category, amount, location HAVING COUNT(*) > 1)"""
WC = _wc(_DUPS)
for _k, _q in _CHECKS.items():
    SQL[_k] = WC + _q
_LOG = "chk_log AS (" + " UNION ALL ".join(f"({q})" for q in _CHECKS.values()) + ")"
_VLOG = f"vlog AS (SELECT * FROM chk_log UNION ALL ({_LOADLOG}))"
WL = _wc(_DUPS, _LOG, _VLOG)
SQL["check_log_union"] = WL + "SELECT * FROM chk_log"
SQL["latest_validation_summary"] = WL + f"""SELECT stage, table_name, COUNT(*) AS total_checks,
  COUNT(*) FILTER (WHERE check_status = 'PASSED') AS checks_passed, COUNT(*) FILTER (WHERE check_status = 'FAILED') AS checks_failed,
  COUNT(*) FILTER (WHERE check_type = 'ERROR' AND check_status = 'FAILED') AS errors,
  COUNT(*) FILTER (WHERE check_type = 'WARNING' AND check_status = 'FAILED') AS warnings,
  {pct_i("COUNT(*) FILTER (WHERE check_status = 'PASSED')", 'COUNT(*)')} AS pass_rate_pct
FROM vlog WHERE validation_run_id = (SELECT MAX(validation_run_id) FROM vlog) GROUP BY stage, table_name"""
SQL["validation_by_type"] = WL + f"""SELECT check_type, COUNT(*) AS total_checks,
  COUNT(*) FILTER (WHERE check_status = 'PASSED') AS passed, COUNT(*) FILTER (WHERE check_status = 'FAILED') AS failed,
  {pct_i("COUNT(*) FILTER (WHERE check_status = 'PASSED')", 'COUNT(*)')} AS pass_rate_pct
FROM vlog WHERE validation_run_id = 'VAL_20251022_000000' GROUP BY check_type"""
SQL["validation_failed_detail"] = WL + """SELECT check_name, check_type, records_checked, records_failed,
  failure_percentage, error_message, sample_failed_ids, CASE WHEN check_type = 'ERROR' THEN 1 ELSE 2 END AS severity_order
FROM vlog WHERE validation_run_id = 'VAL_20251022_000000' AND check_status = 'FAILED'"""
SQL["validation_gate"] = WL + """SELECT errors, warnings,
  CASE WHEN errors > 0 THEN 'STOP' WHEN warnings > 0 THEN 'CAUTION' ELSE 'CLEAR' END AS decision, errors = 0 AS proceed
FROM (SELECT CAST(COALESCE(SUM(e), 0) AS BIGINT) AS errors, CAST(COALESCE(SUM(w), 0) AS BIGINT) AS warnings FROM (
  SELECT COUNT(*) FILTER (WHERE check_type = 'ERROR' AND check_status = 'FAILED') AS e,
         COUNT(*) FILTER (WHERE check_type = 'WARNING' AND check_status = 'FAILED') AS w
  FROM vlog WHERE validation_run_id = (SELECT MAX(validation_run_id) FROM vlog) GROUP BY stage, table_name))"""

# -- curated snapshots ------------------------------------------------------------------
_T = f"{money('SUM(amount_cleaned)')}"
SQL["next_version"] = sel("""SELECT COALESCE(MAX(snapshot_version), 0) + 1 AS next_version,
  COUNT(DISTINCT snapshot_version) AS version_count, MAX(snapshot_version) AS current_latest FROM curated""")
SQL["snapshot_precheck"] = sel("""SELECT COUNT(*) AS stg_rows, COUNT(*) > 0 AS stg_not_empty, MIN(spending_date) AS min_date,
  MAX(spending_date) AS max_date, COUNT(DISTINCT person_name) AS distinct_persons,
  COUNT(DISTINCT category_name) AS distinct_categories,
  COUNT(*) FILTER (WHERE coalesce(amount_cleaned < 0, true)) AS bad_amounts FROM complete""")
SQL["create_snapshot"] = sel("SELECT * FROM curated")
SQL["snapshot_verify"] = sel("""SELECT 2 AS snapshot_version, (SELECT COUNT(*) FROM complete) AS staging_rows,
  COUNT(*) FILTER (WHERE snapshot_version = 2) AS found_rows,
  COUNT(DISTINCT CASE WHEN is_latest = 1 THEN snapshot_version END) AS latest_versions,
  COUNT(DISTINCT CASE WHEN is_latest = 1 THEN snapshot_version END) = 1 AS one_latest FROM curated""")
SQL["snapshot_stats"] = sel("""SELECT COUNT(DISTINCT snapshot_version) AS total_versions, COUNT(*) AS total_rows,
  COUNT(*) FILTER (WHERE is_latest = 1) AS latest_rows, COUNT(*) FILTER (WHERE is_latest = 0) AS historical_rows FROM curated""")
SQL["snapshot_growth"] = sel(f"""SELECT snapshot_version, snapshot_date, record_count, prev_count,
  record_count - COALESCE(prev_count, 0) AS growth,
  CASE WHEN prev_count IS NULL THEN CAST(0 AS DECIMAL(18,2)) ELSE {qdiv('100 * (record_count - prev_count)', 'prev_count', 2)} END AS growth_pct
FROM (SELECT snapshot_version, snapshot_date, COUNT(*) AS record_count,
        LAG(COUNT(*)) OVER (ORDER BY snapshot_version) AS prev_count FROM curated GROUP BY snapshot_version, snapshot_date)
ORDER BY snapshot_version DESC LIMIT 5""")
SQL["snapshot_prune"] = sel("""SELECT snapshot_version, snapshot_date, COUNT(*) AS rows_to_drop FROM curated
WHERE snapshot_date < DATE '2025-10-22' - INTERVAL 30 DAY AND is_latest = 0 GROUP BY snapshot_version, snapshot_date""")
SQL["hq01_latest"] = sel("""SELECT person_name, category_name, spending_date, amount_cleaned, description FROM latest
ORDER BY spending_date DESC, stg_spending_id DESC LIMIT 100""")
SQL["hq02_version"] = sel("""SELECT person_name, category_name, spending_date, amount_cleaned FROM curated
WHERE snapshot_version = 1 ORDER BY spending_date DESC, stg_spending_id DESC LIMIT 100""")
SQL["hq03_versions"] = sel(f"""SELECT snapshot_version, snapshot_date, is_latest, COUNT(*) AS record_count,
  MIN(spending_date) AS earliest_transaction, MAX(spending_date) AS latest_transaction, {_T} AS total_amount,
  {avg_i('data_quality_score')} AS avg_quality_score FROM curated GROUP BY snapshot_version, snapshot_date, is_latest""")
SQL["hq04_top_categories"] = sel(f"""SELECT category_name, category_group, COUNT(*) AS transaction_count,
  {_T} AS total_spent, {avg_c('amount_cleaned')} AS avg_transaction, {money('MIN(amount_cleaned)')} AS min_spent,
  {money('MAX(amount_cleaned)')} AS max_spent FROM latest GROUP BY category_name, category_group
ORDER BY total_spent DESC, category_name LIMIT 10""")
SQL["hq05_person"] = sel(f"""SELECT person_name, COUNT(*) AS transaction_count, {_T} AS total_spent,
  {avg_c('amount_cleaned')} AS avg_per_transaction, COUNT(DISTINCT category_name) AS unique_categories,
  COUNT(DISTINCT payment_method_name) AS payment_methods_used FROM latest GROUP BY person_name""")
SQL["hq06_monthly"] = sel(f"""SELECT spending_year, spending_month, COUNT(*) AS transaction_count, {_T} AS total_spent,
  {avg_c('amount_cleaned')} AS avg_transaction, COUNT(DISTINCT person_name) AS active_persons
FROM latest GROUP BY spending_year, spending_month""")
SQL["hq07_weekday"] = sel(f"""SELECT spending_day_of_week,
  CASE spending_day_of_week WHEN 1 THEN 'Monday' WHEN 2 THEN 'Tuesday' WHEN 3 THEN 'Wednesday' WHEN 4 THEN 'Thursday'
    WHEN 5 THEN 'Friday' WHEN 6 THEN 'Saturday' WHEN 7 THEN 'Sunday' END AS day_name,
  COUNT(*) AS transaction_count, {_T} AS total_spent, {avg_c('amount_cleaned')} AS avg_per_transaction
FROM latest GROUP BY spending_day_of_week""")
SQL["hq08_top_locations"] = sel(f"""SELECT location_name, location_type, COUNT(*) AS visit_count, {_T} AS total_spent,
  {avg_c('amount_cleaned')} AS avg_per_visit FROM latest WHERE location_name IS NOT NULL
GROUP BY location_name, location_type ORDER BY total_spent DESC, location_name LIMIT 20""")
_VS = f"vs AS (SELECT snapshot_version, snapshot_date, COUNT(*) AS record_count, {_T} AS total_spending FROM curated GROUP BY 1, 2)"
SQL["hq09_compare_adjacent"] = _wc(_VS) + f"""SELECT v1.snapshot_version AS older_version, v1.snapshot_date AS older_date,
  v1.record_count AS older_records, v1.total_spending AS older_spending, v2.snapshot_version AS newer_version,
  v2.snapshot_date AS newer_date, v2.record_count AS newer_records, v2.total_spending AS newer_spending,
  v2.record_count - v1.record_count AS record_growth, {money('v2.total_spending - v1.total_spending')} AS spending_growth,
  {qdiv('100 * (v2.record_count - v1.record_count)', 'v1.record_count', 2)} AS growth_pct
FROM vs v1, vs v2 WHERE v2.snapshot_version = v1.snapshot_version + 1"""
SQL["hq10_version_growth"] = _wc(_VS) + f"""SELECT snapshot_version, snapshot_date, record_count, total_spending,
  CASE WHEN pc IS NULL THEN record_count ELSE record_count - pc END AS record_growth,
  {money('CASE WHEN ps IS NULL THEN total_spending ELSE total_spending - ps END')} AS spending_growth
FROM (SELECT *, LAG(record_count) OVER (ORDER BY snapshot_version) AS pc,
        LAG(total_spending) OVER (ORDER BY snapshot_version) AS ps FROM vs)"""
SQL["hq11_new_per_version"] = sel(f"""SELECT v.snapshot_version, COUNT(*) AS new_transaction_count,
  {money('SUM(v.amount_cleaned)')} AS new_spending_amount, MIN(v.spending_date) AS earliest_new_transaction,
  MAX(v.spending_date) AS latest_new_transaction
FROM curated v LEFT JOIN curated prev ON v.stg_spending_id = prev.stg_spending_id
  AND prev.snapshot_version = v.snapshot_version - 1
WHERE prev.stg_spending_id IS NULL GROUP BY v.snapshot_version""")
SQL["hq12_person_category"] = sel(f"""SELECT person_name, category_name, COUNT(*) AS transaction_count, {_T} AS total_spent,
  {avg_c('amount_cleaned')} AS avg_per_transaction FROM latest GROUP BY person_name, category_name""")
SQL["hq13_payment_pref"] = sel(f"""SELECT person_name, payment_method_name, payment_type, COUNT(*) AS usage_count,
  {_T} AS total_spent, {avg_c('amount_cleaned')} AS avg_transaction FROM latest
GROUP BY person_name, payment_method_name, payment_type""")
SQL["hq14_high_value"] = sel("""SELECT person_name, spending_date, category_name, location_name, amount_cleaned,
  description, payment_method_name FROM latest ORDER BY amount_cleaned DESC, stg_spending_id LIMIT 50""")
SQL["hq15_quarterly"] = sel(f"""SELECT spending_year, spending_quarter, COUNT(*) AS transaction_count, {_T} AS total_spent,
  {avg_c('amount_cleaned')} AS avg_transaction, COUNT(DISTINCT person_name) AS active_persons,
  COUNT(DISTINCT category_name) AS categories_used FROM latest GROUP BY spending_year, spending_quarter""")


def _bands_sql(labels):
    case = (f"CASE WHEN data_quality_score >= 90 THEN '{labels[0]}' WHEN data_quality_score >= 80 THEN '{labels[1]}' "
            f"WHEN data_quality_score >= 70 THEN '{labels[2]}' WHEN data_quality_score >= 60 THEN '{labels[3]}' "
            f"WHEN data_quality_score >= 50 THEN '{labels[4]}' ELSE '{labels[5]}' END")
    return sel(f"""SELECT quality_grade, record_count, {qdiv('100 * record_count', '(SELECT COUNT(*) FROM latest)', 2)} AS percentage
FROM (SELECT {case} AS quality_grade, COUNT(*) AS record_count FROM latest GROUP BY 1)""")


SQL["hq16_quality_grades"] = _bands_sql(["A+ (90-100)", "A (80-89)", "B (70-79)", "C (60-69)", "D (50-59)", "F (<50)"])
SQL["cv_quality_bands"] = _bands_sql(["A+ (90-100)", "A  (80-89)", "B  (70-79)", "C  (60-69)", "D  (50-59)", "F  (<50)"])
SQL["hq17_quality_category"] = sel(f"""SELECT category_name, COUNT(*) AS record_count,
  {avg_i('data_quality_score')} AS avg_quality_score, MIN(data_quality_score) AS min_quality,
  MAX(data_quality_score) AS max_quality FROM latest GROUP BY category_name""")
SQL["hq18_person_versions"] = sel(f"""SELECT snapshot_version, snapshot_date, person_name, COUNT(*) AS transaction_count,
  {_T} AS total_spent, {avg_c('amount_cleaned')} AS avg_per_transaction FROM curated WHERE person_name = '{P['person']}'
GROUP BY snapshot_version, snapshot_date, person_name""")
SQL["hq19_category_versions"] = sel(f"""SELECT snapshot_version, snapshot_date, category_name, COUNT(*) AS transaction_count,
  {_T} AS total_spent FROM curated WHERE category_name = '{P['category']}' GROUP BY snapshot_version, snapshot_date, category_name""")
SQL["hq20_as_of_date"] = sel(f"""SELECT snapshot_version, snapshot_date, COUNT(*) AS total_transactions, {_T} AS total_spending,
  COUNT(DISTINCT person_name) AS unique_persons, COUNT(DISTINCT category_name) AS unique_categories,
  MIN(spending_date) AS earliest_transaction, MAX(spending_date) AS latest_transaction
FROM curated WHERE snapshot_date = DATE '2025-10-21' GROUP BY snapshot_version, snapshot_date""")
SQL["hq21_export"] = sel("""SELECT snapshot_version, snapshot_date, person_name, category_name, category_group,
  location_name, location_type, payment_method_name, payment_type, spending_date, spending_year, spending_month,
  spending_quarter, spending_day_of_week, amount_cleaned, currency_code, description, data_quality_score FROM latest""")
SQL["hq22_diff_versions"] = sel("""SELECT COALESCE(v1.stg_spending_id, v2.stg_spending_id) AS spending_id,
  v1.person_name AS v1_person, v2.person_name AS v2_person, v1.category_name AS v1_category, v2.category_name AS v2_category,
  v1.spending_date AS v1_date, v2.spending_date AS v2_date, v1.amount_cleaned AS v1_amount, v2.amount_cleaned AS v2_amount,
  CASE WHEN v1.stg_spending_id IS NULL THEN 'New in V2' WHEN v2.stg_spending_id IS NULL THEN 'Removed in V2'
       ELSE 'Exists in Both' END AS status
FROM (SELECT * FROM curated WHERE snapshot_version = 1) v1
FULL OUTER JOIN (SELECT * FROM curated WHERE snapshot_version = 2) v2 ON v1.stg_spending_id = v2.stg_spending_id""")
SQL["cur_time_travel_sum"] = sel(f"""SELECT person_name, category_name, {_T} AS total_spent, COUNT(*) AS transaction_count
FROM curated WHERE snapshot_version = 1 GROUP BY person_name, category_name""")
SQL["cur_version_totals"] = sel(f"""SELECT snapshot_version, COUNT(*) AS record_count, {_T} AS total_spending
FROM curated GROUP BY snapshot_version""")
SQL["cv_latest_integrity"] = sel("""SELECT COUNT(DISTINCT CASE WHEN is_latest = 1 THEN snapshot_version END) AS latest_versions,
  MAX(CASE WHEN is_latest = 1 THEN snapshot_version END) AS latest_version,
  MAX(CASE WHEN is_latest = 1 THEN snapshot_date END) AS latest_snapshot_date,
  COUNT(*) FILTER (WHERE is_latest = 1) AS latest_rows, COUNT(*) FILTER (WHERE is_latest NOT IN (0, 1)) AS invalid_flags
FROM curated""")
_REQ = ["snapshot_version", "snapshot_date", "stg_spending_id", "person_id", "category_id", "spending_date", "amount_cleaned"]
_DEN = ["person_name", "category_name", "location_name", "payment_method_name"]
SQL["cv_completeness"] = sel(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{k}' AS kind, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count, COUNT(*) AS total_records FROM curated"
    for k, cols in (("required", _REQ), ("denormalised", _DEN)) for c in cols))
SQL["cv_stg_consistency"] = sel("""SELECT (SELECT COUNT(*) FROM fact) AS stg_count, COUNT(*) AS curated_latest_count,
  (SELECT COUNT(*) FROM fact) = COUNT(*) AS counts_match,
  (SELECT COUNT(*) FROM fact s WHERE NOT EXISTS (SELECT 1 FROM latest c WHERE c.stg_spending_id = s.spending_id)) AS missing_in_curated
FROM latest""")
SQL["cv_version_history"] = sel("""SELECT snapshot_version, snapshot_date, is_latest, record_count, earliest_transaction,
  latest_transaction, (SELECT COUNT(DISTINCT snapshot_version) FROM curated) AS total_versions,
  (SELECT MIN(snapshot_version) FROM curated) AS first_version, (SELECT MAX(snapshot_version) FROM curated) AS latest_version,
  (SELECT COUNT(*) FROM curated) AS total_records,
  (SELECT COUNT(*) FROM curated) // (SELECT COUNT(DISTINCT snapshot_version) FROM curated) AS avg_records_per_version
FROM (SELECT snapshot_version, snapshot_date, is_latest, COUNT(*) AS record_count, MIN(spending_date) AS earliest_transaction,
        MAX(spending_date) AS latest_transaction FROM curated GROUP BY 1, 2, 3 ORDER BY snapshot_version DESC LIMIT 10)""")
SQL["cv_growth_pct"] = sel(f"""SELECT snapshot_version, record_count,
  CASE WHEN pc IS NULL THEN record_count ELSE record_count - pc END AS growth,
  CASE WHEN pc IS NULL THEN CAST(0 AS DECIMAL(18,2)) ELSE {qdiv('100 * (record_count - pc)', 'pc', 2)} END AS growth_pct
FROM (SELECT snapshot_version, COUNT(*) AS record_count, LAG(COUNT(*)) OVER (ORDER BY snapshot_version) AS pc
      FROM curated GROUP BY snapshot_version) ORDER BY snapshot_version DESC LIMIT 5""")
SQL["cv_date_ranges"] = sel("""SELECT MIN(spending_date) AS earliest_transaction, MAX(spending_date) AS latest_transaction,
  MIN(snapshot_date) AS first_snapshot, MAX(snapshot_date) AS latest_snapshot,
  CAST(MAX(snapshot_date) - MIN(snapshot_date) AS INTEGER) AS snapshot_span_days,
  CAST(MAX(spending_date) - MIN(spending_date) AS INTEGER) AS transaction_span_days,
  COUNT(*) FILTER (WHERE spending_date > DATE '2025-10-22') AS future_rows,
  COUNT(*) FILTER (WHERE spending_date < DATE '2020-01-01') AS rows_before_2020 FROM curated""")
SQL["cv_quality_stats"] = sel(f"""SELECT *, CASE WHEN avg_score >= 80 THEN 'PASS' WHEN avg_score >= 70 THEN 'WARN' ELSE 'FAIL' END AS status
FROM (SELECT COUNT(*) AS total_records, {avg_i('data_quality_score')} AS avg_score, MIN(data_quality_score) AS min_score,
  MAX(data_quality_score) AS max_score, CAST(ROUND(stddev_samp(data_quality_score), 2) AS DECIMAL(18,2)) AS std_dev FROM latest)""")
SQL["cv_low_quality"] = sel(f"""SELECT low_quality_rows, total_rows, {qdiv('100 * low_quality_rows', 'total_rows', 2)} AS low_quality_pct
FROM (SELECT COUNT(*) FILTER (WHERE data_quality_score < 70) AS low_quality_rows, COUNT(*) AS total_rows FROM latest)""")
SQL["cv_quality_by_version"] = sel(f"""SELECT snapshot_version, COUNT(*) AS records, {avg_i('data_quality_score')} AS avg_score,
  MIN(data_quality_score) AS min_score, MAX(data_quality_score) AS max_score FROM curated GROUP BY snapshot_version
ORDER BY snapshot_version DESC LIMIT 5""")
SQL["cv_version_count_advice"] = sel("""SELECT version_count, CASE WHEN version_count > 30 THEN 'ARCHIVE'
  WHEN version_count > 10 THEN 'MONITOR' ELSE 'OK' END AS advice
FROM (SELECT COUNT(DISTINCT snapshot_version) AS version_count FROM curated)""")
_DUPV = "dv AS (SELECT snapshot_version, stg_spending_id, COUNT(*) AS duplicate_count FROM curated GROUP BY 1, 2 HAVING COUNT(*) > 1)"
SQL["cv_duplicate_ids"] = _wc(_DUPV) + """SELECT *, (SELECT CAST(COALESCE(SUM(duplicate_count - 1), 0) AS BIGINT) FROM dv) AS extra_copies_total
FROM (SELECT * FROM dv ORDER BY snapshot_version DESC, duplicate_count DESC, stg_spending_id LIMIT 20)"""
SQL["cv_cross_version_ids"] = sel("""SELECT stg_spending_id, COUNT(DISTINCT snapshot_version) AS version_count FROM curated
GROUP BY stg_spending_id HAVING COUNT(DISTINCT snapshot_version) > 1""")
_ISS = []
_ISS.append(("lv = 0", "'No latest version'", True))
_ISS.append(("lv > 1", "'Multiple versions (' || CAST(lv AS VARCHAR) || ') have is_latest = 1'", True))
_ISS.append(("inv > 0", "CAST(inv AS VARCHAR) || ' records with invalid is_latest values'", True))
for _c in _REQ:
    _ISS.append((f"n_{_c} > 0", f"CAST(n_{_c} AS VARCHAR) || ' NULL values in {_c}'", True))
_ISS.append(("stg_n <> cur_n", "'STG/CURATED count mismatch: ' || CAST(abs(stg_n - cur_n) AS VARCHAR) || ' records'", True))
_ISS.append(("miss > 0", "CAST(miss AS VARCHAR) || ' STG records not in CURATED'", True))
_ISS.append(("fut > 0", "CAST(fut AS VARCHAR) || ' records with future dates'", False))
_ISS.append(("low > 0", "CAST(low AS VARCHAR) || ' records with low quality scores'", False))
_ISS.append(("dups > 0", "CAST(dups AS VARCHAR) || ' duplicate stg_spending_ids found'", True))
_FACTS = ("facts AS (SELECT (SELECT COUNT(DISTINCT snapshot_version) FROM curated WHERE is_latest = 1) AS lv, "
          "(SELECT COUNT(*) FROM curated WHERE is_latest NOT IN (0, 1)) AS inv, "
          + ", ".join(f"(SELECT COUNT(*) FROM curated WHERE {c} IS NULL) AS n_{c}" for c in _REQ)
          + ", (SELECT COUNT(*) FROM fact) AS stg_n, (SELECT COUNT(*) FROM latest) AS cur_n, "
          "(SELECT COUNT(*) FROM fact s WHERE NOT EXISTS (SELECT 1 FROM latest c WHERE c.stg_spending_id = s.spending_id)) AS miss, "
          "(SELECT COUNT(*) FROM curated WHERE spending_date > DATE '2025-10-22') AS fut, "
          "(SELECT COUNT(*) FROM latest WHERE data_quality_score < 70) AS low, "
          "(SELECT COUNT(*) FROM (SELECT 1 FROM curated GROUP BY snapshot_version, stg_spending_id HAVING COUNT(*) > 1)) AS dups)")
_ISSUES = "iss AS (" + " UNION ALL ".join(
    f"SELECT CASE WHEN {c} THEN {t} END AS issue, ({c}) AND {str(f).upper()} AS fails FROM facts" for c, t, f in _ISS) + ")"
SQL["cv_verdict"] = _wc(_FACTS, _ISSUES) + """SELECT NOT bool_or(fails) AS validation_passed, COUNT(issue) AS issue_count,
  string_agg(issue, '; ' ORDER BY issue) AS issues FROM iss"""

# -- staging quality report and mart validation -----------------------------------------
_DL = [("person", "Persons", "person_id"), ("location", "Locations", "location_id"),
       ("category", "Categories", "category_id"), ("payment_method", "Payment Methods", "payment_method_id")]
SQL["dq_table_counts"] = sel(" UNION ALL ".join(
    [f"SELECT '{lab}' AS dimension, COUNT(*) AS count, 'stg_dim_{k}' AS table_name FROM dim_{k}" for k, lab, _ in _DL]
    + ["SELECT 'Spending Facts', COUNT(*), 'stg_fact_spending' FROM fact",
       "SELECT 'Source Records', COUNT(*), 'src_daily_spending' FROM src"]))
_CP = qdiv("100 * (SELECT COUNT(*) FROM fact)", "(SELECT COUNT(*) FROM src)", 2)
SQL["dq_completeness"] = sel(f"""SELECT *, CASE WHEN completeness_pct = 100 THEN 'PASS' WHEN completeness_pct >= 95 THEN 'WARN'
  ELSE 'FAIL' END AS status FROM (SELECT (SELECT COUNT(*) FROM fact) AS fact_rows, (SELECT COUNT(*) FROM src) AS source_rows,
  {_CP} AS completeness_pct)""")
SQL["dq_null_counts"] = sel("SELECT COUNT(*) AS total_records, " + ", ".join(
    f"COUNT(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in
    ["person_id", "location_id", "category_id", "payment_method_id", "spending_date", "amount_cleaned"]) + " FROM fact")
SQL["dq_score_distribution"] = sel(f"""SELECT *, CASE WHEN avg_score >= 95 THEN 'PASS' WHEN avg_score >= 85 THEN 'WARN' ELSE 'FAIL' END AS status
FROM (SELECT COUNT(*) AS total_records, {avg_i('data_quality_score')} AS avg_score, MIN(data_quality_score) AS min_score,
  MAX(data_quality_score) AS max_score, COUNT(*) FILTER (WHERE data_quality_score = 100) AS perfect_score_count,
  COUNT(*) FILTER (WHERE data_quality_score >= 90) AS high_quality_count,
  COUNT(*) FILTER (WHERE data_quality_score >= 70) AS good_quality_count,
  COUNT(*) FILTER (WHERE data_quality_score < 70) AS poor_quality_count FROM fact)""")
SQL["dq_amount_validity"] = sel(f"""SELECT *, CASE WHEN negative_or_zero = 0 AND min_amount > 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT COUNT(*) AS total_records, COUNT(*) FILTER (WHERE amount_cleaned <= 0) AS negative_or_zero,
  COUNT(*) FILTER (WHERE amount_cleaned > 10000) AS extremely_high, {money('MIN(amount_cleaned)')} AS min_amount,
  {money('MAX(amount_cleaned)')} AS max_amount, {avg_c('amount_cleaned')} AS avg_amount,
  {qdiv(f"CAST(2 * quantile_cont({cents('amount_cleaned')}, 0.5) AS HUGEINT)", '200', 2)} AS median_amount FROM fact)""")
SQL["dq_date_validity"] = sel("""SELECT MIN(spending_date) AS min_date, MAX(spending_date) AS max_date,
  COUNT(DISTINCT spending_date) AS unique_dates, COUNT(*) FILTER (WHERE spending_date > DATE '2025-10-22') AS future_dates FROM fact""")
_FKL = {"person": "Person FK", "location": "Location FK", "category": "Category FK", "payment_method": "Payment Method FK"}
SQL["dq_fk_orphans"] = sel(" UNION ALL ".join(
    f"SELECT '{_FKL[k]}' AS check_name, COUNT(*) AS orphan_count FROM fact f WHERE NOT EXISTS "
    f"(SELECT 1 FROM dim_{k} d WHERE d.{key} = f.{key})" for k, _l, key in _DL))
SQL["dq_unused_dims"] = sel(" UNION ALL ".join(
    f"SELECT '{lab}' AS dimension, COUNT(*) AS unused_count FROM dim_{k} d WHERE NOT EXISTS "
    f"(SELECT 1 FROM fact f WHERE f.{key} = d.{key})" for k, lab, key in _DL))
SQL["dq_person_spending"] = sel(f"""SELECT person_name, COUNT(*) AS transaction_count, {_T} AS total_spending,
  {avg_c('amount_cleaned')} AS avg_transaction, MIN(spending_date) AS first_transaction, MAX(spending_date) AS last_transaction
FROM complete GROUP BY person_name""")
_TOTC = cents("(SELECT SUM(amount_cleaned) FROM complete)")
SQL["dq_category_spending"] = sel(f"""SELECT category_name, category_group, COUNT(*) AS transactions, {_T} AS total_amount,
  {avg_c('amount_cleaned')} AS avg_amount, {qdiv(f"100 * SUM({cents('amount_cleaned')})", _TOTC, 2)} AS percentage
FROM complete GROUP BY category_name, category_group""")
SQL["dq_location_type"] = sel(f"""SELECT location_type, COUNT(*) AS transactions, {_T} AS total_amount,
  {avg_c('amount_cleaned')} AS avg_amount, {qdiv(f"100 * SUM({cents('amount_cleaned')})", _TOTC, 2)} AS percentage
FROM complete GROUP BY location_type""")
SQL["dq_payment_usage"] = sel(f"""SELECT payment_method_name, payment_type, COUNT(*) AS transactions, {_T} AS total_amount,
  {qdiv('100 * COUNT(*)', '(SELECT COUNT(*) FROM complete)', 2)} AS usage_percentage
FROM complete GROUP BY payment_method_name, payment_type ORDER BY transactions DESC, payment_method_name LIMIT 10""")
SQL["dq_monthly_trend"] = sel(f"""SELECT strftime(spending_date, '%Y-%m') AS month, COUNT(*) AS transactions, {_T} AS total_amount,
  {avg_c('amount_cleaned')} AS avg_amount FROM fact WHERE spending_date >= DATE '2001-09-01' - INTERVAL 12 MONTH
GROUP BY 1 ORDER BY month DESC LIMIT 12""")
SQL["dq_summary"] = sel(f"""SELECT (SELECT COUNT(*) FROM dim_person) AS total_persons, (SELECT COUNT(*) FROM dim_location) AS total_locations,
  (SELECT COUNT(*) FROM dim_category) AS total_categories, (SELECT COUNT(*) FROM dim_payment_method) AS total_payment_methods,
  COUNT(*) AS total_transactions, {_T} AS total_amount, {avg_i('data_quality_score')} AS avg_quality_score FROM fact""")
SQL["dq_grade"] = sel(f"""SELECT *, CASE WHEN completeness_pct = 100 AND avg_quality_score >= 95 THEN 'A+ (Excellent)'
  WHEN completeness_pct >= 95 AND avg_quality_score >= 85 THEN 'A (Very Good)'
  WHEN completeness_pct >= 90 AND avg_quality_score >= 75 THEN 'B (Good)' ELSE 'C or below (Needs Improvement)' END AS grade
FROM (SELECT {_CP} AS completeness_pct, {avg_i('data_quality_score')} AS avg_quality_score FROM fact)""")
_MARTS = [("dst_monthly_spending_summary", "mss", "total_spending"), ("dst_category_trends", "ct", "total_spending"),
          ("dst_person_analytics", "pa", "total_spending"), ("dst_payment_method_summary", "ps", "total_amount")]
_CURT = "(SELECT CAST(SUM(amount_cleaned) AS DECIMAL(18,2)) FROM latest)"
SQL["dv_total_reconcile"] = sel(" UNION ALL ".join(
    f"""SELECT '{n}' AS mart_name, {money(f'SUM({c})')} AS mart_total, {_CURT} AS curated_total,
  {money(f'SUM({c}) - {_CURT}')} AS difference, abs(SUM({c}) - {_CURT}) < 0.01 AS match FROM {t}""" for n, t, c in _MARTS))
SQL["dv_count_reconcile"] = sel(" UNION ALL ".join(
    f"""SELECT '{n}' AS mart_name, CAST(SUM(transaction_count) AS BIGINT) AS mart_transactions,
  (SELECT COUNT(*) FROM latest) AS curated_count, SUM(transaction_count) = (SELECT COUNT(*) FROM latest) AS match FROM {t}"""
    for n, t, _c in _MARTS))
SQL["dv_record_counts"] = sel(" UNION ALL ".join(f"SELECT '{n}' AS mart_name, COUNT(*) AS record_count FROM {t}" for n, t, _c in _MARTS))
_G = " + ".join(f"SUM({c})" for c in ["essential_spending", "discretionary_spending", "transport_spending",
                                        "healthcare_spending", "education_spending", "other_spending"])
SQL["dv_group_breakdown"] = sel(f"""SELECT {money(_G)} AS groups_total, {money('SUM(total_spending)')} AS total_spending,
  {money(f'{_G} - SUM(total_spending)')} AS difference, abs({_G} - SUM(total_spending)) < 0.01 AS match FROM pa""")
_NK = [("dst_monthly_spending_summary", "mss", "person_name"), ("dst_monthly_spending_summary", "mss", "category_name"),
       ("dst_category_trends", "ct", "category_name"), ("dst_person_analytics", "pa", "person_name"),
       ("dst_payment_method_summary", "ps", "payment_method_name")]
SQL["dv_null_keys"] = sel(" UNION ALL ".join(
    f"SELECT '{n}' AS table_name, '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count FROM {t}" for n, t, c in _NK))
_PC = "(SELECT COUNT(DISTINCT person_name) FROM latest)"
SQL["dv_person_consistency"] = sel(" UNION ALL ".join(
    f"SELECT '{n}' AS table_name, COUNT(DISTINCT person_name) AS distinct_persons, COUNT(DISTINCT person_name) = {_PC} AS match FROM {t}"
    for n, t in [("curated_spending_snapshots", "latest"), ("dst_monthly_spending_summary", "mss"), ("dst_person_analytics", "pa")]))
_DVI = " UNION ALL ".join(
    [f"SELECT CASE WHEN NOT (abs(SUM({c}) - {_CURT}) < 0.01) THEN '{n} total does not match curated' END AS issue FROM {t}" for n, t, c in _MARTS]
    + [f"SELECT CASE WHEN SUM(transaction_count) <> (SELECT COUNT(*) FROM latest) THEN '{n} transaction count does not match curated' END FROM {t}" for n, t, _c in _MARTS]
    + [f"SELECT CASE WHEN NOT (abs({_G} - SUM(total_spending)) < 0.01) THEN 'category groups do not add up to total spending' END FROM pa"]
    + [f"SELECT CASE WHEN COUNT(*) FILTER (WHERE {c} IS NULL) > 0 THEN '{n}.{c} has NULL keys' END FROM {t}" for n, t, c in _NK]
    + [f"SELECT CASE WHEN COUNT(DISTINCT person_name) <> {_PC} THEN '{n} person count differs' END FROM {t}"
       for n, t in [("curated_spending_snapshots", "latest"), ("dst_monthly_spending_summary", "mss"), ("dst_person_analytics", "pa")]])
SQL["dv_verdict"] = sel(f"""SELECT COUNT(issue) = 0 AS validation_passed, COUNT(issue) AS issue_count,
  string_agg(issue, '; ' ORDER BY issue) AS issues FROM ({_DVI})""")
