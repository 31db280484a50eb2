"""Registry: one job per SURVEY 2.B key, each ``Spend -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import marts as M
from ..operators import reports as R
from ..operators import staging as G
from .pipeline import Spend

Job = Callable[[Spend], DataFrame]
JOBS: dict[str, Job] = {}


def _stg_cols(*cols):
    return lambda s: s.stg.select("src_id", *cols)


# -- staging ------------------------------------------------------------------
JOBS["clean_amount"] = _stg_cols("amount_raw", "amount_cleaned", "currency_code", "is_amount_parsed_successfully")
JOBS["clean_date"] = _stg_cols("spending_date_raw", "spending_date", "is_date_parsed_successfully")
JOBS["date_parts"] = _stg_cols("spending_date", "spending_year", "spending_month", "spending_day",
                               "spending_quarter", "spending_day_of_week")
JOBS["classify_location"] = _stg_cols("location_name", "location_type")
JOBS["classify_payment"] = _stg_cols("payment_method_name", "payment_type")
JOBS["classify_category"] = _stg_cols("category_name", "category_group")
JOBS["quality_score"] = _stg_cols("data_quality_score")
JOBS["stg_transform"] = lambda s: s.stg
JOBS["stg_rejects"] = lambda s: s.rejects
JOBS["stg_reject_counts"] = lambda s: G.reject_counts(s.stg)
JOBS["stg_transform_stats"] = lambda s: R.stg_transform_stats(s.stg)
for _d in G.DIM_SPECS:
    JOBS[f"dim_{_d}"] = (lambda d: lambda s: s.dims[d])(_d)
JOBS["fact_spending"] = lambda s: s.fact.drop("load_batch_id")
JOBS["spending_complete"] = lambda s: s.complete.drop("person_id", "category_id", "location_id",
                                                       "payment_method_id", "load_batch_id")
JOBS["stg_load_stats"] = lambda s: R.stg_load_stats(s.fact, s.dims, s.src)
JOBS["stg_top_categories"] = lambda s: R.stg_top_categories(s.complete)
JOBS["stg_recent_sample"] = lambda s: R.stg_recent_sample(s.complete)
JOBS["stg_person_history"] = lambda s: R.stg_person_history(s.complete, s.cfg.person)
JOBS["stg_month_category"] = lambda s: R.stg_month_category(s.complete)
JOBS["stg_top_locations"] = lambda s: R.stg_top_locations(s.complete)
JOBS["stg_payment_analysis"] = lambda s: R.stg_payment_analysis(s.complete)

# -- marts --------------------------------------------------------------------
JOBS["mart_monthly_summary"] = lambda s: s.mss
JOBS["mart_category_trends"] = lambda s: s.ct
JOBS["mart_person_analytics"] = lambda s: s.pa
JOBS["mart_payment_summary"] = lambda s: s.ps
JOBS["mart_dashboard"] = lambda s: M.dashboard(s.mss, s.ct, s.pa, s.ps)
JOBS["trend_direction"] = lambda s: R.trend_direction_table(s.ct)
JOBS["ms_source_info"] = lambda s: R.ms_source_info(s.latest)
JOBS["ms_reconcile"] = lambda s: R.ms_reconcile(s.mss, s.latest)
JOBS["ms_stats"] = lambda s: R.ms_stats(s.mss)
JOBS["ms_top_samples"] = lambda s: R.ms_top_samples(s.mss)
JOBS["ct_top"] = lambda s: R.ct_top(s.ct)
JOBS["ct_growing"] = lambda s: R.ct_growing(s.ct, True)
JOBS["ct_declining"] = lambda s: R.ct_growing(s.ct, False)
JOBS["pa_ed_summary"] = lambda s: R.pa_ed_summary(s.pa)
JOBS["pa_top_spenders"] = lambda s: R.pa_top_spenders(s.pa)
JOBS["pa_alerts"] = lambda s: R.pa_alerts(s.pa)
JOBS["ps_market_share"] = lambda s: R.ps_market_share(s.ps)
JOBS["ps_trends"] = lambda s: R.ps_trends(s.ps)
JOBS["ps_preferences"] = lambda s: R.ps_preferences(s.ps)
JOBS["dst_ed_month"] = lambda s: R.dst_ed_month(s.pa, s.cfg)
JOBS["dst_category_mom"] = lambda s: R.dst_category_mom(s.ct, s.cfg)
JOBS["dst_person_yoy"] = lambda s: R.dst_person_yoy(s.pa, s.cfg)
JOBS["dst_rolling_year"] = lambda s: R.dst_rolling_year(s.ct, s.cfg)
JOBS["dst_top_spenders_month"] = lambda s: R.dst_top_spenders_month(s.pa, s.cfg)
JOBS["dst_fastest_growing"] = lambda s: R.dst_fastest_growing(s.ct, s.cfg)
JOBS["dst_high_discretionary"] = lambda s: R.dst_high_discretionary(s.pa)
JOBS["dst_share_year"] = lambda s: R.dst_share_year(s.ps, s.cfg)
JOBS["dst_raw_monthly_category"] = lambda s: R.dst_raw_monthly_category(s.latest)
JOBS["dst_mart_monthly_category"] = lambda s: R.dst_mart_monthly_category(s.ct, s.cfg)

# -- insight views --------------------------------------------------------------
from ..operators import insights as I  # noqa: E402

JOBS["health_scorecard"] = lambda s: I.health_scorecard(s.pa)
JOBS["spending_recommendations"] = lambda s: I.spending_recommendations(s.pa, s.mss, s.cfg)
JOBS["budget_alerts"] = lambda s: I.budget_alerts(s.pa, s.mss)
JOBS["category_insights"] = lambda s: I.category_insights(s.ct)
JOBS["lifestyle_plan"] = lambda s: I.lifestyle_plan(s.pa, s.mss)


def _h(s):
    return I.health_scorecard(s.pa)


def _rec(s):
    return I.spending_recommendations(s.pa, s.mss, s.cfg)


def _al(s):
    return I.budget_alerts(s.pa, s.mss)


def _ci(s):
    return I.category_insights(s.ct)


def _lp(s):
    return I.lifestyle_plan(s.pa, s.mss)


JOBS["x_health_bottom3"] = lambda s: I.x_health_bottom3(_h(s))
JOBS["x_top_recommendation"] = lambda s: I.x_top_recommendation(_rec(s))
JOBS["x_high_alerts"] = lambda s: I.x_high_alerts(_al(s))
JOBS["x_top_opportunities"] = lambda s: I.x_top_opportunities(_ci(s))
JOBS["x_top_plans"] = lambda s: I.x_top_plans(_lp(s))
JOBS["x_health_month"] = lambda s: I.x_health_month(_h(s), s.cfg)
JOBS["x_person_top3"] = lambda s: I.x_person_top(_rec(s), s.cfg.person, 3, [
    "priority", "recommendation_title", "recommendation_detail", "potential_monthly_savings",
    "implementation_difficulty"])
JOBS["x_alerts_high"] = lambda s: I.x_alerts_high(_al(s))
JOBS["x_opportunity_50"] = lambda s: I.x_opportunity(_ci(s), 50, 5, [
    "category_name", "total_spending", "opportunity_score", "insight_summary", "recommended_action"])
JOBS["x_plans_200"] = lambda s: I.x_plans(_lp(s), 200, [
    "person_name", "financial_health_status", "monthly_savings_potential", "action_1_priority",
    "lifestyle_change_1", "week_1_savings_target"])
JOBS["x_health_dashboard"] = lambda s: I.x_health_dashboard(_h(s), s.cfg)
JOBS["x_person_top5"] = lambda s: I.x_person_top(_rec(s), s.cfg.person, 5, [
    "priority", "recommendation_title", "category_name", "current_monthly_spending", "potential_monthly_savings",
    "implementation_difficulty"])
JOBS["x_alerts_high_medium"] = lambda s: I.x_alerts_high_medium(_al(s))
JOBS["x_opportunity_60"] = lambda s: I.x_opportunity(_ci(s), 60, None, [
    "category_name", "category_group", "total_spending", "opportunity_score", "insight_summary",
    "recommended_action"])
JOBS["x_plans_100"] = lambda s: I.x_plans(_lp(s), 100, [
    "person_name", "financial_health_status", "current_monthly_spending", "monthly_savings_potential",
    "annual_savings_potential", "action_1_priority", "action_2_priority", "action_3_priority",
    "lifestyle_change_1", "lifestyle_change_2", "week_1_savings_target"])
JOBS["x_health_with_top_rec"] = lambda s: I.x_health_with_top_rec(_h(s), _rec(s), s.cfg)

# -- ingest, profile, source checks ---------------------------------------------
from ..operators import checks as K  # noqa: E402
from ..operators import ingest as N  # noqa: E402

JOBS["ingest_raw"] = lambda s: s.src
JOBS["ingest_reconcile"] = lambda s: N.ingest_reconcile(s.offered, s.src)
JOBS["load_event_log"] = lambda s: s.validation_log.filter(F.col("validation_run_id") != s.cfg.validation_run_id)
JOBS["load_sample"] = lambda s: N.load_sample(s.src, s.cfg)
JOBS["profile_file"] = lambda s: N.profile_file({batch: s.spark.read.parquet(path) for path, (batch, _) in zip(s.raw_paths, s.batches)})
JOBS["profile_file_sizes"] = lambda s: N.profile_file_sizes(s.row_groups)
JOBS["profile_row_groups"] = lambda s: s.row_groups
JOBS["profile_columns"] = lambda s: N.profile_columns(s.profile_states)
JOBS["profile_distinct"] = lambda s: N.profile_distinct(s.profile_states)
JOBS["profile_integrity"] = lambda s: N.profile_integrity(s.src)
JOBS["profile_value_counts"] = lambda s: N.profile_value_counts(s.src)


# the checks run once, when the log is written; the keys read their rows from it
for _key, _name in [("chk_null_required", "NULL_CHECK_REQUIRED_FIELDS"), ("chk_empty_string", "EMPTY_STRING_CHECK"),
                    ("chk_metadata", "METADATA_COMPLETENESS_CHECK"), ("chk_amount_format", "AMOUNT_FORMAT_CHECK"),
                    ("chk_optional_fields", "OPTIONAL_FIELDS_COMPLETENESS"), ("chk_duplicates", "DUPLICATE_RECORDS_CHECK"),
                    ("chk_freshness", "DATA_FRESHNESS_CHECK")]:
    JOBS[_key] = (lambda n: lambda s: s.check_log.filter(F.col("check_name") == n))(_name)
JOBS["check_log_union"] = lambda s: s.check_log
JOBS["latest_validation_summary"] = lambda s: K.latest_validation_summary(s.validation_log)
JOBS["validation_by_type"] = lambda s: K.validation_by_type(s.validation_log, s.cfg)
JOBS["validation_failed_detail"] = lambda s: K.validation_failed_detail(s.validation_log, s.cfg)
JOBS["validation_gate"] = lambda s: K.validation_gate(s.validation_log)

# -- curated snapshots --------------------------------------------------------------
from ..operators import curated as U  # noqa: E402
from ..operators import snapshots as S  # noqa: E402

JOBS["next_version"] = lambda s: S.next_version(s.curated)
JOBS["snapshot_precheck"] = lambda s: S.snapshot_precheck(s.complete)
JOBS["create_snapshot"] = lambda s: s.curated
JOBS["snapshot_verify"] = lambda s: S.snapshot_verify(s.curated, s.complete, 2)
JOBS["snapshot_stats"] = lambda s: S.snapshot_stats(s.curated)
JOBS["snapshot_growth"] = lambda s: S.snapshot_growth(s.curated)
JOBS["snapshot_prune"] = lambda s: S.snapshot_prune(s.curated, s.cfg)
JOBS["hq01_latest"] = lambda s: U.hq01_latest(s.latest)
JOBS["hq02_version"] = lambda s: U.hq02_version(s.curated, s.cfg.version)
JOBS["hq03_versions"] = lambda s: U.hq03_versions(s.curated)
JOBS["hq04_top_categories"] = lambda s: U.hq04_top_categories(s.latest)
JOBS["hq05_person"] = lambda s: U.hq05_person(s.latest)
JOBS["hq06_monthly"] = lambda s: U.hq06_monthly(s.latest)
JOBS["hq07_weekday"] = lambda s: U.hq07_weekday(s.latest)
JOBS["hq08_top_locations"] = lambda s: U.hq08_top_locations(s.latest)
JOBS["hq09_compare_adjacent"] = lambda s: U.hq09_compare_adjacent(s.curated)
JOBS["hq10_version_growth"] = lambda s: U.hq10_version_growth(s.curated)
JOBS["hq11_new_per_version"] = lambda s: U.hq11_new_per_version(s.curated)
JOBS["hq12_person_category"] = lambda s: U.hq12_person_category(s.latest)
JOBS["hq13_payment_pref"] = lambda s: U.hq13_payment_pref(s.latest)
JOBS["hq14_high_value"] = lambda s: U.hq14_high_value(s.latest)
JOBS["hq15_quarterly"] = lambda s: U.hq15_quarterly(s.latest)
JOBS["hq16_quality_grades"] = lambda s: U.hq16_quality_grades(s.latest)
JOBS["hq17_quality_category"] = lambda s: U.hq17_quality_category(s.latest)
JOBS["hq18_person_versions"] = lambda s: U.hq18_person_versions(s.curated, s.cfg.person)
JOBS["hq19_category_versions"] = lambda s: U.hq19_category_versions(s.curated, s.cfg.category)
JOBS["hq20_as_of_date"] = lambda s: U.hq20_as_of_date(s.curated, s.cfg.snapshot_date)
JOBS["hq21_export"] = lambda s: U.hq21_export(s.latest)
JOBS["hq22_diff_versions"] = lambda s: U.hq22_diff_versions(s.curated, *s.cfg.version_pair)
JOBS["cur_time_travel_sum"] = lambda s: U.cur_time_travel_sum(s.curated, s.cfg.version)
JOBS["cur_version_totals"] = lambda s: U.cur_version_totals(s.curated)
JOBS["cv_latest_integrity"] = lambda s: U.cv_latest_integrity(s.curated)
JOBS["cv_completeness"] = lambda s: U.cv_completeness(s.curated)
JOBS["cv_stg_consistency"] = lambda s: U.cv_stg_consistency(s.fact, s.latest)
JOBS["cv_version_history"] = lambda s: U.cv_version_history(s.curated)
JOBS["cv_growth_pct"] = lambda s: U.cv_growth_pct(s.curated)
JOBS["cv_date_ranges"] = lambda s: U.cv_date_ranges(s.curated, s.cfg)
JOBS["cv_quality_stats"] = lambda s: U.cv_quality_stats(s.latest)
JOBS["cv_quality_bands"] = lambda s: U.cv_quality_bands(s.latest)
JOBS["cv_low_quality"] = lambda s: U.cv_low_quality(s.latest)
JOBS["cv_quality_by_version"] = lambda s: U.cv_quality_by_version(s.curated)
JOBS["cv_version_count_advice"] = lambda s: U.cv_version_count_advice(s.curated)
JOBS["cv_duplicate_ids"] = lambda s: U.cv_duplicate_ids(s.curated)
JOBS["cv_cross_version_ids"] = lambda s: U.cv_cross_version_ids(s.curated)
JOBS["cv_verdict"] = lambda s: U.cv_verdict(s.curated, s.latest, s.fact, s.cfg)

# -- staging quality report and mart validation ---------------------------------------
from ..operators import quality as Q  # noqa: E402

JOBS["dq_table_counts"] = lambda s: Q.dq_table_counts(s.dims, s.fact, s.src)
JOBS["dq_completeness"] = lambda s: Q.dq_completeness(s.fact, s.src)
JOBS["dq_null_counts"] = lambda s: Q.dq_null_counts(s.fact)
JOBS["dq_score_distribution"] = lambda s: Q.dq_score_distribution(s.fact)
JOBS["dq_amount_validity"] = lambda s: Q.dq_amount_validity(s.fact)
JOBS["dq_date_validity"] = lambda s: Q.dq_date_validity(s.fact, s.cfg)
JOBS["dq_fk_orphans"] = lambda s: Q.dq_fk_orphans(s.fact, s.dims)
JOBS["dq_unused_dims"] = lambda s: Q.dq_unused_dims(s.fact, s.dims)
JOBS["dq_person_spending"] = lambda s: Q.dq_person_spending(s.complete)
JOBS["dq_category_spending"] = lambda s: Q.dq_category_spending(s.complete)
JOBS["dq_payment_usage"] = lambda s: Q.dq_payment_usage(s.complete)
JOBS["dq_monthly_trend"] = lambda s: Q.dq_monthly_trend(s.fact, s.cfg)
JOBS["dq_location_type"] = lambda s: Q.dq_location_type(s.complete)
JOBS["dq_summary"] = lambda s: Q.dq_summary(s.dims, s.fact)
JOBS["dq_grade"] = lambda s: Q.dq_grade(s.fact, s.src)
JOBS["dv_total_reconcile"] = lambda s: Q.dv_total_reconcile(s.latest, s.mss, s.ct, s.pa, s.ps)
JOBS["dv_count_reconcile"] = lambda s: Q.dv_count_reconcile(s.latest, s.mss, s.ct, s.pa, s.ps)
JOBS["dv_record_counts"] = lambda s: Q.dv_record_counts(s.mss, s.ct, s.pa, s.ps)
JOBS["dv_group_breakdown"] = lambda s: Q.dv_group_breakdown(s.pa)
JOBS["dv_null_keys"] = lambda s: Q.dv_null_keys(s.mss, s.ct, s.pa, s.ps)
JOBS["dv_person_consistency"] = lambda s: Q.dv_person_consistency(s.latest, s.mss, s.pa)
JOBS["dv_verdict"] = lambda s: Q.dv_verdict(s.latest, s.mss, s.ct, s.pa, s.ps)

# -- result order ----------------------------------------------------------------------
from .ordering import ORDER, ordered  # noqa: E402

for _key in [*ORDER, "budget_alerts", "hq22_diff_versions"]:
    JOBS[_key] = (lambda k, job: lambda s: ordered(k, job(s)))(_key, JOBS[_key])
