"""Small report jobs over staging, snapshots and marts (2.B report keys).

Each is a declarative aggregation or a filter + top-k; top-k always carries
a tie-break so that the selected set is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.period import MONEY, dec, pct
from .marts import avg_exact


def top_k(df: DataFrame, k: int, *order) -> DataFrame:
    """ORDER BY ... LIMIT k (Spark plans TakeOrderedAndProject: a bounded
    per-partition heap, no full sort)."""
    return df.orderBy(*order).limit(k)


def money_sum(c: str):
    return F.sum(c).cast(MONEY)


# -- staging -------------------------------------------------------------------

def stg_transform_stats(stg: DataFrame) -> DataFrame:
    ok = F.col("is_amount_parsed_successfully") & F.col("is_date_parsed_successfully")
    n = F.count(F.lit(1))
    return stg.agg(
        n.alias("total_rows"),
        F.count_if("is_amount_parsed_successfully").alias("amount_parsed"),
        pct(F.count_if("is_amount_parsed_successfully"), n).alias("amount_success_pct"),
        F.count_if("is_date_parsed_successfully").alias("date_parsed"),
        pct(F.count_if("is_date_parsed_successfully"), n).alias("date_success_pct"),
        F.count_if(ok).alias("valid_rows"),
        pct(F.count_if(ok), n).alias("valid_pct"),
        (n - F.count_if(ok)).alias("rejected_rows"),
        avg_exact("data_quality_score").alias("avg_quality_score"),
        F.min(F.when(ok, F.col("spending_date"))).alias("min_date"),
        F.max(F.when(ok, F.col("spending_date"))).alias("max_date"),
    )


def stg_load_stats(fact: DataFrame, dims: dict, src: DataFrame) -> DataFrame:
    """Row count per table, load success %, score and amount stats, date range."""
    src_n = src.agg(F.count(F.lit(1))).scalar()
    stats = fact.agg(
        F.count(F.lit(1)).alias("fact_rows"),
        avg_exact("data_quality_score").alias("avg_score"),
        F.min("data_quality_score").alias("min_score"),
        F.max("data_quality_score").alias("max_score"),
        avg_exact("amount_cleaned").alias("avg_amount"),
        money_sum("amount_cleaned").alias("total_amount"),
        F.min("spending_date").alias("min_date"),
        F.max("spending_date").alias("max_date"),
    )
    return stats.select(
        *[d.agg(F.count(F.lit(1))).scalar().alias(f"dim_{k}_rows") for k, d in dims.items()],
        "fact_rows", src_n.alias("source_rows"), pct(F.col("fact_rows"), src_n).alias("load_success_pct"),
        "avg_score", "min_score", "max_score", "avg_amount", "total_amount", "min_date", "max_date")


def stg_top_categories(complete: DataFrame) -> DataFrame:
    g = complete.groupBy("category_name").agg(
        F.count(F.lit(1)).alias("transactions"),
        money_sum("amount_cleaned").alias("total_amount"),
        avg_exact("amount_cleaned").alias("avg_amount"))
    return top_k(g, 5, F.desc("total_amount"), "category_name")


def stg_recent_sample(complete: DataFrame) -> DataFrame:
    s = complete.select("person_name", "spending_date", "category_name", "amount_cleaned", "location_name",
                        "payment_method_name", "src_id")
    return top_k(s, 10, F.desc("spending_date"), F.desc("src_id"))


def stg_person_history(complete: DataFrame, person: str) -> DataFrame:
    return complete.filter(F.col("person_name") == person).select(
        "spending_id", "person_name", "spending_date", "spending_year", "spending_month", "spending_quarter",
        "spending_day_of_week", "category_name", "category_group", "amount_cleaned", "currency_code",
        "location_name", "location_type", "description", "payment_method_name", "payment_type",
        "data_quality_score", "src_id")


def stg_month_category(complete: DataFrame) -> DataFrame:
    return complete.groupBy("spending_year", "spending_month", "category_name").agg(
        F.count(F.lit(1)).alias("transactions"), money_sum("amount_cleaned").alias("total_amount"))


def stg_top_locations(complete: DataFrame) -> DataFrame:
    g = complete.groupBy("location_name", "location_type").agg(
        F.count(F.lit(1)).alias("visits"), money_sum("amount_cleaned").alias("total_spent"))
    return top_k(g, 10, F.desc("total_spent"), "location_name")


def stg_payment_analysis(complete: DataFrame) -> DataFrame:
    return complete.groupBy("payment_method_name", "payment_type").agg(
        F.count(F.lit(1)).alias("usage_count"), avg_exact("amount_cleaned").alias("avg_transaction"))


# -- mart reports ----------------------------------------------------------------

def ms_source_info(latest: DataFrame) -> DataFrame:
    return latest.groupBy("snapshot_version").agg(
        F.count(F.lit(1)).alias("rows"), F.min("spending_date").alias("min_date"),
        F.max("spending_date").alias("max_date"))


def ms_reconcile(mss: DataFrame, latest: DataFrame) -> DataFrame:
    cur = latest.agg(F.sum("amount_cleaned").cast(MONEY)).scalar()
    return mss.agg(money_sum("total_spending").alias("mart_total")).select(
        cur.alias("curated_total"), "mart_total",
        (F.abs(cur - F.col("mart_total")) < dec("0.01")).alias("match"))


def ms_stats(mss: DataFrame) -> DataFrame:
    return mss.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.countDistinct("person_name").alias("unique_persons"),
        F.countDistinct("category_name").alias("unique_categories"),
        F.countDistinct("location_name").alias("unique_locations"),
        F.countDistinct(F.concat(F.col("year").cast("string"), F.lit("-"),
                                 F.lpad(F.col("month").cast("string"), 2, "0"))).alias("unique_months"),
        F.sum("transaction_count").alias("total_transactions"),
        avg_exact("total_spending").alias("avg_monthly_spending"),
        F.min("total_spending").alias("min_spending"),
        F.max("total_spending").alias("max_spending"),
    )


def ms_top_samples(mss: DataFrame) -> DataFrame:
    s = mss.select("year", "month", "person_name", "category_name", "location_name", "total_spending",
                   "transaction_count", "mom_percent_change", "yoy_percent_change")
    return top_k(s, 5, F.desc("total_spending"), "year", "month", "person_name", "category_name", "location_name")


def ct_top(ct: DataFrame) -> DataFrame:
    g = ct.groupBy("category_name").agg(
        money_sum("total_spending").alias("total"),
        avg_exact("percent_of_total_spending").alias("avg_share"),
        F.expr("listagg(DISTINCT mom_trend_direction, ', ') WITHIN GROUP (ORDER BY mom_trend_direction)")
         .alias("trends"))
    return top_k(g, 5, F.desc("total"), "category_name")


def ct_growing(ct: DataFrame, desc: bool = True) -> DataFrame:
    s = ct.filter(F.col("mom_percent_change").isNotNull()).select(
        "year", "month", "category_name", "mom_percent_change", "total_spending")
    o = F.desc("mom_percent_change") if desc else F.asc("mom_percent_change")
    return top_k(s, 5, o, "year", "month", "category_name")


def pa_ed_summary(pa: DataFrame) -> DataFrame:
    return pa.agg(
        avg_exact("essential_percent").alias("avg_essential_pct"),
        avg_exact("discretionary_percent").alias("avg_discretionary_pct"),
        avg_exact("essential_to_discretionary_ratio").alias("avg_ed_ratio"),
        F.count_if(F.col("discretionary_percent") > 40).alias("high_discretionary_rows"),
        F.count(F.lit(1)).alias("total_rows"),
    )


def pa_top_spenders(pa: DataFrame) -> DataFrame:
    s = pa.select("year", "month", "person_name", "total_spending", "essential_percent",
                  "discretionary_percent", "top_category")
    return top_k(s, 5, F.desc("total_spending"), "year", "month", "person_name")


def pa_alerts(pa: DataFrame) -> DataFrame:
    s = pa.filter(F.col("discretionary_percent") > 35).select(
        "year", "month", "person_name", "discretionary_percent", "discretionary_spending", "total_spending")
    return top_k(s, 5, F.desc("discretionary_percent"), "year", "month", "person_name")


def ps_market_share(ps: DataFrame) -> DataFrame:
    return ps.groupBy("payment_method_name", "payment_type").agg(
        F.sum("transaction_count").alias("total_txns"),
        money_sum("total_amount").alias("total_amt"),
        avg_exact("percent_of_transactions").alias("avg_txn_share"),
        avg_exact("percent_of_spending").alias("avg_spending_share"))


def ps_trends(ps: DataFrame) -> DataFrame:
    s = ps.filter(F.col("mom_amount_change_percent").isNotNull()).select(
        "year", "month", "payment_method_name", "mom_transaction_change_percent", "mom_amount_change_percent",
        "total_amount")
    return top_k(s, 5, F.desc("mom_amount_change_percent"), "year", "month", "payment_method_name")


def ps_preferences(ps: DataFrame) -> DataFrame:
    s = ps.select("year", "month", "payment_method_name", "top_category_1", "top_category_1_amount",
                  "top_category_2", "top_category_3", "total_amount")
    return top_k(s, 5, F.desc("total_amount"), "year", "month", "payment_method_name")


def dst_ed_month(pa: DataFrame, cfg: Config) -> DataFrame:
    return pa.filter((F.col("year") == cfg.year) & (F.col("month") == cfg.month)).select(
        "person_name", "total_spending", "essential_spending", "discretionary_spending", "essential_percent",
        "discretionary_percent", "essential_to_discretionary_ratio")


def dst_category_mom(ct: DataFrame, cfg: Config) -> DataFrame:
    s = ct.filter((F.col("year") == cfg.year) & (F.col("month") == cfg.month)).select(
        "category_name", "total_spending", "mom_percent_change", "mom_trend_direction")
    return top_k(s, 5, F.desc_nulls_last("mom_percent_change"), "category_name")


def dst_person_yoy(pa: DataFrame, cfg: Config) -> DataFrame:
    return pa.filter(F.col("month") == cfg.month).select(
        "person_name", "year", "month", "total_spending", "yoy_percent_change")


def dst_rolling_year(ct: DataFrame, cfg: Config) -> DataFrame:
    return ct.filter(F.col("year") == cfg.year).select(
        "category_name", "month_start_date", "total_spending", "rolling_3month_avg", "rolling_6month_avg")


def dst_top_spenders_month(pa: DataFrame, cfg: Config) -> DataFrame:
    s = pa.filter((F.col("year") == cfg.year) & (F.col("month") == cfg.month)).select(
        "person_name", "total_spending", "essential_percent", "discretionary_percent", "top_category")
    return top_k(s, 10, F.desc("total_spending"), "person_name")


def dst_fastest_growing(ct: DataFrame, cfg: Config) -> DataFrame:
    s = ct.filter((F.col("year") == cfg.year) & (F.col("month") == cfg.month)
                  & F.col("mom_percent_change").isNotNull()).select(
        "category_name", "total_spending", "mom_percent_change", "yoy_percent_change")
    return top_k(s, 10, F.desc("mom_percent_change"), "category_name")


def dst_high_discretionary(pa: DataFrame) -> DataFrame:
    return pa.filter(F.col("discretionary_percent") > 40).select(
        "person_name", "year", "month", "total_spending", "discretionary_percent",
        "essential_to_discretionary_ratio")


def dst_share_year(ps: DataFrame, cfg: Config) -> DataFrame:
    return ps.filter(F.col("year") == cfg.year).groupBy("payment_method_name", "payment_type").agg(
        F.sum("transaction_count").alias("total_transactions"),
        money_sum("total_amount").alias("total_amount"),
        avg_exact("percent_of_spending").alias("avg_market_share"))


def dst_raw_monthly_category(latest: DataFrame) -> DataFrame:
    """Category x month sum computed straight from the snapshot (the 'before' query)."""
    return latest.groupBy(F.trunc("spending_date", "MM").alias("month"), "category_name").agg(
        money_sum("amount_cleaned").alias("total"))


def dst_mart_monthly_category(ct: DataFrame, cfg: Config) -> DataFrame:
    """Same numbers read from the category mart (the 'after' query)."""
    return ct.filter(F.col("year") == cfg.year).select(
        F.col("month_start_date").alias("month"), "category_name", F.col("total_spending").alias("total"))


def trend_direction_table(ct: DataFrame) -> DataFrame:
    """get_trend_direction applied to every MoM and YoY percentage of the category mart."""
    from ..functions.period import trend_direction
    return ct.select("year", "month", "category_name", "mom_percent_change",
                     trend_direction(F.col("mom_percent_change")).alias("mom_direction"),
                     "yoy_percent_change",
                     trend_direction(F.col("yoy_percent_change")).alias("yoy_direction"))
