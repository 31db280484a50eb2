"""Monthly marts over the latest snapshot, and the dashboard view.

Plan shape of every mart: one partial+final aggregation to the mart grain,
then one window partitioned by the mart key and ordered by ``month_idx``
whose RANGE frames give prior month (-1), prior year (-12) and rolling
averages. Windows run on aggregated rows only, so a skewed person or
category costs at most one row per month in a window partition.

Previous-month values use the documented meaning (same key, previous
calendar month); the reference's own prev-month join condition can never
match, which would leave every MoM column NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions.period import (MONEY, dec, days_in_month, median_by, month_idx, pct, pct_change, prior,
                                ratio, round2, trend_from_prev)

GROUPS = ["Essential", "Discretionary", "Transport", "Healthcare", "Education"]


def avg_exact(c) -> F.Column:
    """AVG rounded HALF_UP to 2 places, computed as an exact decimal quotient."""
    col = F.col(c) if isinstance(c, str) else c
    return round2(F.sum(col).cast("decimal(22,2)") / F.count(col).cast("decimal(20,0)"))


def _period_cols(df: DataFrame) -> DataFrame:
    start = F.make_date(F.col("year"), F.col("month"), F.lit(1))
    return (df.withColumn("quarter", F.quarter(start))
              .withColumn("month_start_date", start)
              .withColumn("month_idx", month_idx(F.col("year"), F.col("month"))))


def _audit(cfg: Config):
    ts = F.lit(cfg.as_of).cast("timestamp_ntz")
    return [ts.alias("created_at"), ts.alias("updated_at")]


def _ym():
    return [F.col("spending_year").alias("year"), F.col("spending_month").alias("month")]


# ---------------------------------------------------------------------------
# dst_monthly_spending_summary
# ---------------------------------------------------------------------------

MSS_COLUMNS = [
    "year", "month", "quarter", "month_start_date", "month_end_date", "person_name", "category_name",
    "category_group", "location_name", "location_type", "total_spending", "transaction_count",
    "avg_transaction_amount", "min_transaction_amount", "max_transaction_amount", "prev_month_spending",
    "mom_absolute_change", "mom_percent_change", "prev_year_spending", "yoy_absolute_change",
    "yoy_percent_change", "avg_quality_score", "snapshot_version_source", "created_at", "updated_at",
]


def monthly_summary(latest: DataFrame, cfg: Config) -> DataFrame:
    base = latest.groupBy(*_ym(), "person_name", "category_name", "category_group",
                          "location_name", "location_type").agg(
        F.sum("amount_cleaned").cast(MONEY).alias("total_spending"),
        F.count(F.lit(1)).alias("transaction_count"),
        avg_exact("amount_cleaned").alias("avg_transaction_amount"),
        F.min("amount_cleaned").cast(MONEY).alias("min_transaction_amount"),
        F.max("amount_cleaned").cast(MONEY).alias("max_transaction_amount"),
        avg_exact("data_quality_score").alias("avg_quality_score"),
        F.max("snapshot_version").alias("snapshot_version_source"),
    )
    base = _period_cols(base).withColumn("month_end_date", F.last_day("month_start_date"))
    key = ["person_name", "category_name", "location_name"]
    t = F.col("total_spending")
    out = (base.withColumn("prev_month_spending", prior("total_spending", key, 1))
               .withColumn("prev_year_spending", prior("total_spending", key, 12)))
    out = out.select(
        "*",
        (t - F.coalesce(F.col("prev_month_spending"), dec(0))).cast(MONEY).alias("mom_absolute_change"),
        pct_change(t, F.col("prev_month_spending")).alias("mom_percent_change"),
        (t - F.coalesce(F.col("prev_year_spending"), dec(0))).cast(MONEY).alias("yoy_absolute_change"),
        pct_change(t, F.col("prev_year_spending")).alias("yoy_percent_change"),
        *_audit(cfg),
    )
    return out.select(*MSS_COLUMNS)


# ---------------------------------------------------------------------------
# dst_category_trends
# ---------------------------------------------------------------------------

CT_COLUMNS = [
    "year", "month", "quarter", "month_start_date", "category_name", "category_group", "total_spending",
    "transaction_count", "unique_persons", "avg_transaction_amount", "prev_month_spending",
    "mom_absolute_change", "mom_percent_change", "mom_trend_direction", "prev_year_spending",
    "yoy_absolute_change", "yoy_percent_change", "yoy_trend_direction", "rolling_3month_avg",
    "rolling_6month_avg", "category_rank_current", "category_rank_prev_month", "rank_change",
    "percent_of_total_spending", "snapshot_version_source", "created_at", "updated_at",
]


def category_trends(latest: DataFrame, cfg: Config) -> DataFrame:
    base = latest.groupBy(*_ym(), "category_name", "category_group").agg(
        F.sum("amount_cleaned").cast(MONEY).alias("total_spending"),
        F.count(F.lit(1)).alias("transaction_count"),
        F.countDistinct("person_name").alias("unique_persons"),
        avg_exact("amount_cleaned").alias("avg_transaction_amount"),
        F.max("snapshot_version").alias("snapshot_version_source"),
    )
    base = _period_cols(base)
    in_month = Window.partitionBy("year", "month")
    base = base.select(
        "*",
        F.row_number().over(in_month.orderBy(F.desc("total_spending"), F.asc("category_name")))
         .alias("category_rank_current"),
        pct(F.col("total_spending"), F.sum("total_spending").over(in_month)).alias("percent_of_total_spending"),
    )
    key = ["category_name"]
    roll = Window.partitionBy(*key).orderBy("month_idx")
    t = F.col("total_spending")

    def rolling(n):
        w = roll.rangeBetween(-(n - 1), 0)
        return round2(F.sum(t).over(w) / F.count(t).over(w).cast("decimal(20,0)"))

    out = base.select(
        "*",
        prior("total_spending", key, 1).alias("prev_month_spending"),
        prior("total_spending", key, 12).alias("prev_year_spending"),
        rolling(3).alias("rolling_3month_avg"),
        rolling(6).alias("rolling_6month_avg"),
        prior("category_rank_current", key, 1).alias("category_rank_prev_month"),
    )
    pm, py = F.col("prev_month_spending"), F.col("prev_year_spending")
    out = out.select(
        "*",
        (t - F.coalesce(pm, dec(0))).cast(MONEY).alias("mom_absolute_change"),
        pct_change(t, pm).alias("mom_percent_change"),
        trend_from_prev(t, pm).alias("mom_trend_direction"),
        (t - F.coalesce(py, dec(0))).cast(MONEY).alias("yoy_absolute_change"),
        pct_change(t, py).alias("yoy_percent_change"),
        trend_from_prev(t, py).alias("yoy_trend_direction"),
        (F.coalesce(F.col("category_rank_prev_month"), F.col("category_rank_current"))
         - F.col("category_rank_current")).alias("rank_change"),
        *_audit(cfg),
    )
    return out.select(*CT_COLUMNS)


# ---------------------------------------------------------------------------
# dst_person_analytics
# ---------------------------------------------------------------------------

PA_COLUMNS = [
    "year", "month", "quarter", "month_start_date", "person_name", "total_spending", "transaction_count",
    "avg_transaction_amount", "median_transaction_amount", "top_category", "top_category_spending",
    "top_category_percent", "essential_spending", "discretionary_spending", "transport_spending",
    "healthcare_spending", "education_spending", "other_spending", "essential_percent",
    "discretionary_percent", "essential_to_discretionary_ratio", "unique_categories_count",
    "unique_locations_count", "unique_payment_methods_count", "weekday_spending", "weekend_spending",
    "weekend_spending_percent", "morning_spending", "afternoon_spending", "evening_spending",
    "night_spending", "small_transactions_count", "medium_transactions_count", "large_transactions_count",
    "xlarge_transactions_count", "avg_daily_spending", "avg_weekly_spending", "days_with_spending",
    "spending_frequency_percent", "prev_month_total", "mom_absolute_change", "mom_percent_change",
    "prev_year_total", "yoy_absolute_change", "yoy_percent_change", "avg_quality_score",
    "snapshot_version_source", "created_at", "updated_at",
]


def person_analytics(latest: DataFrame, cfg: Config) -> DataFrame:
    amt = F.col("amount_cleaned")
    grp = F.col("category_group")

    def group_sum(name):
        return F.sum(F.when(grp == name, amt).otherwise(dec("0.00"))).cast(MONEY)

    keys = ["year", "month", "person_name"]
    # A row per category, location, method and date (never a set per person) gives the distinct counts and the top
    # category; the sums are made once per row, with the categories.
    of_category = F.col("kind") == "category"
    by_category = latest.groupBy(*_ym(), "person_name", F.lit("category").alias("kind"), F.col("category_name").alias("value")).agg(
        F.sum(amt).alias("total"),
        F.count(F.lit(1)).alias("rows"),
        F.count(amt).alias("amounts"),
        *[group_sum(g).alias(g.lower()) for g in GROUPS],
        F.sum(F.when((grp == "Other") | grp.isNull(), amt).otherwise(dec("0.00"))).cast(MONEY).alias("other"),
        F.sum(F.when(F.col("spending_day_of_week").between(1, 5), amt).otherwise(dec("0.00"))).cast(MONEY).alias("weekday"),
        F.sum(F.when(F.col("spending_day_of_week").isin(6, 7), amt).otherwise(dec("0.00"))).cast(MONEY).alias("weekend"),
        F.count_if(amt < 10).alias("small"),
        F.count_if((amt >= 10) & (amt < 100)).alias("medium"),
        F.count_if((amt >= 100) & (amt < 500)).alias("large"),
        F.count_if(amt >= 500).alias("xlarge"),
        F.sum("data_quality_score").alias("quality"),
        F.count("data_quality_score").alias("qualities"),
        F.max("snapshot_version").alias("version"),
    )
    values = [("location", "location_name"), ("method", "payment_method_name"), ("date", "spending_date")]
    seen = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("value")) for k, c in values]))
    others = latest.select(*_ym(), "person_name", seen.alias("seen")).select(*keys, "seen.kind", "seen.value").distinct()
    by_value = by_category.unionByName(others, allowMissingColumns=True)
    whole = lambda c: F.sum(F.when(of_category, F.col(c)))
    values_of = lambda kind: F.count(F.when(F.col("kind") == kind, F.col("value")))
    top = F.min(F.when(of_category, F.struct((-F.col("total")).alias("neg"), F.col("value").alias("name"))))
    base = by_value.groupBy(*keys).agg(
        whole("total").cast(MONEY).alias("total_spending"),
        whole("rows").alias("transaction_count"),
        round2(whole("total").cast("decimal(22,2)") / whole("amounts").cast("decimal(20,0)")).alias("avg_transaction_amount"),
        *[whole(g.lower()).cast(MONEY).alias(f"{g.lower()}_spending") for g in [*GROUPS, "Other"]],
        whole("weekday").cast(MONEY).alias("weekday_spending"),
        whole("weekend").cast(MONEY).alias("weekend_spending"),
        *[whole(c).alias(f"{c}_transactions_count") for c in ("small", "medium", "large", "xlarge")],
        values_of("date").alias("days_with_spending"),
        round2(whole("quality").cast("decimal(22,2)") / whole("qualities").cast("decimal(20,0)")).alias("avg_quality_score"),
        F.max("version").alias("snapshot_version_source"),
        values_of("category").alias("unique_categories_count"),
        values_of("location").alias("unique_locations_count"),
        values_of("method").alias("unique_payment_methods_count"),
        top.alias("top"),
    )
    base = base.select("*", F.col("top.name").alias("top_category"), (-F.col("top.neg")).cast(MONEY).alias("top_category_spending")).drop("top")
    median = median_by(latest.select(*_ym(), "person_name", "amount_cleaned"), keys, "amount_cleaned",
                       "median_transaction_amount")
    df = base.join(median, keys, "left")
    df = _period_cols(df)
    t = F.col("total_spending")
    dim = days_in_month(F.col("month_start_date"))
    null_money = F.lit(None).cast(MONEY)
    df = df.select(
        "*",
        pct(F.col("top_category_spending"), t).alias("top_category_percent"),
        pct(F.col("essential_spending"), t).alias("essential_percent"),
        pct(F.col("discretionary_spending"), t).alias("discretionary_percent"),
        ratio(F.col("essential_spending"), F.col("discretionary_spending")).alias("essential_to_discretionary_ratio"),
        pct(F.col("weekend_spending"), t).alias("weekend_spending_percent"),
        null_money.alias("morning_spending"), null_money.alias("afternoon_spending"),
        null_money.alias("evening_spending"), null_money.alias("night_spending"),
        round2(t / dim.cast("decimal(10,0)")).alias("avg_daily_spending"),
        round2(t / dec("4.33")).alias("avg_weekly_spending"),
        pct(F.col("days_with_spending"), dim).alias("spending_frequency_percent"),
        prior("total_spending", ["person_name"], 1).alias("prev_month_total"),
        prior("total_spending", ["person_name"], 12).alias("prev_year_total"),
    )
    pm, py = F.col("prev_month_total"), F.col("prev_year_total")
    df = df.select(
        "*",
        (t - F.coalesce(pm, dec(0))).cast(MONEY).alias("mom_absolute_change"),
        pct_change(t, pm).alias("mom_percent_change"),
        (t - F.coalesce(py, dec(0))).cast(MONEY).alias("yoy_absolute_change"),
        pct_change(t, py).alias("yoy_percent_change"),
        *_audit(cfg),
    )
    return df.select(*PA_COLUMNS)


# ---------------------------------------------------------------------------
# dst_payment_method_summary
# ---------------------------------------------------------------------------

PS_COLUMNS = [
    "year", "month", "quarter", "month_start_date", "payment_method_name", "payment_type",
    "transaction_count", "unique_persons_count", "total_amount", "avg_transaction_amount",
    "min_transaction_amount", "max_transaction_amount", "percent_of_transactions", "percent_of_spending",
    "top_category_1", "top_category_1_amount", "top_category_2", "top_category_2_amount", "top_category_3",
    "top_category_3_amount", "prev_month_transaction_count", "mom_transaction_change_percent",
    "prev_month_amount", "mom_amount_change_percent", "payment_method_rank", "snapshot_version_source",
    "created_at", "updated_at",
]


def payment_summary(latest: DataFrame, cfg: Config) -> DataFrame:
    amt = F.col("amount_cleaned")
    keys = ["year", "month", "payment_method_name"]
    base = latest.groupBy(*_ym(), "payment_method_name", "payment_type").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.countDistinct("person_name").alias("unique_persons_count"),
        F.sum(amt).cast(MONEY).alias("total_amount"),
        avg_exact("amount_cleaned").alias("avg_transaction_amount"),
        F.min(amt).cast(MONEY).alias("min_transaction_amount"),
        F.max(amt).cast(MONEY).alias("max_transaction_amount"),
        F.max("snapshot_version").alias("snapshot_version_source"),
    )
    # top three categories per method-month, pivoted in one aggregation
    per_cat = latest.groupBy(*_ym(), "payment_method_name", "category_name").agg(
        F.sum(amt).cast(MONEY).alias("cat_amount"))
    rk = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("cat_amount"), F.asc("category_name")))
    ranked = per_cat.withColumn("rk", rk).filter(F.col("rk") <= 3)
    top = ranked.groupBy(*keys).agg(*[
        e for k in (1, 2, 3) for e in (
            F.max(F.when(F.col("rk") == k, F.col("category_name"))).alias(f"top_category_{k}"),
            F.max(F.when(F.col("rk") == k, F.col("cat_amount"))).alias(f"top_category_{k}_amount"))])

    df = _period_cols(base.join(top, keys, "left"))
    in_month = Window.partitionBy("year", "month")
    df = df.select(
        "*",
        pct(F.col("transaction_count"), F.sum("transaction_count").over(in_month)).alias("percent_of_transactions"),
        pct(F.col("total_amount"), F.sum("total_amount").over(in_month)).alias("percent_of_spending"),
        F.row_number().over(in_month.orderBy(F.desc("total_amount"), F.asc("payment_method_name")))
         .alias("payment_method_rank"),
    )
    key = ["payment_method_name"]
    df = df.select(
        "*",
        prior("transaction_count", key, 1).alias("prev_month_transaction_count"),
        prior("total_amount", key, 1).alias("prev_month_amount"),
    )
    pc = F.col("prev_month_transaction_count")
    df = df.select(
        "*",
        F.when(pc.isNotNull() & (pc > 0),
               round2((F.col("transaction_count") - pc).cast("decimal(20,0)") * dec(100)
                      / pc.cast("decimal(20,0)"))).alias("mom_transaction_change_percent"),
        pct_change(F.col("total_amount"), F.col("prev_month_amount")).alias("mom_amount_change_percent"),
        *_audit(cfg),
    )
    return df.select(*PS_COLUMNS)


# ---------------------------------------------------------------------------
# vw_dst_latest_month_dashboard and get_trend_direction
# ---------------------------------------------------------------------------

def latest_period(df: DataFrame):
    """MAX(year*100+month) of a mart, as a scalar subquery column."""
    return df.agg(F.max(F.col("year") * 100 + F.col("month"))).scalar()


def _top_name(df: DataFrame, name: str, measure: str, period):
    """Name with the largest measure in the period (ties to the smaller name), as a scalar subquery."""
    cur = df.filter(F.col("year") * 100 + F.col("month") == period)
    best = cur.agg(F.min(F.struct((-F.col(measure)).alias("n"), F.col(name).alias("v"))).alias("b"))
    return best.select("b.v").scalar()


def dashboard(mss: DataFrame, ct: DataFrame, pa: DataFrame, ps: DataFrame) -> DataFrame:
    period = latest_period(mss)
    cur = mss.filter(F.col("year") * 100 + F.col("month") == period)
    return cur.groupBy("year", "month", "month_start_date").agg(
        F.countDistinct("person_name").alias("total_persons"),
        F.countDistinct("category_name").alias("total_categories"),
        F.sum("total_spending").cast(MONEY).alias("total_spending"),
        F.sum("transaction_count").alias("total_transactions"),
        avg_exact("avg_transaction_amount").alias("avg_transaction_size"),
        F.max("snapshot_version_source").alias("snapshot_version"),
    ).select(
        "total_persons", "total_categories", "total_spending", "total_transactions", "avg_transaction_size",
        _top_name(ct, "category_name", "total_spending", period).alias("top_category"),
        _top_name(pa, "person_name", "total_spending", period).alias("top_spender"),
        _top_name(ps, "payment_method_name", "total_amount", period).alias("top_payment_method"),
        "year", "month", "month_start_date", "snapshot_version",
    )
