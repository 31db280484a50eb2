"""Staging quality report (dq_*) and mart validation (dv_*).

All are aggregations over the fact/dimension tables or the marts; foreign-key
and unused-dimension checks are ``left_anti`` joins (NOT EXISTS), where the
dimension side is left to statistics and AQE.
"""

from __future__ import annotations



from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.period import MONEY, dec, median_by, pct
from .marts import avg_exact
from .reports import money_sum, top_k
from .staging import DIM_SPECS


def _n():
    return F.count(F.lit(1))


DIM_LABELS = {"person": "Persons", "location": "Locations", "category": "Categories",
              "payment_method": "Payment Methods"}
FK_LABELS = {"person": "Person FK", "location": "Location FK", "category": "Category FK",
             "payment_method": "Payment Method FK"}


def _union(dfs):
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def dq_table_counts(dims: dict, fact: DataFrame, src: DataFrame) -> DataFrame:
    parts = [d.agg(_n().alias("count")).select(F.lit(DIM_LABELS[k]).alias("dimension"), "count",
                                               F.lit(f"stg_dim_{k}").alias("table_name")) for k, d in dims.items()]
    parts.append(fact.agg(_n().alias("count")).select(F.lit("Spending Facts").alias("dimension"), "count",
                                                      F.lit("stg_fact_spending").alias("table_name")))
    parts.append(src.agg(_n().alias("count")).select(F.lit("Source Records").alias("dimension"), "count",
                                                     F.lit("src_daily_spending").alias("table_name")))
    return _union(parts)


def _completeness(fact: DataFrame, src: DataFrame):
    return pct(fact.agg(_n()).scalar(), src.agg(_n()).scalar())


def dq_completeness(fact: DataFrame, src: DataFrame) -> DataFrame:
    c = fact.agg(_n().alias("fact_rows")).select(
        "fact_rows", src.agg(_n()).scalar().alias("source_rows"), _completeness(fact, src).alias("completeness_pct"))
    return c.withColumn("status", F.when(F.col("completeness_pct") == 100, "PASS")
                        .when(F.col("completeness_pct") >= 95, "WARN").otherwise("FAIL"))


NULL_COLUMNS = ["person_id", "location_id", "category_id", "payment_method_id", "spending_date", "amount_cleaned"]


def dq_null_counts(fact: DataFrame) -> DataFrame:
    return fact.agg(_n().alias("total_records"),
                    *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in NULL_COLUMNS])


def dq_score_distribution(fact: DataFrame) -> DataFrame:
    s = F.col("data_quality_score")
    out = fact.agg(_n().alias("total_records"), avg_exact("data_quality_score").alias("avg_score"),
                   F.min(s).alias("min_score"), F.max(s).alias("max_score"),
                   F.count_if(s == 100).alias("perfect_score_count"), F.count_if(s >= 90).alias("high_quality_count"),
                   F.count_if(s >= 70).alias("good_quality_count"), F.count_if(s < 70).alias("poor_quality_count"))
    return out.withColumn("status", F.when(F.col("avg_score") >= 95, "PASS").when(F.col("avg_score") >= 85, "WARN")
                          .otherwise("FAIL"))


def dq_amount_validity(fact: DataFrame) -> DataFrame:
    a = F.col("amount_cleaned")
    out = fact.agg(_n().alias("total_records"), F.count_if(a <= 0).alias("negative_or_zero"),
                   F.count_if(a > 10000).alias("extremely_high"), F.min(a).cast(MONEY).alias("min_amount"),
                   F.max(a).cast(MONEY).alias("max_amount"), avg_exact("amount_cleaned").alias("avg_amount"))
    out = out.withColumn("median_amount", median_by(fact, [], "amount_cleaned", "median").scalar())
    return out.withColumn("status", F.when((F.col("negative_or_zero") == 0) & (F.col("min_amount") > 0), "PASS")
                          .otherwise("FAIL"))


def dq_date_validity(fact: DataFrame, cfg: Config) -> DataFrame:
    d = F.col("spending_date")
    return fact.agg(F.min(d).alias("min_date"), F.max(d).alias("max_date"),
                    F.countDistinct(d).alias("unique_dates"),
                    F.count_if(d > F.lit(cfg.as_of.date())).alias("future_dates"))


def dq_fk_orphans(fact: DataFrame, dims: dict) -> DataFrame:
    parts = []
    for k, (_name, _attr, key) in DIM_SPECS.items():
        orphans = fact.select(key).join(dims[k].select(key), key, "left_anti")
        parts.append(orphans.agg(_n().alias("orphan_count")).select(F.lit(FK_LABELS[k]).alias("check_name"),
                                                                    "orphan_count"))
    return _union(parts)


def dq_unused_dims(fact: DataFrame, dims: dict) -> DataFrame:
    parts = []
    for k, (_name, _attr, key) in DIM_SPECS.items():
        used = fact.select(key).distinct()
        unused = dims[k].select(key).join(used, key, "left_anti")
        parts.append(unused.agg(_n().alias("unused_count")).select(F.lit(DIM_LABELS[k]).alias("dimension"),
                                                                   "unused_count"))
    return _union(parts)


def dq_person_spending(complete: DataFrame) -> DataFrame:
    return complete.groupBy("person_name").agg(
        _n().alias("transaction_count"), money_sum("amount_cleaned").alias("total_spending"),
        avg_exact("amount_cleaned").alias("avg_transaction"), F.min("spending_date").alias("first_transaction"),
        F.max("spending_date").alias("last_transaction"))


def _share_of_total(complete: DataFrame, keys):
    total = complete.agg(F.sum("amount_cleaned").cast(MONEY)).scalar()
    g = complete.groupBy(*keys).agg(_n().alias("transactions"), money_sum("amount_cleaned").alias("total_amount"),
                                    avg_exact("amount_cleaned").alias("avg_amount"))
    return g.withColumn("percentage", pct(F.col("total_amount"), total))


def dq_category_spending(complete: DataFrame) -> DataFrame:
    return _share_of_total(complete, ["category_name", "category_group"])


def dq_location_type(complete: DataFrame) -> DataFrame:
    return _share_of_total(complete, ["location_type"])


def dq_payment_usage(complete: DataFrame) -> DataFrame:
    total = complete.agg(_n()).scalar()
    g = complete.groupBy("payment_method_name", "payment_type").agg(
        _n().alias("transactions"), money_sum("amount_cleaned").alias("total_amount"))
    g = g.withColumn("usage_percentage", pct(F.col("transactions"), total))
    return top_k(g, 10, F.desc("transactions"), "payment_method_name")


def dq_monthly_trend(fact: DataFrame, cfg: Config) -> DataFrame:
    since = F.add_months(F.lit(cfg.report_as_of), -12)
    g = fact.filter(F.col("spending_date") >= since).groupBy(F.date_format("spending_date", "yyyy-MM").alias("month")).agg(
        _n().alias("transactions"), money_sum("amount_cleaned").alias("total_amount"),
        avg_exact("amount_cleaned").alias("avg_amount"))
    return top_k(g, 12, F.desc("month"))


def dq_summary(dims: dict, fact: DataFrame) -> DataFrame:
    sc = {k: d.agg(_n()).scalar() for k, d in dims.items()}
    return fact.agg(_n().alias("total_transactions"), money_sum("amount_cleaned").alias("total_amount"),
                    avg_exact("data_quality_score").alias("avg_quality_score")).select(
        sc["person"].alias("total_persons"), sc["location"].alias("total_locations"),
        sc["category"].alias("total_categories"), sc["payment_method"].alias("total_payment_methods"),
        "total_transactions", "total_amount", "avg_quality_score")


def dq_grade(fact: DataFrame, src: DataFrame) -> DataFrame:
    c, q = F.col("completeness_pct"), F.col("avg_quality_score")
    base = fact.agg(avg_exact("data_quality_score").alias("avg_quality_score")).select(
        _completeness(fact, src).alias("completeness_pct"), "avg_quality_score")
    return base.withColumn("grade", F.when((c == 100) & (q >= 95), "A+ (Excellent)")
                           .when((c >= 95) & (q >= 85), "A (Very Good)")
                           .when((c >= 90) & (q >= 75), "B (Good)")
                           .otherwise("C or below (Needs Improvement)"))


# -- mart validation ----------------------------------------------------------------

def _mart_totals(mss, ct, pa, ps):
    return [("dst_monthly_spending_summary", mss, "total_spending"), ("dst_category_trends", ct, "total_spending"),
            ("dst_person_analytics", pa, "total_spending"), ("dst_payment_method_summary", ps, "total_amount")]


def dv_total_reconcile(latest: DataFrame, mss, ct, pa, ps) -> DataFrame:
    cur = latest.agg(F.sum("amount_cleaned").cast(MONEY)).scalar()
    parts = [m.agg(money_sum(col).alias("mart_total")).select(
        F.lit(name).alias("mart_name"), "mart_total", cur.alias("curated_total"),
        (F.col("mart_total") - cur).cast(MONEY).alias("difference"),
        (F.abs(F.col("mart_total") - cur) < dec("0.01")).alias("match")) for name, m, col in _mart_totals(mss, ct, pa, ps)]
    return _union(parts)


def dv_count_reconcile(latest: DataFrame, mss, ct, pa, ps) -> DataFrame:
    cur = latest.agg(_n()).scalar()
    parts = [m.agg(F.sum("transaction_count").alias("mart_transactions")).select(
        F.lit(name).alias("mart_name"), "mart_transactions", cur.alias("curated_count"),
        (F.col("mart_transactions") == cur).alias("match")) for name, m, _c in _mart_totals(mss, ct, pa, ps)]
    return _union(parts)


def dv_record_counts(mss, ct, pa, ps) -> DataFrame:
    return _union([m.agg(_n().alias("record_count")).select(F.lit(name).alias("mart_name"), "record_count")
                   for name, m, _c in _mart_totals(mss, ct, pa, ps)])


GROUP_COLUMNS = ["essential_spending", "discretionary_spending", "transport_spending", "healthcare_spending",
                 "education_spending", "other_spending"]


def dv_group_breakdown(pa: DataFrame) -> DataFrame:
    groups = sum((F.sum(c) for c in GROUP_COLUMNS[1:]), F.sum(GROUP_COLUMNS[0]))
    out = pa.agg(groups.cast(MONEY).alias("groups_total"), money_sum("total_spending").alias("total_spending"))
    return out.select("*", (F.col("groups_total") - F.col("total_spending")).cast(MONEY).alias("difference"),
                      (F.abs(F.col("groups_total") - F.col("total_spending")) < dec("0.01")).alias("match"))


def dv_null_keys(mss, ct, pa, ps) -> DataFrame:
    checks = [("dst_monthly_spending_summary", mss, "person_name"), ("dst_monthly_spending_summary", mss, "category_name"),
              ("dst_category_trends", ct, "category_name"), ("dst_person_analytics", pa, "person_name"),
              ("dst_payment_method_summary", ps, "payment_method_name")]
    return _union([m.agg(F.count_if(F.col(c).isNull()).alias("null_count")).select(
        F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), "null_count") for t, m, c in checks])


def dv_person_consistency(latest: DataFrame, mss, pa) -> DataFrame:
    parts = [(n, d.agg(F.countDistinct("person_name").alias("distinct_persons")))
             for n, d in (("curated_spending_snapshots", latest), ("dst_monthly_spending_summary", mss),
                          ("dst_person_analytics", pa))]
    ref = latest.agg(F.countDistinct("person_name")).scalar()
    return _union([d.select(F.lit(n).alias("table_name"), "distinct_persons",
                            (F.col("distinct_persons") == ref).alias("match")) for n, d in parts])


def dv_verdict(latest: DataFrame, mss, ct, pa, ps) -> DataFrame:
    rows = [
        dv_total_reconcile(latest, mss, ct, pa, ps).select(
            F.when(~F.col("match"), F.concat(F.col("mart_name"), F.lit(" total does not match curated"))).alias("issue")),
        dv_count_reconcile(latest, mss, ct, pa, ps).select(
            F.when(~F.col("match"), F.concat(F.col("mart_name"), F.lit(" transaction count does not match curated")))
            .alias("issue")),
        dv_group_breakdown(pa).select(
            F.when(~F.col("match"), F.lit("category groups do not add up to total spending")).alias("issue")),
        dv_null_keys(mss, ct, pa, ps).select(
            F.when(F.col("null_count") > 0, F.concat(F.col("table_name"), F.lit("."), F.col("column_name"),
                                                     F.lit(" has NULL keys"))).alias("issue")),
        dv_person_consistency(latest, mss, pa).select(
            F.when(~F.col("match"), F.concat(F.col("table_name"), F.lit(" person count differs"))).alias("issue")),
    ]
    u = _union(rows)
    return u.agg((F.count("issue") == 0).alias("validation_passed"), F.count("issue").alias("issue_count"),
                 F.expr("listagg(issue, '; ') WITHIN GROUP (ORDER BY issue)").alias("issues"))



