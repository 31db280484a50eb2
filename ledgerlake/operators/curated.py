"""Helper queries and validation over the curated snapshots (2.B-C).

Time travel is a partition filter on ``snapshot_version``; version-level
statistics aggregate first and only then run their (global) windows, on one
row per version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..config import Config
from ..functions.period import MONEY, dec, pct
from .marts import avg_exact
from .reports import money_sum, top_k

def _n():
    return F.count(F.lit(1))


WEEKDAYS = C.WEEKDAY_NAMES
# FIXED VALUES: quality band labels (helper query and validation report differ in spacing)
HQ_BANDS = ["A+ (90-100)", "A (80-89)", "B (70-79)", "C (60-69)", "D (50-59)", "F (<50)"]
CV_BANDS = ["A+ (90-100)", "A  (80-89)", "B  (70-79)", "C  (60-69)", "D  (50-59)", "F  (<50)"]


def _band(score: Column, labels) -> Column:
    return (F.when(score >= 90, labels[0]).when(score >= 80, labels[1]).when(score >= 70, labels[2])
            .when(score >= 60, labels[3]).when(score >= 50, labels[4]).otherwise(labels[5]))


def _cnt():
    return _n().alias("transaction_count")


# -- helper queries ----------------------------------------------------------------

def hq01_latest(latest: DataFrame) -> DataFrame:
    s = latest.select("person_name", "category_name", "spending_date", "amount_cleaned", "description",
                      "stg_spending_id")
    return top_k(s, 100, F.desc("spending_date"), F.desc("stg_spending_id")).drop("stg_spending_id")


def hq02_version(cur: DataFrame, version: int) -> DataFrame:
    s = cur.filter(F.col("snapshot_version") == version).select(
        "person_name", "category_name", "spending_date", "amount_cleaned", "stg_spending_id")
    return top_k(s, 100, F.desc("spending_date"), F.desc("stg_spending_id")).drop("stg_spending_id")


def hq03_versions(cur: DataFrame) -> DataFrame:
    return cur.groupBy("snapshot_version", "snapshot_date", "is_latest").agg(
        _n().alias("record_count"), F.min("spending_date").alias("earliest_transaction"),
        F.max("spending_date").alias("latest_transaction"), money_sum("amount_cleaned").alias("total_amount"),
        avg_exact("data_quality_score").alias("avg_quality_score"))


def _spend_stats(prefix_avg="avg_transaction"):
    return [money_sum("amount_cleaned").alias("total_spent"), avg_exact("amount_cleaned").alias(prefix_avg)]


def hq04_top_categories(latest: DataFrame) -> DataFrame:
    g = latest.groupBy("category_name", "category_group").agg(
        _cnt(), *_spend_stats(), F.min("amount_cleaned").cast(MONEY).alias("min_spent"),
        F.max("amount_cleaned").cast(MONEY).alias("max_spent"))
    return top_k(g, 10, F.desc("total_spent"), "category_name")


def hq05_person(latest: DataFrame) -> DataFrame:
    return latest.groupBy("person_name").agg(
        _cnt(), *_spend_stats("avg_per_transaction"),
        F.countDistinct("category_name").alias("unique_categories"),
        F.countDistinct("payment_method_name").alias("payment_methods_used"))


def hq06_monthly(latest: DataFrame) -> DataFrame:
    return latest.groupBy("spending_year", "spending_month").agg(
        _cnt(), *_spend_stats(), F.countDistinct("person_name").alias("active_persons"))


def hq07_weekday(latest: DataFrame) -> DataFrame:
    name = F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), F.col("spending_day_of_week"))
    return latest.groupBy("spending_day_of_week").agg(
        F.first(name).alias("day_name"), _cnt(), *_spend_stats("avg_per_transaction"))


def hq08_top_locations(latest: DataFrame) -> DataFrame:
    g = latest.filter(F.col("location_name").isNotNull()).groupBy("location_name", "location_type").agg(
        _n().alias("visit_count"), *_spend_stats("avg_per_visit"))
    return top_k(g, 20, F.desc("total_spent"), "location_name")


def _version_summary(cur: DataFrame) -> DataFrame:
    return cur.groupBy("snapshot_version", "snapshot_date").agg(
        _n().alias("record_count"), money_sum("amount_cleaned").alias("total_spending"))


def hq09_compare_adjacent(cur: DataFrame) -> DataFrame:
    """Version v against v+1: an equi-join on the version number of two
    one-row-per-version aggregates (never a cross join)."""
    v = _version_summary(cur)
    older = v.select(*[F.col(c).alias(f"o_{c}") for c in v.columns])
    newer = v.select(*[F.col(c).alias(f"n_{c}") for c in v.columns])
    j = older.join(newer, F.col("n_snapshot_version") == F.col("o_snapshot_version") + 1)
    return j.select(
        F.col("o_snapshot_version").alias("older_version"), F.col("o_snapshot_date").alias("older_date"),
        F.col("o_record_count").alias("older_records"), F.col("o_total_spending").alias("older_spending"),
        F.col("n_snapshot_version").alias("newer_version"), F.col("n_snapshot_date").alias("newer_date"),
        F.col("n_record_count").alias("newer_records"), F.col("n_total_spending").alias("newer_spending"),
        (F.col("n_record_count") - F.col("o_record_count")).alias("record_growth"),
        (F.col("n_total_spending") - F.col("o_total_spending")).cast(MONEY).alias("spending_growth"),
        pct(F.col("n_record_count") - F.col("o_record_count"), F.col("o_record_count")).alias("growth_pct"))


def hq10_version_growth(cur: DataFrame) -> DataFrame:
    v = _version_summary(cur)
    w = Window.orderBy("snapshot_version")  # one row per version
    v = v.select("*", F.lag("record_count").over(w).alias("pc"), F.lag("total_spending").over(w).alias("ps"))
    return v.select(
        "snapshot_version", "snapshot_date", "record_count", "total_spending",
        F.when(F.col("pc").isNull(), F.col("record_count")).otherwise(F.col("record_count") - F.col("pc"))
         .alias("record_growth"),
        F.when(F.col("ps").isNull(), F.col("total_spending"))
         .otherwise(F.col("total_spending") - F.col("ps")).cast(MONEY).alias("spending_growth"))


def hq11_new_per_version(cur: DataFrame) -> DataFrame:
    """Rows whose id is absent from the previous version. The join is on the id, which the snapshots are
    bucketed by, so neither side is shuffled; that the versions follow each other is a condition beside it."""
    v = cur.select("snapshot_version", "stg_spending_id", "spending_date", "amount_cleaned")
    prev = cur.select(F.col("stg_spending_id").alias("prev_id"), F.col("snapshot_version").alias("prev_version"))
    follows = F.col("snapshot_version") - F.col("prev_version") == 1
    new = v.join(prev, (F.col("stg_spending_id") == F.col("prev_id")) & follows, "left_anti")
    return new.groupBy("snapshot_version").agg(
        _n().alias("new_transaction_count"), money_sum("amount_cleaned").alias("new_spending_amount"),
        F.min("spending_date").alias("earliest_new_transaction"),
        F.max("spending_date").alias("latest_new_transaction"))


def hq12_person_category(latest: DataFrame) -> DataFrame:
    return latest.groupBy("person_name", "category_name").agg(_cnt(), *_spend_stats("avg_per_transaction"))


def hq13_payment_pref(latest: DataFrame) -> DataFrame:
    return latest.groupBy("person_name", "payment_method_name", "payment_type").agg(
        _n().alias("usage_count"), *_spend_stats())


def hq14_high_value(latest: DataFrame) -> DataFrame:
    s = latest.select("person_name", "spending_date", "category_name", "location_name", "amount_cleaned",
                      "description", "payment_method_name", "stg_spending_id")
    return top_k(s, 50, F.desc("amount_cleaned"), "stg_spending_id").drop("stg_spending_id")


def hq15_quarterly(latest: DataFrame) -> DataFrame:
    return latest.groupBy("spending_year", "spending_quarter").agg(
        _cnt(), *_spend_stats(), F.countDistinct("person_name").alias("active_persons"),
        F.countDistinct("category_name").alias("categories_used"))


def _bands(latest: DataFrame, labels) -> DataFrame:
    total = latest.agg(_n()).scalar()
    return latest.groupBy(_band(F.col("data_quality_score"), labels).alias("quality_grade")).agg(
        _n().alias("record_count")).select("quality_grade", "record_count",
                                        pct(F.col("record_count"), total).alias("percentage"))


def hq16_quality_grades(latest: DataFrame) -> DataFrame:
    return _bands(latest, HQ_BANDS)


def hq17_quality_category(latest: DataFrame) -> DataFrame:
    return latest.groupBy("category_name").agg(
        _n().alias("record_count"), avg_exact("data_quality_score").alias("avg_quality_score"),
        F.min("data_quality_score").alias("min_quality"), F.max("data_quality_score").alias("max_quality"))


def hq18_person_versions(cur: DataFrame, person: str) -> DataFrame:
    return cur.filter(F.col("person_name") == person).groupBy(
        "snapshot_version", "snapshot_date", "person_name").agg(_cnt(), *_spend_stats("avg_per_transaction"))


def hq19_category_versions(cur: DataFrame, category: str) -> DataFrame:
    return cur.filter(F.col("category_name") == category).groupBy(
        "snapshot_version", "snapshot_date", "category_name").agg(_cnt(), money_sum("amount_cleaned").alias("total_spent"))


def hq20_as_of_date(cur: DataFrame, day) -> DataFrame:
    return cur.filter(F.col("snapshot_date") == F.lit(day)).groupBy("snapshot_version", "snapshot_date").agg(
        _n().alias("total_transactions"), money_sum("amount_cleaned").alias("total_spending"),
        F.countDistinct("person_name").alias("unique_persons"),
        F.countDistinct("category_name").alias("unique_categories"),
        F.min("spending_date").alias("earliest_transaction"), F.max("spending_date").alias("latest_transaction"))


EXPORT_COLUMNS = ["snapshot_version", "snapshot_date", "person_name", "category_name", "category_group",
                  "location_name", "location_type", "payment_method_name", "payment_type", "spending_date",
                  "spending_year", "spending_month", "spending_quarter", "spending_day_of_week", "amount_cleaned",
                  "currency_code", "description", "data_quality_score"]


def hq21_export(latest: DataFrame) -> DataFrame:
    return latest.select(*EXPORT_COLUMNS)


def export_csv(latest: DataFrame, path: str) -> None:
    """Sink of hq21: CSV files with a header, newest date first, then by person. Rows are range-partitioned by
    sampled bounds and sorted where they land; files read by name are in the query's order, and no task sorts
    more than its range."""
    order = [F.desc("spending_date"), F.asc("person_name"), F.asc("stg_spending_id")]
    rows = latest.repartitionByRange(*order).sortWithinPartitions(*order)
    hq21_export(rows).write.mode("overwrite").option("header", True).csv(path)


def hq22_diff_versions(cur: DataFrame, v1: int, v2: int) -> DataFrame:
    cols = ["stg_spending_id", "person_name", "category_name", "spending_date", "amount_cleaned"]
    a = cur.filter(F.col("snapshot_version") == v1).select(*[F.col(c).alias(f"a_{c}") for c in cols])
    b = cur.filter(F.col("snapshot_version") == v2).select(*[F.col(c).alias(f"b_{c}") for c in cols])
    j = a.join(b, F.col("a_stg_spending_id") == F.col("b_stg_spending_id"), "full_outer")
    return j.select(
        F.coalesce("a_stg_spending_id", "b_stg_spending_id").alias("spending_id"),
        F.col("a_person_name").alias("v1_person"), F.col("b_person_name").alias("v2_person"),
        F.col("a_category_name").alias("v1_category"), F.col("b_category_name").alias("v2_category"),
        F.col("a_spending_date").alias("v1_date"), F.col("b_spending_date").alias("v2_date"),
        F.col("a_amount_cleaned").alias("v1_amount"), F.col("b_amount_cleaned").alias("v2_amount"),
        F.when(F.col("a_stg_spending_id").isNull(), "New in V2").when(F.col("b_stg_spending_id").isNull(),
                                                                      "Removed in V2")
         .otherwise("Exists in Both").alias("status"))


def cur_time_travel_sum(cur: DataFrame, version: int) -> DataFrame:
    return cur.filter(F.col("snapshot_version") == version).groupBy("person_name", "category_name").agg(
        money_sum("amount_cleaned").alias("total_spent"), _cnt())


def cur_version_totals(cur: DataFrame) -> DataFrame:
    return cur.groupBy("snapshot_version").agg(_n().alias("record_count"),
                                               money_sum("amount_cleaned").alias("total_spending"))


# -- curated validation --------------------------------------------------------------

def cv_latest_integrity(cur: DataFrame) -> DataFrame:
    lat = F.col("is_latest") == 1
    return cur.agg(
        F.countDistinct(F.when(lat, F.col("snapshot_version"))).alias("latest_versions"),
        F.max(F.when(lat, F.col("snapshot_version"))).alias("latest_version"),
        F.max(F.when(lat, F.col("snapshot_date"))).alias("latest_snapshot_date"),
        F.count_if(lat).alias("latest_rows"),
        F.count_if(~F.col("is_latest").isin(0, 1)).alias("invalid_flags"))


REQUIRED = ["snapshot_version", "snapshot_date", "stg_spending_id", "person_id", "category_id", "spending_date",
            "amount_cleaned"]
DENORMALISED = ["person_name", "category_name", "location_name", "payment_method_name"]


def cv_completeness(cur: DataFrame) -> DataFrame:
    items = [F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("kind"),
                      F.count_if(F.col(c).isNull()).alias("null_count"))
             for kind, cols in (("required", REQUIRED), ("denormalised", DENORMALISED)) for c in cols]
    return cur.agg(F.array(*items).alias("a"), _n().alias("total_records")).select(
        F.inline("a"), "total_records")


def cv_stg_consistency(fact: DataFrame, latest: DataFrame) -> DataFrame:
    stg_n = fact.agg(_n()).scalar()
    missing = fact.join(latest.select(F.col("stg_spending_id").alias("spending_id")), "spending_id",
                        "left_anti").agg(_n()).scalar()
    return latest.agg(_n().alias("curated_latest_count")).select(
        stg_n.alias("stg_count"), "curated_latest_count",
        (stg_n == F.col("curated_latest_count")).alias("counts_match"), missing.alias("missing_in_curated"))


def cv_version_history(cur: DataFrame, last: int = 10) -> DataFrame:
    stats = cur.agg(F.countDistinct("snapshot_version").alias("v"), F.min("snapshot_version").alias("f"),
                    F.max("snapshot_version").alias("l"), _n().alias("n"))
    per = cur.groupBy("snapshot_version", "snapshot_date", "is_latest").agg(
        _n().alias("record_count"), F.min("spending_date").alias("earliest_transaction"),
        F.max("spending_date").alias("latest_transaction"))
    per = top_k(per, last, F.desc("snapshot_version"))
    s = {k: stats.select(k).scalar() for k in ("v", "f", "l", "n")}
    return per.select("*", s["v"].alias("total_versions"), s["f"].alias("first_version"),
                      s["l"].alias("latest_version"), s["n"].alias("total_records"),
                      F.floor(s["n"] / s["v"]).cast("bigint").alias("avg_records_per_version"))


def cv_growth_pct(cur: DataFrame, last: int = 5) -> DataFrame:
    v = cur.groupBy("snapshot_version").agg(_n().alias("record_count"))
    w = Window.orderBy("snapshot_version")  # one row per version
    v = v.select("*", F.lag("record_count").over(w).alias("pc"))
    out = v.select(
        "snapshot_version", "record_count",
        F.when(F.col("pc").isNull(), F.col("record_count")).otherwise(F.col("record_count") - F.col("pc"))
         .alias("growth"),
        F.when(F.col("pc").isNull(), dec("0.00").cast(MONEY))
         .otherwise(pct(F.col("record_count") - F.col("pc"), F.col("pc"))).alias("growth_pct"))
    return top_k(out, last, F.desc("snapshot_version"))


def cv_date_ranges(cur: DataFrame, cfg: Config) -> DataFrame:
    today = F.lit(cfg.as_of.date())
    return cur.agg(
        F.min("spending_date").alias("earliest_transaction"), F.max("spending_date").alias("latest_transaction"),
        F.min("snapshot_date").alias("first_snapshot"), F.max("snapshot_date").alias("latest_snapshot"),
        F.datediff(F.max("snapshot_date"), F.min("snapshot_date")).alias("snapshot_span_days"),
        F.datediff(F.max("spending_date"), F.min("spending_date")).alias("transaction_span_days"),
        F.count_if(F.col("spending_date") > today).alias("future_rows"),
        F.count_if(F.col("spending_date") < F.lit("2020-01-01").cast("date")).alias("rows_before_2020"))


def cv_quality_stats(latest: DataFrame) -> DataFrame:
    s = latest.agg(_n().alias("total_records"), avg_exact("data_quality_score").alias("avg_score"),
                   F.min("data_quality_score").alias("min_score"), F.max("data_quality_score").alias("max_score"),
                   F.round(F.stddev_samp("data_quality_score"), 2).cast(MONEY).alias("std_dev"))
    return s.withColumn("status", F.when(F.col("avg_score") >= 80, "PASS").when(F.col("avg_score") >= 70, "WARN")
                        .otherwise("FAIL"))


def cv_quality_bands(latest: DataFrame) -> DataFrame:
    return _bands(latest, CV_BANDS)


def cv_low_quality(latest: DataFrame) -> DataFrame:
    return latest.agg(F.count_if(F.col("data_quality_score") < 70).alias("low_quality_rows"),
                      _n().alias("total_rows")).select(
        "low_quality_rows", "total_rows", pct(F.col("low_quality_rows"), F.col("total_rows")).alias("low_quality_pct"))


def cv_quality_by_version(cur: DataFrame, last: int = 5) -> DataFrame:
    g = cur.groupBy("snapshot_version").agg(
        _n().alias("records"), avg_exact("data_quality_score").alias("avg_score"),
        F.min("data_quality_score").alias("min_score"), F.max("data_quality_score").alias("max_score"))
    return top_k(g, last, F.desc("snapshot_version"))


def cv_version_count_advice(cur: DataFrame) -> DataFrame:
    n = F.col("version_count")
    return cur.agg(F.countDistinct("snapshot_version").alias("version_count")).select(
        "version_count", F.when(n > 30, "ARCHIVE").when(n > 10, "MONITOR").otherwise("OK").alias("advice"))


def cv_duplicate_ids(cur: DataFrame, last: int = 20) -> DataFrame:
    d = cur.groupBy("snapshot_version", "stg_spending_id").agg(_n().alias("duplicate_count")).filter(
        F.col("duplicate_count") > 1)
    extra = d.agg(F.coalesce(F.sum(F.col("duplicate_count") - 1), F.lit(0)).cast("bigint")).scalar()
    top = top_k(d, last, F.desc("snapshot_version"), F.desc("duplicate_count"), "stg_spending_id")
    return top.select("*", extra.alias("extra_copies_total"))


def cv_cross_version_ids(cur: DataFrame) -> DataFrame:
    return cur.groupBy("stg_spending_id").agg(F.countDistinct("snapshot_version").alias("version_count")).filter(
        F.col("version_count") > 1)


def cv_verdict(cur: DataFrame, latest: DataFrame, fact: DataFrame, cfg: Config) -> DataFrame:
    """Overall pass flag and the list of issues found by the checks above."""
    li = cv_latest_integrity(cur)
    nulls = cur.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in REQUIRED])
    cons = cv_stg_consistency(fact, latest)
    dups = cur.groupBy("snapshot_version", "stg_spending_id").agg(_n().alias("c")).filter(F.col("c") > 1).agg(
        _n().alias("dup_ids"))
    low = cv_low_quality(latest)
    fut = cv_date_ranges(cur, cfg).select("future_rows")

    def issue(df, cond, text, fails=True):
        return df.select(F.when(cond, text).alias("issue"), (cond & F.lit(fails)).alias("fails"))

    rows = [
        issue(li, F.col("latest_versions") == 0, F.lit("No latest version")),
        issue(li, F.col("latest_versions") > 1,
              F.concat(F.lit("Multiple versions ("), F.col("latest_versions").cast("string"),
                       F.lit(") have is_latest = 1"))),
        issue(li, F.col("invalid_flags") > 0,
              F.concat(F.col("invalid_flags").cast("string"), F.lit(" records with invalid is_latest values"))),
        *[issue(nulls, F.col(c) > 0, F.concat(F.col(c).cast("string"), F.lit(f" NULL values in {c}")))
          for c in REQUIRED],
        issue(cons, ~F.col("counts_match"),
              F.concat(F.lit("STG/CURATED count mismatch: "),
                       F.abs(F.col("stg_count") - F.col("curated_latest_count")).cast("string"), F.lit(" records"))),
        issue(cons, F.col("missing_in_curated") > 0,
              F.concat(F.col("missing_in_curated").cast("string"), F.lit(" STG records not in CURATED"))),
        issue(fut, F.col("future_rows") > 0,
              F.concat(F.col("future_rows").cast("string"), F.lit(" records with future dates")), False),
        issue(low, F.col("low_quality_rows") > 0,
              F.concat(F.col("low_quality_rows").cast("string"), F.lit(" records with low quality scores")), False),
        issue(dups, F.col("dup_ids") > 0,
              F.concat(F.col("dup_ids").cast("string"), F.lit(" duplicate stg_spending_ids found"))),
    ]
    u = rows[0]
    for r in rows[1:]:
        u = u.unionByName(r)
    return u.agg(
        (~F.bool_or("fails")).alias("validation_passed"),
        F.count("issue").alias("issue_count"),
        F.expr("listagg(issue, '; ') WITHIN GROUP (ORDER BY issue)").alias("issues"))
