"""Source validation checks -> one check-log row each, plus the log views.

Plan shape: the five row-level checks share one scan (one aggregation of
``count_if`` flags); their sample ids come from a second pass that explodes
only failing rows and keeps the 10 smallest ids per check with a
``row_number`` filter, which Spark applies before the shuffle
(WindowGroupLimit), so no check ever gathers more than 10 ids. Duplicates
need their own grouping on the five business columns; only the first 50
ids of a duplicate group are kept for its sample text, however large the
group is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..config import Config
from ..functions.period import dec, pct, round2
from .ingest import ingest_reconcile

LOG_COLUMNS = ["validation_run_id", "validation_timestamp", "stage", "table_name", "check_name", "check_type",
               "check_status", "records_checked", "records_failed", "failure_percentage", "error_message",
               "sample_failed_ids"]

SAMPLE_IDS = 10

# FIXED VALUES: check names, types and messages.
# check name -> (type, failing-row predicate, denominator filter or None, message)
def _row_checks():
    p, d, c, a = (F.col(x) for x in ("person_name", "spending_date", "category", "amount"))
    blank = lambda x: F.trim(x) == ""  # noqa: E731  (TRIM removes spaces only)
    return {
        "NULL_CHECK_REQUIRED_FIELDS": (
            "ERROR", p.isNull() | d.isNull() | c.isNull() | a.isNull(), None,
            "Critical fields (person_name, spending_date, category, amount) cannot be NULL"),
        "EMPTY_STRING_CHECK": (
            "ERROR", blank(p) | blank(d) | blank(c) | blank(a), p.isNotNull(),
            "Required fields cannot be empty strings or whitespace"),
        "METADATA_COMPLETENESS_CHECK": (
            "ERROR", F.col("source_file").isNull() | F.col("load_batch_id").isNull(), None,
            "ETL metadata (source_file, load_batch_id) must not be NULL"),
        "AMOUNT_FORMAT_CHECK": (
            "WARNING", ~a.rlike(C.AMOUNT_FORMAT_REGEX), a.isNotNull(),
            "Amount field contains unusual characters or format (expected: numbers, dots, commas, $, SGD)"),
        "OPTIONAL_FIELDS_COMPLETENESS": (
            "WARNING", F.col("location").isNull() | F.col("description").isNull()
            | F.col("payment_method").isNull(), None,
            "Optional fields (location, description, payment_method) have missing values"),
    }


def _log_row(cfg: Config, check, ctype, checked: Column, failed: Column, message: Column, sample: Column):
    return [
        F.lit(cfg.validation_run_id).alias("validation_run_id"),
        F.lit(cfg.as_of).cast("timestamp_ntz").alias("validation_timestamp"),
        F.lit("SRC").alias("stage"), F.lit("src_daily_spending").alias("table_name"),
        F.lit(check).alias("check_name"), F.lit(ctype).alias("check_type"),
        F.when(failed == 0, "PASSED").otherwise("FAILED").alias("check_status"),
        checked.cast("bigint").alias("records_checked"), failed.cast("bigint").alias("records_failed"),
        pct(failed, checked).alias("failure_percentage"),
        message.alias("error_message"), sample.alias("sample_failed_ids"),
    ]


def row_level_checks(src: DataFrame, cfg: Config) -> DataFrame:
    checks = _row_checks()
    # pass 1: all counts in one aggregation
    aggs = []
    for name, (_t, bad, den, _m) in checks.items():
        scope = den if den is not None else F.lit(True)
        aggs += [F.count_if(scope).alias(f"{name}__n"), F.count_if(scope & bad).alias(f"{name}__f")]
    counts = src.agg(*aggs)
    # pass 2: up to 10 sample ids per check, from failing rows only
    tags = F.filter(F.array(*[F.when(bad, F.lit(name)) for name, (_t, bad, _d, _m) in checks.items()]),
                    lambda x: x.isNotNull())
    sample_text = F.when(F.col("check") == "AMOUNT_FORMAT_CHECK",
                         F.concat(F.col("src_id").cast("string"), F.lit(":"), F.col("amount"))) \
        .otherwise(F.col("src_id").cast("string"))
    flagged = src.select("src_id", "amount", F.explode(tags).alias("check"))
    rn = F.row_number().over(Window.partitionBy("check").orderBy("src_id"))
    samples = (flagged.withColumn("rn", rn).filter(F.col("rn") <= SAMPLE_IDS)
               .withColumn("txt", sample_text)
               .groupBy("check").agg(F.expr("listagg(txt, ', ') WITHIN GROUP (ORDER BY src_id)").alias("ids")))
    # one aggregate row -> one row per check (inline), so src is scanned once for all counts
    per_check = F.array(*[F.struct(F.lit(name).alias("check"), F.lit(ctype).alias("ctype"), F.lit(msg).alias("msg"),
                                   F.col(f"{name}__n").alias("n"), F.col(f"{name}__f").alias("f"))
                          for name, (ctype, _bad, _den, msg) in checks.items()])
    unpivoted = counts.select(F.inline(per_check))
    rows = unpivoted.select(
        F.lit(cfg.validation_run_id).alias("validation_run_id"),
        F.lit(cfg.as_of).cast("timestamp_ntz").alias("validation_timestamp"),
        F.lit("SRC").alias("stage"), F.lit("src_daily_spending").alias("table_name"),
        F.col("check").alias("check_name"), F.col("ctype").alias("check_type"),
        F.when(F.col("f") == 0, "PASSED").otherwise("FAILED").alias("check_status"),
        F.col("n").cast("bigint").alias("records_checked"), F.col("f").cast("bigint").alias("records_failed"),
        pct(F.col("f"), F.col("n")).alias("failure_percentage"),
        F.col("msg").alias("error_message"), F.lit(None).cast("string").alias("sample_failed_ids"))
    s = samples.withColumnRenamed("check", "check_name")
    return (rows.join(F.broadcast(s), "check_name", "left")  # at most 5 rows
            .withColumn("sample_failed_ids", F.col("ids")).select(*LOG_COLUMNS))


DUP_KEYS = ["person_name", "spending_date", "category", "amount", "location"]


def duplicates_check(src: DataFrame, cfg: Config) -> DataFrame:
    """Groups of identical (person, date, category, amount, location) rows,
    NULLs equal; failed = every copy. Sample: the first 3 groups (by first
    id), each as its first ids joined and cut to 50 characters."""
    groups = (src.groupBy(*DUP_KEYS)
              .agg(F.count(F.lit(1)).alias("dup_count"), F.min("src_id").alias("first_id"))
              .filter(F.col("dup_count") > 1))
    total = src.agg(F.count(F.lit(1))).scalar()
    stats = groups.agg(F.coalesce(F.sum("dup_count"), F.lit(0)).alias("failed"))
    first3 = groups.orderBy("first_id").limit(3).select(
        *[F.col(k).alias(f"_k_{k}") for k in DUP_KEYS], "first_id")
    members = src.join(F.broadcast(first3), [src[k].eqNullSafe(first3[f"_k_{k}"]) for k in DUP_KEYS])
    rn = F.row_number().over(Window.partitionBy("first_id").orderBy("src_id"))
    per_group = (members.select("first_id", "src_id", rn.alias("rn")).filter(F.col("rn") <= 50)
                 .groupBy("first_id")
                 .agg(F.substring(F.expr("listagg(cast(src_id as string), ', ') WITHIN GROUP (ORDER BY src_id)"),
                                  1, 50).alias("t")))
    sample = per_group.agg(F.expr("listagg(t, '; ') WITHIN GROUP (ORDER BY first_id)")).scalar()
    return stats.select(*_log_row(
        cfg, "DUPLICATE_RECORDS_CHECK", "ERROR", total, F.col("failed"),
        F.lit("Duplicate records found based on (person_name, spending_date, category, amount, location)"),
        sample))


def freshness_check(src: DataFrame, cfg: Config) -> DataFrame:
    latest = F.max("loaded_at")
    secs = (F.unix_timestamp(F.lit(cfg.as_of).cast("timestamp_ntz").cast("timestamp"))
            - F.unix_timestamp(latest.cast("timestamp")))
    hours = secs.cast("decimal(20,0)") / dec(3600)
    stale = hours >= cfg.freshness_hours
    msg = F.concat(F.lit(f"Data is older than {cfg.freshness_hours} hours. Last load: "),
                   F.date_format(latest, "yyyy-MM-dd HH:mm:ss"), F.lit(" ("), round2(hours, 1).cast("string"),
                   F.lit(" hours ago)"))
    return src.agg(
        F.lit(cfg.validation_run_id).alias("validation_run_id"),
        F.lit(cfg.as_of).cast("timestamp_ntz").alias("validation_timestamp"),
        F.lit("SRC").alias("stage"), F.lit("src_daily_spending").alias("table_name"),
        F.lit("DATA_FRESHNESS_CHECK").alias("check_name"), F.lit("WARNING").alias("check_type"),
        F.when(hours < cfg.freshness_hours, "PASSED").otherwise("FAILED").alias("check_status"),
        F.lit(1).cast("bigint").alias("records_checked"),
        F.when(stale, 1).otherwise(0).cast("bigint").alias("records_failed"),
        F.when(stale, dec("100.00")).otherwise(dec("0.00")).cast("decimal(18,2)").alias("failure_percentage"),
        msg.alias("error_message"),
        F.lit(None).cast("string").alias("sample_failed_ids"),
    )


def check_log(src: DataFrame, cfg: Config) -> DataFrame:
    """The seven check rows of one validation run."""
    return (row_level_checks(src, cfg).unionByName(duplicates_check(src, cfg))
            .unionByName(freshness_check(src, cfg)))


def load_event_log(reconciled: DataFrame, cfg: Config) -> DataFrame:
    """One log row per load batch, from ``ingest_reconcile``: success if every row landed."""
    whole, n, offered = F.col("status") == "MATCH", F.col("loaded_rows"), F.col("file_rows")
    text = F.when(whole, F.concat(F.lit("Successfully loaded "), n.cast("string"), F.lit(" rows"))).otherwise(
        F.concat(F.lit("Loaded "), n.cast("string"), F.lit(" of "), offered.cast("string"), F.lit(" rows")))
    return reconciled.select(
        F.col("load_batch_id").alias("validation_run_id"),
        F.lit(cfg.as_of).cast("timestamp_ntz").alias("validation_timestamp"),
        F.lit("SRC").alias("stage"), F.lit("src_daily_spending").alias("table_name"),
        F.when(whole, "DATA_LOAD_SUCCESS").otherwise("DATA_LOAD_FAILURE").alias("check_name"), F.lit("ERROR").alias("check_type"),
        F.when(whole, "PASSED").otherwise("FAILED").alias("check_status"), offered.alias("records_checked"),
        F.when(~whole, F.abs(offered - n)).alias("records_failed"),
        F.when(~whole, pct(F.abs(offered - n), offered)).alias("failure_percentage"),
        F.substring(text, 1, 500).alias("error_message"),
        F.lit(None).cast("string").alias("sample_failed_ids"),
    )


def validation_log(src: DataFrame, offered: DataFrame, cfg: Config) -> DataFrame:
    """The check log as appended by the loads and one validation run."""
    return load_event_log(ingest_reconcile(offered, src), cfg).unionByName(check_log(src, cfg))


def latest_validation_summary(log: DataFrame) -> DataFrame:
    run = log.agg(F.max("validation_run_id")).scalar()
    failed = F.col("check_status") == "FAILED"
    n = F.count(F.lit(1))
    return log.filter(F.col("validation_run_id") == run).groupBy("stage", "table_name").agg(
        n.alias("total_checks"),
        F.count_if(F.col("check_status") == "PASSED").alias("checks_passed"),
        F.count_if(failed).alias("checks_failed"),
        F.count_if(failed & (F.col("check_type") == "ERROR")).alias("errors"),
        F.count_if(failed & (F.col("check_type") == "WARNING")).alias("warnings"),
        pct(F.count_if(F.col("check_status") == "PASSED"), n).alias("pass_rate_pct"),
    )


def validation_by_type(log: DataFrame, cfg: Config) -> DataFrame:
    n = F.count(F.lit(1))
    return log.filter(F.col("validation_run_id") == cfg.validation_run_id).groupBy("check_type").agg(
        n.alias("total_checks"),
        F.count_if(F.col("check_status") == "PASSED").alias("passed"),
        F.count_if(F.col("check_status") == "FAILED").alias("failed"),
        pct(F.count_if(F.col("check_status") == "PASSED"), n).alias("pass_rate_pct"),
    )


def validation_failed_detail(log: DataFrame, cfg: Config) -> DataFrame:
    return log.filter((F.col("validation_run_id") == cfg.validation_run_id)
                      & (F.col("check_status") == "FAILED")).select(
        "check_name", "check_type", "records_checked", "records_failed", "failure_percentage", "error_message",
        "sample_failed_ids",
        F.when(F.col("check_type") == "ERROR", 1).otherwise(2).alias("severity_order"))


def validation_gate(log: DataFrame) -> DataFrame:
    s = latest_validation_summary(log).agg(
        F.coalesce(F.sum("errors"), F.lit(0)).alias("errors"),
        F.coalesce(F.sum("warnings"), F.lit(0)).alias("warnings"))
    return s.select("errors", "warnings",
                    F.when(F.col("errors") > 0, "STOP").when(F.col("warnings") > 0, "CAUTION")
                    .otherwise("CLEAR").alias("decision"),
                    (F.col("errors") == 0).alias("proceed"))
