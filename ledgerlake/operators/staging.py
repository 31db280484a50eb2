"""Staging: clean and classify raw rows, split rejects, build the star schema.

``stg_transform`` is one projection (no shuffle). Dimensions are keyed by the
first ``src_id`` that introduced the name, which is unique, stable across
reloads and needs no global ordering; the SCD-1 attribute winner is the
(name, attribute) pair first seen last, computed with ``max_by``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions import clean as X

DIM_SPECS = {
    # dim name: (name column, attribute column or None, key column)
    "person": ("person_name", None, "person_id"),
    "location": ("location_name", "location_type", "location_id"),
    "category": ("category_name", "category_group", "category_id"),
    "payment_method": ("payment_method_name", "payment_type", "payment_method_id"),
}


def stg_transform(src: DataFrame, cfg: Config) -> DataFrame:
    """All cleaning and classification, as chained projections with no shuffle.

    The parsed date and amount are produced in their own projection and then
    referenced; Catalyst keeps them as separate Project nodes (a non-cheap
    expression used several times is not inlined), so each row parses its
    text once and the generated code stays small.
    """
    parsed = src.select(
        "*",
        X.parse_date(F.col("spending_date")).alias("_date"),
        X.parse_amount(F.col("amount")).alias("_amount"),
    )
    df = parsed.select(
        "src_id",
        X.strip_ws(F.col("person_name")).alias("person_name"),
        F.col("spending_date").alias("spending_date_raw"),
        F.col("_date").alias("spending_date"),
        F.col("amount").alias("amount_raw"),
        F.col("_amount").alias("amount_cleaned"),
        X.currency_code(F.col("amount")).alias("currency_code"),
        X.strip_ws(F.col("location")).alias("location_name"),
        X.classify_location(F.col("location")).alias("location_type"),
        X.strip_ws(F.col("category")).alias("category_name"),
        X.classify_category(F.col("category")).alias("category_group"),
        X.strip_ws(F.col("payment_method")).alias("payment_method_name"),
        X.classify_payment(F.col("payment_method")).alias("payment_type"),
        "description", "source_file", "load_batch_id",
        *[v.alias(k) for k, v in X.date_parts(F.col("_date")).items()],
        F.col("_amount").isNotNull().alias("is_amount_parsed_successfully"),
        F.col("_date").isNotNull().alias("is_date_parsed_successfully"),
        F.lit(cfg.transform_batch_id).alias("transform_batch_id"),
    )
    return df.withColumn("data_quality_score", X.quality_score(
        F.col("is_amount_parsed_successfully"), F.col("is_date_parsed_successfully"),
        F.col("description"), F.col("person_name"), F.col("location_name"), F.col("category_name")))


def reject_reason() -> F.Column:
    """First failing rule of a staged row, NULL when the row is loadable."""
    return (F.when(~F.col("is_amount_parsed_successfully"), "invalid_amount")
            .when(~F.col("is_date_parsed_successfully"), "invalid_date")
            .when(F.col("person_name").isNull(), "missing_person")
            .when(F.col("location_name").isNull(), "missing_location")
            .when(F.col("category_name").isNull(), "missing_category")
            .when(F.col("payment_method_name").isNull(), "missing_payment_method"))


def parsed_rows(stg: DataFrame) -> DataFrame:
    """Rows whose amount and date both parsed (the reference's valid set)."""
    return stg.filter(F.col("is_amount_parsed_successfully") & F.col("is_date_parsed_successfully"))


def loadable_rows(stg: DataFrame) -> DataFrame:
    return stg.filter(reject_reason().isNull())


def stg_rejects(stg: DataFrame) -> DataFrame:
    return (stg.withColumn("reject_reason", reject_reason())
            .filter(F.col("reject_reason").isNotNull())
            .select("src_id", "person_name", "spending_date_raw", "amount_raw", "location_name", "reject_reason"))


def reject_counts(stg: DataFrame) -> DataFrame:
    """How many rows fail each rule; a row that fails several counts for each."""
    rules = {"invalid_amount": ~F.col("is_amount_parsed_successfully"), "invalid_date": ~F.col("is_date_parsed_successfully"),
             "missing_person": F.col("person_name").isNull(), "missing_location": F.col("location_name").isNull(),
             "missing_category": F.col("category_name").isNull(),
             "missing_payment_method": F.col("payment_method_name").isNull()}
    counts = stg.agg(*[F.count_if(bad).alias(name) for name, bad in rules.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("reject_reason"), F.col(n).alias("row_count")) for n in rules])
    return counts.select(F.inline(pairs))


def dimension_pairs(stg: DataFrame) -> DataFrame:
    """First src_id of every (dimension, name, attribute) of a load batch among parsed rows.

    One scan of staging for all four dimensions: each row contributes up to
    four (dim, name, attr) entries through ``explode``, and one partial +
    final aggregation reduces them (the result has one row per distinct
    pair, so it is small even when the fact is huge).
    """
    entries = F.array(*[
        F.struct(F.lit(d).alias("dim"), F.col(name).alias("name"),
                 (F.col(attr) if attr else F.lit(None).cast("string")).alias("attr"))
        for d, (name, attr, _key) in DIM_SPECS.items()])
    rows = parsed_rows(stg).select("src_id", "load_batch_id", F.explode(entries).alias("e"))
    return (rows.filter(F.col("e.name").isNotNull())
            .groupBy("load_batch_id", F.col("e.dim").alias("dim"), F.col("e.name").alias("name"), F.col("e.attr").alias("attr"))
            .agg(F.min("src_id").alias("first_src_id")))


def dimension(pairs: DataFrame, dim: str) -> DataFrame:
    """One row per distinct name: key = first src_id of the name, attribute =
    that of the pair whose first occurrence is latest (SCD-1 upsert order)."""
    name, attr, key = DIM_SPECS[dim]
    p = pairs.filter(F.col("dim") == dim).groupBy("name", "attr").agg(F.min("first_src_id").alias("first_src_id"))
    if attr is None:
        return p.groupBy("name").agg(F.min("first_src_id").alias(key)).select(key, F.col("name").alias(name))
    return (p.groupBy("name")
            .agg(F.min("first_src_id").alias(key), F.max_by("attr", "first_src_id").alias(attr))
            .select(key, F.col("name").alias(name), attr))


def fact_spending(stg: DataFrame, dims: dict, cfg: Config) -> DataFrame:
    """Loadable rows with the four dimension keys (rows missing a key are rejects)."""
    f = loadable_rows(stg)
    for dim, (name, _attr, key) in DIM_SPECS.items():
        f = f.join(dims[dim].select(key, name), name)
    return f.select(
        F.col("src_id").alias("spending_id"),
        "person_id", "location_id", "category_id", "payment_method_id",
        "spending_date", "spending_year", "spending_month", "spending_day", "spending_quarter",
        "spending_day_of_week", "amount_raw", "amount_cleaned", "currency_code", "description",
        "is_amount_parsed_successfully", "is_date_parsed_successfully", "data_quality_score",
        "src_id", "transform_batch_id",
        F.lit(cfg.as_of).cast("timestamp_ntz").alias("transformed_at"), "load_batch_id",
    )


def spending_complete(fact: DataFrame, dims: dict) -> DataFrame:
    """Denormalised fact (19 columns, then keys and batch); attributes come from the dimensions."""
    f = fact
    for dim, (name, attr, key) in DIM_SPECS.items():
        cols = [key, name] + ([attr] if attr else [])
        f = f.join(dims[dim].select(*cols), key)
    return f.select(
        "spending_id", "person_name", "spending_date", "spending_year", "spending_month",
        "spending_quarter", "spending_day_of_week", "category_name", "category_group",
        "amount_cleaned", "currency_code", "location_name", "location_type", "description",
        "payment_method_name", "payment_type", "data_quality_score", "src_id", "transformed_at",
        # carried for the snapshot job
        "person_id", "category_id", "location_id", "payment_method_id", "load_batch_id",
    )
