"""Ingest reports and source-file profiling (2.B-I)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions import clean as X
from ..functions.period import pct, round2
from ..sources.raw_files import SOURCE
from ..sources.tables import TableStore

RAW_TEXT = ["person_name", "spending_date", "category", "amount", "location", "description", "payment_method"]


def ingest_reconcile(offered: DataFrame, src: DataFrame) -> DataFrame:
    """Per load batch: rows offered by its files vs rows landed."""
    landed = src.groupBy("load_batch_id").agg(F.count(F.lit(1)).alias("loaded_rows"))
    both = offered.join(landed, "load_batch_id", "left").withColumn("loaded_rows", F.coalesce("loaded_rows", F.lit(0)))
    return both.select("load_batch_id", "file_rows", "loaded_rows",
                       F.when(F.col("loaded_rows") == F.col("file_rows"), "MATCH").otherwise("MISMATCH").alias("status"))


def load_sample(src: DataFrame, cfg: Config, n: int = 5) -> DataFrame:
    return (src.filter(F.col("load_batch_id") == cfg.load_batch_id)
            .select("src_id", "person_name", "spending_date", "category", "amount")
            .orderBy("src_id").limit(n))


def profile_file(raw: dict[str, DataFrame]) -> DataFrame:
    """Rows, columns and the column list of each load batch's raw input files."""
    out = []
    for batch, files in raw.items():
        cols = [(batch, i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(files.schema.fields)]
        meta = files.sparkSession.createDataFrame(cols, "load_batch_id string, ordinal int, column_name string, data_type string")
        out.append(meta.select("*", files.agg(F.count(F.lit(1))).scalar().alias("total_rows"), F.lit(len(cols)).alias("total_columns")))
    return reduce(DataFrame.unionByName, out)


def profile_file_sizes(groups: DataFrame) -> DataFrame:
    """The raw input files with their rows, bytes and row groups, from their footers."""
    return groups.groupBy("load_batch_id", "file_path").agg(
        F.sum("row_count").alias("row_count"), F.max("file_size_bytes").alias("file_size_bytes"),
        F.count(F.lit(1)).alias("num_row_groups"))


STATES = "src_profile_states"


def profile_state(rows: DataFrame) -> DataFrame:
    """What a profile needs of some rows, per column, in a form that adds up: counts, extremes, a sum and a sketch
    of the distinct values. One aggregation over all columns."""
    types = dict((f.name, f.dataType.simpleString()) for f in rows.schema.fields)
    none = lambda kind: F.lit(None).cast(kind)
    structs = []
    for c in ["src_id", *RAW_TEXT]:
        numeric = types[c] in ("bigint", "int")
        structs.append(F.struct(
            F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"),
            F.count(F.lit(1)).alias("row_count"), F.count_if(F.col(c).isNull()).alias("null_count"),
            (F.min(c).cast("bigint") if numeric else none("bigint")).alias("min_number"),
            (F.max(c).cast("bigint") if numeric else none("bigint")).alias("max_number"),
            (none("string") if numeric else F.min(c)).alias("min_text"), (none("string") if numeric else F.max(c)).alias("max_text"),
            (F.sum(c).cast("decimal(38,0)") if numeric else none("decimal(38,0)")).alias("sum_value"),
            F.hll_sketch_agg(c, F.lit(12)).alias("distinct_sketch")))
    return rows.agg(F.array(*structs).alias("p")).select(F.inline("p"))


def store_profiles(store: TableStore) -> DataFrame:
    """The states of all load batches. Only batches that have none, or were loaded anew since, are scanned."""
    source = store.manifest(SOURCE)["parts"]
    for part, folder in source.items():
        held = store.manifest(STATES) or {"parts": {}}
        if part not in held["parts"] or held["properties"].get(part) != folder:
            state = profile_state(store.read(SOURCE, parts=[part])).withColumn("load_batch_id", F.lit(part.split("=", 1)[1]))
            store.write_part(state, STATES, "load_batch_id", part.split("=", 1)[1], properties={part: folder})
    return store.read(STATES, parts=list(source))


def _merged(states: DataFrame) -> DataFrame:
    return states.groupBy("column_name", "data_type").agg(
        F.sum("row_count").alias("rows"), F.sum("null_count").alias("null_count"),
        F.coalesce(F.min("min_number").cast("string"), F.min("min_text")).alias("min_value"),
        F.coalesce(F.max("max_number").cast("string"), F.max("max_text")).alias("max_value"),
        F.sum("sum_value").cast("decimal(38,0)").alias("sum_value"), F.hll_union_agg("distinct_sketch").alias("sketch"))


def profile_columns(states: DataFrame) -> DataFrame:
    """Per column: type, nulls, null %, non-null count, min, max, and sum / mean for numeric columns."""
    filled = F.col("rows") - F.col("null_count")
    return _merged(states).select(
        "column_name", "data_type", "null_count", pct(F.col("null_count"), F.col("rows")).alias("null_pct"),
        filled.alias("non_null_count"), "min_value", "max_value", "sum_value",
        round2(F.col("sum_value") / F.nullif(filled, F.lit(0)).cast("decimal(20,0)")).alias("mean_value"))


def profile_distinct(states: DataFrame) -> DataFrame:
    """About how many distinct values each column has (a few percent off)."""
    return _merged(states).select("column_name", F.hll_sketch_estimate("sketch").alias("distinct_values"))


def profile_integrity(src: DataFrame) -> DataFrame:
    """Negative parsed amounts, extra copies of identical rows, unparseable dates."""
    amount = X.parse_amount(F.col("amount"))
    date = X.parse_date(F.col("spending_date"))
    base = src.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(amount < 0).alias("negative_amounts"),
        F.count_if(date.isNull()).alias("invalid_dates"))
    extra = (src.groupBy(*RAW_TEXT).agg(F.count(F.lit(1)).alias("n"))
             .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint")).scalar())
    return base.select("total_rows", "negative_amounts", extra.alias("duplicate_rows"), "invalid_dates")


def profile_value_counts(src: DataFrame, top: int = 5) -> DataFrame:
    """Rows per person (unranked: persons are unbounded); top categories and
    payment methods, ranked only after the bounded top-k (ties by name)."""
    persons = src.groupBy(F.col("person_name").alias("value")).agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit("person_name").alias("field"), "value", "row_count", F.lit(None).cast("int").alias("rank"))
    out = persons
    for col in ("category", "payment_method"):
        g = src.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("row_count"))
        g = g.orderBy(F.desc("row_count"), F.asc_nulls_first("value")).limit(top)
        g = g.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("row_count"), F.asc_nulls_first("value"))))
        out = out.unionByName(g.select(F.lit(col).alias("field"), "value", "row_count", "rank"))
    return out
