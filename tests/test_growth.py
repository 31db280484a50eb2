"""Steps of the chain whose cost per row counts on large tables."""

import os
import re
import tempfile

from pyspark.sql import functions as F

from ledgerlake.functions import clean as X
from ledgerlake.operators import marts as M
from ledgerlake.operators import staging as G
from ledgerlake.sources import fixture
from ledgerlake.sources.raw_files import RAW_SCHEMA, file_position, with_ids

SF_SMALL = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_cleaning_trims_without_patterns(spark):
    src = spark.createDataFrame([], "src_id long, source_file string, load_batch_id string, "
                                + ", ".join(f"{c} string" for c in RAW_SCHEMA.fieldNames()))
    p = _optimized(G.stg_transform(src, fixture.adapter_config()))
    assert "regexp_replace" not in p and "EEEE" not in p


def test_trimming_is_that_of_python(spark):
    texts = ["", None, "\n", " a\x1c", "\x85a b\xa0", "  a ", " a\r\n", "​a", "　  ", "a  b"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    assert [r.t for r in df.select(X.strip_ws(F.col("s")).alias("t")).collect()] == [t if t is None else t.strip() for t in texts]


def test_a_day_without_a_date_has_no_name(spark):
    df = spark.createDataFrame([("2024-02-29",), (None,)], "s string")
    day = X.date_parts(F.col("s").cast("date"))["spending_day_of_week"]
    assert [r.d for r in df.select(day.alias("d")).collect()] == ["Thursday", None]


def test_raw_texts_are_made_after_sorting(spark):
    p = _optimized(fixture.raw_spending(fixture.load_tables(spark, SF_SMALL)))
    dealt = p.index("RepartitionByExpression")
    assert "date_format" in p[:dealt] and "date_format" not in p[dealt:]


def test_ids_leave_rows_where_they_are_read(spark):
    path = f"{tempfile.mkdtemp(prefix='ledgerlake-')}/raw"
    rows = [("p", "2024-01-01", "Food", str(i), None, None, None) for i in range(40)]
    spark.createDataFrame(rows, RAW_SCHEMA).repartition(4).write.parquet(path)
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = with_ids(file_position(spark.read.schema(RAW_SCHEMA).parquet(path)), 7)
        assert "SortMergeJoin" not in _plan(out)
        assert sorted(r.src_id for r in out.collect()) == list(range(7, 47))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 4


def test_person_sums_are_made_once_per_row(spark):
    latest = spark.createDataFrame([], "spending_year int, spending_month int, spending_date date, spending_day_of_week int, person_name string, "
                                       "category_name string, category_group string, location_name string, payment_method_name string, "
                                       "amount_cleaned decimal(12,2), data_quality_score int, snapshot_version int").repartition(2)
    lines = M.person_analytics(latest, fixture.adapter_config())._jdf.queryExecution().analyzed().toString().split("\n")
    exploded = [i for i, line in enumerate(lines) if re.search(r"\bGenerate explode", line)]
    assert len(exploded) == 1
    above = lines[exploded[0] - 2]
    assert "Project [" in above and "amount_cleaned" not in above and "amount_cleaned" not in lines[exploded[0] - 1]
