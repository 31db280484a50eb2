"""Validation checks on hand rows."""

from ledgerlake.sources.fixture import adapter_config
from ledgerlake.operators import checks as K

SRC = ("src_id long, person_name string, spending_date string, category string, amount string, location string, "
       "description string, payment_method string, source_file string, load_batch_id string, loaded_at timestamp_ntz")


def test_duplicate_pair_counts_both_copies(spark):
    rows = [(1, "A", "01/01/2024", "Food", "1.00", "X", "d", "Cash", "f", "b", None),
            (2, "A", "01/01/2024", "Food", "1.00", "X", "e", "Cash", "f", "b", None),
            (3, "B", "01/01/2024", "Food", "1.00", None, "e", "Cash", "f", "b", None)]
    r = K.duplicates_check(spark.createDataFrame(rows, SRC), adapter_config()).collect()[0]
    assert r.records_failed == 2 and r.check_status == "FAILED" and r.sample_failed_ids == "1, 2"


def test_row_checks_and_samples(spark):
    rows = [(i, None if i % 3 == 0 else "P", "01/01/2024", "Food", "n/a" if i % 4 == 0 else "1.00", "X", "d", "Cash",
             "f", "b", None) for i in range(1, 40)]
    out = {r.check_name: r for r in K.row_level_checks(spark.createDataFrame(rows, SRC), adapter_config()).collect()}
    nulls = out["NULL_CHECK_REQUIRED_FIELDS"]
    assert nulls.records_failed == 13 and nulls.sample_failed_ids == ", ".join(str(i) for i in range(3, 31, 3))
    fmt = out["AMOUNT_FORMAT_CHECK"]
    assert fmt.records_failed == 9 and fmt.sample_failed_ids.startswith("4:n/a, 8:n/a")
    assert out["METADATA_COMPLETENESS_CHECK"].check_status == "PASSED"
