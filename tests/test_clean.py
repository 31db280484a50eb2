"""Hand rows for the cleaning and classification expressions."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlake.functions import clean as X


def _one(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r[0] for r in df.select(expr(F.col("s"))).collect()]


def test_amounts(spark):
    got = _one(spark, ["155.66", "$40.10", "333.95 SGD", "SGD 17.51", "1,234.5", "sgd 5", "-3"], X.parse_amount)
    assert got == [Decimal("155.66"), Decimal("40.10"), Decimal("333.95"), Decimal("17.51"), Decimal("1234.50"),
                   Decimal("5.00"), Decimal("-3.00")]


def test_amount_rejects(spark):
    assert _one(spark, ["", None, "abc", "NaN", "USD 5", "   "], X.parse_amount) == [None] * 6


def test_dates(spark):
    got = _one(spark, ["01-Apr-2022", "14/05/2024", "2023-09-28", "21/10/24", "05-01-2020"], X.parse_date)
    assert got == [dt.date(2022, 4, 1), dt.date(2024, 5, 14), dt.date(2023, 9, 28), dt.date(2024, 10, 21),
                   dt.date(2020, 1, 5)]


def test_two_digit_year_pivot(spark):
    assert _one(spark, ["01/04/70", "01/04/68"], X.parse_date) == [dt.date(1970, 4, 1), dt.date(2068, 4, 1)]


def test_date_rejects(spark):
    assert _one(spark, ["31/02/2024", "", None, "not a date"], X.parse_date) == [None] * 4


def test_location(spark):
    got = _one(spark, ["Grab", "MRT Station", "Business Park", "Clinic", None], X.classify_location)
    assert got == ["Online", "Transport", "Transport", "Physical", "Unknown"]


def test_payment(spark):
    got = _one(spark, ["Credit Card", "PayNow", "FlashPay", "EZ-Link", "GIRO", "Cash"], X.classify_payment)
    assert got == ["Card", "Digital Wallet", "Digital Wallet", "Transit Card", "Bank Transfer", "Other"]


def test_category(spark):
    got = _one(spark, ["Food", "Dining", " Food", "Fitness"], X.classify_category)
    assert got == ["Essential", "Discretionary", "Other", "Other"]


def test_score(spark):
    df = spark.createDataFrame([(True, True, "x", "p", "l", "c"), (True, True, None, "p", "l", "c"),
                                (True, True, "x", "", "", "c")],
                               "a boolean, d boolean, desc string, p string, l string, c string")
    got = [r[0] for r in df.select(X.quality_score(F.col("a"), F.col("d"), F.col("desc"), F.col("p"), F.col("l"),
                                                   F.col("c"))).collect()]
    assert got == [100, 90, 75]


def test_every_date_form_and_unicode_blanks(spark):
    import datetime as dt
    from decimal import Decimal

    from pyspark.sql import functions as F

    from ledgerlake.functions import clean as X
    day, first = dt.date(2024, 5, 14), dt.date(2024, 9, 1)
    forms = {"14-May-2024": day, "14/5/2024": day, "2024-5-14": day, "14/05/24": day, "14-05-2024": day, "14-5-24": day,
             "2024/05/14": day, "14-May-24": day, "14 May 2024": day, "1 September 2024": first, "May 14, 2024": day,
             "September 1, 2024": first, "20240514": day, "2024-05-14 10:00:00": day, "2024-05-14T10:00:00": day,
             "2024-05-14 10:00": day, "14.05.2024": day, "14 May 24": day, "1-September-2024": first, "May 14 2024": day,
             "September 1 2024": first, "14.5.24": day, "1-September-24": first, " 14/05/2024　": day,
             "14/05/69": dt.date(1969, 5, 14), "14/05/68": dt.date(2068, 5, 14), "31/02/2024": None, "soon": None, " ": None}
    df = spark.createDataFrame(list(forms.items()), "s string, want date")
    got = {r.s: r.got for r in df.select("s", X.parse_date(F.col("s")).alias("got")).collect()}
    assert got == forms
    amounts = {"155.66 ": "155.66", " $1,200.50": "1200.50", "SGD 7": "7.00", "sgd 3.005": "3.01", " ": None}
    df = spark.createDataFrame(list(amounts.items()), "s string, want string")
    got = {r.s: r.got for r in df.select("s", X.parse_amount(F.col("s")).alias("got")).collect()}
    assert got == {k: v and Decimal(v) for k, v in amounts.items()}
