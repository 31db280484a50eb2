"""Calendar-period helpers: month index, prior-period lookups, change metrics.

Prior periods are RANGE frames over ``month_idx = year*12 + month`` inside a
window partitioned by the mart key. One shuffle of the (already aggregated)
mart rows then serves MoM (-1), YoY (-12) and rolling averages, where the
reference used one self join each.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
RANGE = 1000  # cents


def dec(v) -> Column:
    """Exact decimal literal (never a double)."""
    return F.lit(Decimal(str(v)))


def month_idx(year: Column, month: Column) -> Column:
    return year * 12 + month


def prior(value: str, keys: list, offset: int, order: str = "month_idx") -> Column:
    """Value of the same key ``offset`` months earlier, NULL when that month is absent."""
    w = Window.partitionBy(*keys).orderBy(order).rangeBetween(-offset, -offset)
    return F.first(value).over(w)


def round2(c: Column, scale: int = 2) -> Column:
    """HALF_UP rounding of an exact decimal, returned as decimal(18, scale)."""
    return F.round(c, scale).cast(f"decimal(18,{scale})")


def pct(part: Column, whole: Column, scale: int = 2) -> Column:
    """round(part / nullif(whole, 0) * 100, scale) in exact decimal arithmetic
    (operands cast to decimal(18,2) so that Spark keeps >= 16 fraction digits)."""
    return round2(part.cast(MONEY) * dec(100) / F.nullif(whole.cast(MONEY), dec(0)), scale)


def ratio(num: Column, den: Column, scale: int = 2) -> Column:
    return round2(num.cast(MONEY) / F.nullif(den.cast(MONEY), dec(0)), scale)


def pct_change(cur: Column, prev: Column) -> Column:
    """Percent change when the previous value is present and positive, else NULL."""
    return F.when(prev.isNotNull() & (prev > 0), round2((cur - prev) * dec(100) / prev))


def trend_direction(p: Column) -> Column:
    """NULL -> NO_DATA; > 5 INCREASING; < -5 DECREASING; else STABLE."""
    return (F.when(p.isNull(), "NO_DATA")
            .when(p > 5, "INCREASING")
            .when(p < -5, "DECREASING")
            .otherwise("STABLE"))


def trend_from_prev(cur: Column, prev: Column) -> Column:
    """Direction from the unrounded change; prev = 0 gives STABLE (NULLIF)."""
    raw = (cur - prev) * dec(100) / F.nullif(prev, dec(0))
    return (F.when(prev.isNull(), "NO_DATA")
            .when(raw > 5, "INCREASING")
            .when(raw < -5, "DECREASING")
            .otherwise("STABLE"))


def median_by(df: DataFrame, keys: list, value: str, name: str) -> DataFrame:
    """PERCENTILE_CONT(0.5) of a cents-scale decimal per ``keys``, rounded HALF_UP to
    cents, as (keys, name); rows without a value are left out.

    Counts per distinct amount come first (a plain aggregation), then counts per range
    of RANGE cents; the windows run over the ranges of a key and over the amounts of the
    one or two ranges that hold the middle, never over the rows of a hot key.
    """
    cents = F.col(value) * 100
    amounts = df.filter(F.col(value).isNotNull()).select(*keys, cents.cast("bigint").alias("_c"))
    amounts = amounts.groupBy(*keys, "_c").agg(F.count(F.lit(1)).alias("_n")).withColumn("_r", F.expr(f"_c div {RANGE}"))
    ranges = amounts.groupBy(*keys, "_r").agg(F.sum("_n").alias("_rn"))
    every, so_far = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("_r")
    ranges = ranges.withColumns({"_all": F.sum("_rn").over(every), "_upto": F.sum("_rn").over(so_far)})
    low, high = F.expr("(_all + 1) div 2"), F.expr("(_all + 2) div 2")  # the ranks of the two middle rows
    before = F.col("_upto") - F.col("_rn")
    middle = ranges.filter((low > before) & (low <= F.col("_upto")) | (high > before) & (high <= F.col("_upto")))
    on = F.lit(True)
    for k in [*keys, "_r"]:
        on = on & F.col(f"a.{k}").eqNullSafe(F.col(f"m.{k}"))
    inside = (amounts.alias("a").join(middle.alias("m"), on)
              .select("a.*", "m._all", (F.col("m._upto") - F.col("m._rn")).alias("_before")))
    upto = F.col("_before") + F.sum("_n").over(Window.partitionBy(*keys, "_r").orderBy("_c"))
    inside = inside.withColumn("_last", upto)
    is_row = lambda rank: (rank > F.col("_last") - F.col("_n")) & (rank <= F.col("_last"))
    twice = F.max(F.when(is_row(low), F.col("_c"))) + F.max(F.when(is_row(high), F.col("_c")))
    return inside.groupBy(*keys).agg(round2(twice.cast("decimal(20,0)") / 200).alias(name))


def days_in_month(d: Column) -> Column:
    return F.dayofmonth(F.last_day(d))
