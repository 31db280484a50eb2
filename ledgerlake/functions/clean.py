"""Column expressions that clean and classify raw spending text.

All of these are native Catalyst expressions (no Python UDF), so a staging
projection stays inside one whole-stage-codegen span and never shuffles.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C

MONEY = "decimal(12,2)"


def strip_ws(c: Column) -> Column:
    """Python ``str.strip()``: trim any leading/trailing whitespace."""
    return F.btrim(c, F.lit(C.BLANK_CHARACTERS))


def blank(c: Column) -> Column:
    """NULL or empty string (Python falsiness of a str)."""
    return c.isNull() | (c == F.lit(""))


def _contains_any(lowered: Column, words) -> Column:
    return reduce(lambda a, b: a | b, [lowered.contains(w) for w in words])


def parse_amount(raw: Column) -> Column:
    """Amount text -> decimal(12,2) or NULL.

    Strip; when 'SGD' occurs in any case, upper-case and drop it; drop '$'
    and ','; strip again; exact decimal cast (HALF_UP to cents).
    """
    s = strip_ws(raw)
    up = F.upper(s)
    no_ccy = F.when(up.contains("SGD"), strip_ws(F.replace(up, F.lit("SGD"), F.lit("")))).otherwise(s)
    digits = strip_ws(F.translate(no_ccy, "$,", ""))
    return F.when(blank(raw), F.lit(None).cast(MONEY)).otherwise(digits.try_cast(MONEY))


def currency_code(raw: Column) -> Column:
    """The only currency the source carries."""
    return F.lit("SGD")


def _sections(formats) -> str:
    return "".join(f"[{f}]" for f in formats)


def parse_date(raw: Column) -> Column:
    """Date text -> date or NULL, first matching format of the fixed list.

    The formats become optional sections of two patterns, one for four-digit
    and one for two-digit years (no string can match both groups, so the
    list order is kept). A text without four digits in a row has no four-digit year and skips that
    pattern: a parse that fails costs many times one that does not.
    Two-digit years map 00..68 to 20xx and 69..99 to 19xx.
    """
    s = strip_ws(raw)
    # the longer timestamp forms come first: a section that matches a part of the text ends the search
    four = C.TIMESTAMP_FORMATS + [f for f in C.DATE_FORMATS + C.DATE_FALLBACK_FORMATS if "yyyy" in f]
    two = [f for f in C.DATE_FORMATS + C.DATE_FALLBACK_FORMATS if "yyyy" not in f]
    d4 = F.when(s.rlike("[0-9]{4}"), F.try_to_date(s, _sections(four)))
    d2 = F.try_to_date(s, _sections(two))
    d2 = F.add_months(d2, F.when(F.year(d2) >= C.TWO_DIGIT_YEAR_PIVOT, -1200).otherwise(0))
    return F.when(blank(s), F.lit(None).cast("date")).otherwise(F.coalesce(d4, d2))


def classify_location(loc: Column) -> Column:
    low = F.lower(loc)
    return (F.when(blank(loc), "Unknown")
            .when(_contains_any(low, C.ONLINE_KEYWORDS), "Online")
            .when(_contains_any(low, C.TRANSPORT_KEYWORDS), "Transport")
            .otherwise("Physical"))


def classify_payment(method: Column) -> Column:
    low = F.lower(method)
    return (F.when(blank(method), "Other")
            .when(_contains_any(low, C.CARD_KEYWORDS), "Card")
            .when(_contains_any(low, C.WALLET_KEYWORDS), "Digital Wallet")
            .when(_contains_any(low, C.TRANSIT_KEYWORDS), "Transit Card")
            .when(_contains_any(low, C.BANK_KEYWORDS), "Bank Transfer")
            .otherwise("Other"))


def classify_category(cat: Column) -> Column:
    """Exact match of the lower-cased, unstripped category (' Food' -> Other)."""
    low = F.lower(cat)
    out = F.when(blank(cat), "Other")
    for group, names in C.CATEGORY_GROUPS:
        out = out.when(low.isin(names), group)
    return out.otherwise("Other")


def quality_score(amount_ok: Column, date_ok: Column, description: Column,
                  person: Column, location: Column, category: Column) -> Column:
    d = C.SCORE_DEDUCTIONS

    def minus(cond, pts):
        return F.when(cond, F.lit(pts)).otherwise(F.lit(0))

    total = (F.lit(100)
             - minus(~amount_ok, d["amount"]) - minus(~date_ok, d["date"])
             - minus(blank(description), d["description"]) - minus(blank(person), d["person"])
             - minus(blank(location), d["location"]) - minus(blank(category), d["category"]))
    return F.greatest(F.lit(0), total).cast("int")


def date_parts(d: Column) -> dict:
    """year, month, day, quarter and English weekday name of a date column."""
    return {
        "spending_year": F.year(d),
        "spending_month": F.month(d),
        "spending_day": F.dayofmonth(d),
        "spending_quarter": F.quarter(d),
        "spending_day_of_week": F.when(d.isNotNull(), F.element_at(F.array(*[F.lit(n) for n in C.WEEKDAY_NAMES]), F.weekday(d) + 1)),
    }


def iso_weekday(d: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return (F.weekday(d) + 1).cast("int")
