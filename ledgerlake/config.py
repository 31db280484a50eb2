"""Run parameters, thresholds and the fixed value lists the jobs depend on.

Everything a job compares against lives here so that a deployment can tune
thresholds in one place; the lists marked FIXED VALUES must stay as they are
for results to agree with the reference behaviour.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference's for identical results)
# ---------------------------------------------------------------------------

# Location keywords, checked in this order; first list that matches wins.
ONLINE_KEYWORDS = ["shopee", "lazada", "zalora", "amazon", "grab", "foodpanda",
                   "udemy", "netflix", "spotify", "online", "taobao", ".com", "web"]
TRANSPORT_KEYWORDS = ["mrt", "bus", "taxi", "grab", "gojek", "station", "interchange"]
# (physical-place keywords lead to the same label as the default, 'Physical')

# Payment keywords, checked in this order.
CARD_KEYWORDS = ["card", "visa", "mastercard", "amex"]
WALLET_KEYWORDS = ["pay", "wallet", "apple", "google", "grab"]
TRANSIT_KEYWORDS = ["ez-link", "nets", "flashpay"]
BANK_KEYWORDS = ["bank", "transfer", "giro"]

# Category groups, exact match on the lower-cased (unstripped) category.
CATEGORY_GROUPS = [
    ("Essential", ["groceries", "food", "utilities"]),
    ("Discretionary", ["shopping", "entertainment", "dining"]),
    ("Transport", ["transport", "transportation"]),
    ("Healthcare", ["healthcare", "medical", "health"]),
    ("Education", ["education", "learning", "books"]),
]

# Date formats tried in order (Spark pattern letters), then the fallback list.
DATE_FORMATS = ["d-MMM-yyyy", "d/M/yyyy", "yyyy-M-d", "d/M/yy",
                "d-M-yyyy", "d-M-yy", "yyyy/M/d", "d-MMM-yy"]
# What the free-form fallback parser accepts beyond the list (day first where unclear).
DATE_FALLBACK_FORMATS = ["d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy", "yyyyMMdd", "d-MMMM-yyyy",
                         "MMM d yyyy", "MMMM d yyyy", "d.M.yyyy", "d MMM yy", "d MMMM yy", "d.M.yy", "d-MMMM-yy"]
TIMESTAMP_FORMATS = ["yyyy-M-d HH:mm:ss", "yyyy-M-d'T'HH:mm:ss", "yyyy-M-d HH:mm", "yyyy-M-d'T'HH:mm"]
# White space as Python's str.strip() sees it.
BLANK_CHARACTERS = "".join(map(chr, [*range(0x09, 0x0e), *range(0x1c, 0x21), 0x85, 0xa0, 0x1680, *range(0x2000, 0x200b),
                                     0x2028, 0x2029, 0x202f, 0x205f, 0x3000]))
# Two-digit years: Python's pivot keeps 69..99 in the 1900s.
TWO_DIGIT_YEAR_PIVOT = 2069

# Amount pattern of the source format check.
AMOUNT_FORMAT_REGEX = r"^[0-9.,$ SGD]+$"

# Data quality deductions.
SCORE_DEDUCTIONS = {"amount": 30, "date": 30, "description": 10,
                    "person": 20, "location": 5, "category": 5}

WEEKDAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


@dataclass(frozen=True)
class Config:
    """Parameters of one run. ``as_of`` replaces every clock read."""

    as_of: _dt.datetime
    report_as_of: _dt.date  # "last 12 months" style reports use their own clock
    load_batch_id: str  # the batch that samples and profiles look at
    transform_batch_id: str
    validation_run_id: str
    snapshot_dates: tuple  # one published version per date ...
    snapshot_cutoffs: tuple  # ... of the rows before this date, or of all rows
    # parameters of the report queries
    version: int
    version_pair: tuple
    person: str
    category: str
    snapshot_date: _dt.date
    year: int
    month: int
    freshness_hours: int = 48
    keep_days: int = 30
