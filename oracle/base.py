"""DuckDB oracle: the spending chain re-derived in plain SQL.

Shares no code and no value with the Spark jobs; its lists and rules stand here as
literals, taken from the survey and the adapter's description. Prior periods are self joins (as
the reference writes them), rolling averages are range self joins, and every
rounded quotient is computed from integer cents with explicit half-away-from-
zero rounding, because DuckDB turns decimal division into DOUBLE.

Every oracle query is ``WITH <chain> SELECT ...`` over the registered test
tables (orders, customer, nation); unused CTEs are never evaluated.
"""

from __future__ import annotations

ONLINE = ["shopee", "lazada", "zalora", "amazon", "grab", "foodpanda", "udemy", "netflix", "spotify", "online", "taobao",
          ".com", "web"]
TRANSPORT = ["mrt", "bus", "taxi", "grab", "gojek", "station", "interchange"]
PAYMENT = [("Card", ["card", "visa", "mastercard", "amex"]), ("Digital Wallet", ["pay", "wallet", "apple", "google", "grab"]),
           ("Transit Card", ["ez-link", "nets", "flashpay"]), ("Bank Transfer", ["bank", "transfer", "giro"])]
GROUPS = [("Essential", ["groceries", "food", "utilities"]), ("Discretionary", ["shopping", "entertainment", "dining"]),
          ("Transport", ["transport", "transportation"]), ("Healthcare", ["healthcare", "medical", "health"]),
          ("Education", ["education", "learning", "books"])]
# date forms, four-digit and two-digit years, in the order they are tried
LONG_YEAR = ["%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M", "%Y-%m-%dT%H:%M", "%d-%b-%Y", "%d/%m/%Y", "%Y-%m-%d",
             "%d-%m-%Y", "%Y/%m/%d", "%d %b %Y", "%d %B %Y", "%b %d, %Y", "%B %d, %Y", "%Y%m%d", "%d-%B-%Y", "%b %d %Y",
             "%B %d %Y", "%d.%m.%Y"]
SHORT_YEAR = ["%d/%m/%y", "%d-%m-%y", "%d-%b-%y", "%d %b %y", "%d %B %y", "%d.%m.%y", "%d-%B-%y"]
# the adapter's lists
CATEGORIES = ["Food", "Transport", "Groceries", "Entertainment", "Shopping", "Utilities", "Healthcare", "Education", "Fitness",
              "Dining"]
LOCATIONS = ["Shopee", "Grab", "Lazada", "MRT Station", "Bus Interchange", "Hawker Centre", "KFC", "Cinema", "Clinic", "Gym",
             "NTUC FairPrice", "Netflix"]
METHODS = ["Cash", "Credit Card", "Debit Card", "PayNow", "GrabPay", "Mobile Payment", "Bank Transfer", "Apple Pay", "Google Pay",
           "EZ-Link"]
STYLES = ["%d/%m/%Y", "%d-%b-%Y", "%Y-%m-%d", "%d-%m-%Y", "%Y-%m-%d 10:30:00", "%Y-%m-%dT10:30:00", "%d.%m.%Y", "%d %b %y",
          "%d-%B-%Y", "%b %d %Y", "%d/%m/%y"]
BLANKS = r"[\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def qlist(vals) -> str:
    return "[" + ", ".join(q(v) for v in vals) + "]"


def qdiv(num: str, den: str, scale: int = 2) -> str:
    """round_half_away(num / den, scale) as DECIMAL(18,scale), exact for
    integer operands; NULL when den is 0 or NULL."""
    n = f"CAST(({num}) AS HUGEINT) * {10 ** scale}"
    d = f"CAST(({den}) AS HUGEINT)"
    r = f"(sign({n}) * sign({d}) * ((2 * abs({n}) + abs({d})) // (2 * abs({d}))))"
    unit = {0: "1", 1: "0.1", 2: "0.01", 3: "0.001"}[scale]
    return (f"(CASE WHEN {d} IS NULL OR {d} = 0 OR ({num}) IS NULL THEN NULL "
            f"ELSE CAST(CAST({r} AS DECIMAL(38,0)) * {unit} AS DECIMAL(18,{scale})) END)")


def cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS HUGEINT)"


def money(x: str) -> str:
    return f"CAST(({x}) AS DECIMAL(18,2))"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{BLANKS}+|{BLANKS}+$', '', 'g')"


def contains_any(x: str, words) -> str:
    return "(" + " OR ".join(f"contains(lower({x}), {q(w)})" for w in words) + ")"


AS_OF = "TIMESTAMP '2025-10-22 00:00:00'"

_k = "o.o_orderkey"
_cents = "(152 + CAST(round(o.o_totalprice * 100) AS BIGINT) % 49809)"
_num = f"(CAST({_cents} // 100 AS VARCHAR) || '.' || lpad(CAST({_cents} % 100 AS VARCHAR), 2, '0'))"
_d = f"(CASE WHEN {_k} % 29 = 0 THEN DATE '2001-08-01' + CAST({_k} % 28 AS INTEGER) ELSE CAST(o.o_orderdate AS DATE) END)"
_pad = "chr(160)"
_styled = " ".join(f"WHEN {_k} % {len(STYLES)} = {i} THEN strftime({_d}, {q(f)})" for i, f in enumerate(STYLES))

RAW = f"""raw_rows AS (
  SELECT {_k} AS k, copy, CASE WHEN {_k} % 3 = 0 THEN 0 ELSE 1 END AS batch,
    CASE WHEN {_k} % 101 = 0 THEN NULL ELSE n.n_name END AS person_name,
    (CASE WHEN {_k} % 61 = 0 THEN {_pad} ELSE '' END) || CASE WHEN {_k} % 89 = 0 THEN '31/02/2024' {_styled} END AS spending_date,
    CASE WHEN {_k} % 103 = 0 THEN '  '
         ELSE list_extract({qlist(CATEGORIES)}, CAST({_k} % {len(CATEGORIES)} + 1 AS INTEGER)) END AS category,
    (CASE WHEN {_k} % 97 = 0 THEN 'n/a'
         WHEN ({_k} // 4) % 4 = 0 THEN '$' || {_num}
         WHEN ({_k} // 4) % 4 = 1 THEN {_num}
         WHEN ({_k} // 4) % 4 = 2 THEN {_num} || ' SGD'
         ELSE 'SGD ' || {_num} END) || (CASE WHEN {_k} % 59 = 0 THEN {_pad} ELSE '' END) AS amount,
    CASE WHEN {_k} % 83 = 0 THEN NULL
         ELSE list_extract({qlist(LOCATIONS)}, CAST(o.o_custkey % {len(LOCATIONS)} + 1 AS INTEGER)) END AS location,
    CASE WHEN {_k} % 20 = 0 THEN NULL ELSE o.o_orderpriority END AS description,
    list_extract({qlist(METHODS)}, CAST(o.o_custkey % {len(METHODS)} + 1 AS INTEGER)) AS payment_method
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey,
    unnest(CASE WHEN {_k} % 107 = 0 THEN [0, 1] ELSE [0] END) AS u(copy)
),
raw AS (SELECT ROW_NUMBER() OVER (ORDER BY batch, k, copy) AS src_id, * EXCLUDE (k, copy) FROM raw_rows)"""

SRC = """src AS (
  SELECT * EXCLUDE (batch), 'daily_spending.parquet' AS source_file,
    CASE batch WHEN 0 THEN 'LOAD_20251018_000000' ELSE 'LOAD_20251020_000000' END AS load_batch_id,
    CASE batch WHEN 0 THEN TIMESTAMP '2025-10-18 12:00:00' ELSE TIMESTAMP '2025-10-20 12:00:00' END AS loaded_at
  FROM raw
)"""

_a1 = strip("amount")
_a2 = f"(CASE WHEN contains(upper({_a1}), 'SGD') THEN {strip(f'replace(upper({_a1}), ' + q('SGD') + ', ' + q('') + ')')} ELSE {_a1} END)"
_a3 = strip(f"regexp_replace({_a2}, '[$,]', '', 'g')")
_d1 = strip("spending_date")
# this engine reads %Y from two digits too, so the long forms need four digits in a row
_d4 = f"(CASE WHEN regexp_matches({_d1}, '[0-9][0-9][0-9][0-9]') THEN try_strptime({_d1}, {qlist(LONG_YEAR)}) END)"
_d2 = f"try_strptime({_d1}, {qlist(SHORT_YEAR)})"


def _blank(x):
    return f"({x} IS NULL OR {x} = '')"


STG0 = f"""stg0 AS (
  SELECT src.*,
    CASE WHEN {_blank('amount')} THEN NULL ELSE TRY_CAST({_a3} AS DECIMAL(12,2)) END AS amount_p,
    CASE WHEN {_blank(_d1)} THEN NULL
         ELSE CAST(COALESCE({_d4},
              CASE WHEN year({_d2}) >= 2069 THEN {_d2} - INTERVAL 100 YEAR ELSE {_d2} END) AS DATE)
    END AS date_p
  FROM src
)"""


def _loc_type(x):
    return (f"CASE WHEN {_blank(x)} THEN 'Unknown' WHEN {contains_any(x, ONLINE)} THEN 'Online' "
            f"WHEN {contains_any(x, TRANSPORT)} THEN 'Transport' ELSE 'Physical' END")


def _pay_type(x):
    parts = " ".join(f"WHEN {contains_any(x, words)} THEN {q(label)}" for label, words in PAYMENT)
    return f"CASE WHEN {_blank(x)} THEN 'Other' {parts} ELSE 'Other' END"


def _cat_group(x):
    parts = " ".join(f"WHEN lower({x}) IN ({', '.join(q(n) for n in names)}) THEN {q(g)}"
                     for g, names in GROUPS)
    return f"CASE WHEN {_blank(x)} THEN 'Other' {parts} ELSE 'Other' END"


_score = ("GREATEST(0, 100 - CASE WHEN amount_p IS NULL THEN 30 ELSE 0 END"
          " - CASE WHEN date_p IS NULL THEN 30 ELSE 0 END"
          f" - CASE WHEN {_blank('description')} THEN 10 ELSE 0 END"
          f" - CASE WHEN {_blank(strip('person_name'))} THEN 20 ELSE 0 END"
          f" - CASE WHEN {_blank(strip('location'))} THEN 5 ELSE 0 END"
          f" - CASE WHEN {_blank(strip('category'))} THEN 5 ELSE 0 END)")

STG = f"""stg AS (
  SELECT src_id,
    {strip('person_name')} AS person_name,
    spending_date AS spending_date_raw,
    date_p AS spending_date,
    amount AS amount_raw,
    amount_p AS amount_cleaned,
    'SGD' AS currency_code,
    {strip('location')} AS location_name,
    {_loc_type('location')} AS location_type,
    {strip('category')} AS category_name,
    {_cat_group('category')} AS category_group,
    {strip('payment_method')} AS payment_method_name,
    {_pay_type('payment_method')} AS payment_type,
    description, source_file, load_batch_id,
    CAST(year(date_p) AS INTEGER) AS spending_year,
    CAST(month(date_p) AS INTEGER) AS spending_month,
    CAST(day(date_p) AS INTEGER) AS spending_day,
    CAST(quarter(date_p) AS INTEGER) AS spending_quarter,
    dayname(date_p) AS spending_day_of_week,
    amount_p IS NOT NULL AS is_amount_parsed_successfully,
    date_p IS NOT NULL AS is_date_parsed_successfully,
    'STG_20251020_000000' AS transform_batch_id,
    CAST({_score} AS INTEGER) AS data_quality_score
  FROM stg0
)"""

REJ = """stg_r AS (
  SELECT *, CASE WHEN NOT is_amount_parsed_successfully THEN 'invalid_amount'
                 WHEN NOT is_date_parsed_successfully THEN 'invalid_date'
                 WHEN person_name IS NULL THEN 'missing_person'
                 WHEN location_name IS NULL THEN 'missing_location'
                 WHEN category_name IS NULL THEN 'missing_category'
                 WHEN payment_method_name IS NULL THEN 'missing_payment_method' END AS reject_reason
  FROM stg
)"""

_ok = "is_amount_parsed_successfully AND is_date_parsed_successfully"


def _dim(name, attr, key, alias):
    if attr is None:
        return (f"{alias} AS (SELECT MIN(src_id) AS {key}, {name} FROM stg WHERE {_ok} AND {name} IS NOT NULL "
                f"GROUP BY {name})")
    return (f"{alias}_pairs AS (SELECT {name}, {attr}, MIN(src_id) AS first_src_id FROM stg "
            f"WHERE {_ok} AND {name} IS NOT NULL GROUP BY {name}, {attr}),\n"
            f"{alias} AS (SELECT MIN(first_src_id) AS {key}, {name}, arg_max({attr}, first_src_id) AS {attr} "
            f"FROM {alias}_pairs GROUP BY {name})")


DIMS = ",\n".join([
    _dim("person_name", None, "person_id", "dim_person"),
    _dim("location_name", "location_type", "location_id", "dim_location"),
    _dim("category_name", "category_group", "category_id", "dim_category"),
    _dim("payment_method_name", "payment_type", "payment_method_id", "dim_payment_method"),
])

FACT = f"""fact AS (
  SELECT s.src_id AS spending_id, p.person_id, l.location_id, c.category_id, m.payment_method_id,
    s.spending_date, s.spending_year, s.spending_month, s.spending_day, s.spending_quarter,
    s.spending_day_of_week, s.amount_raw, s.amount_cleaned, s.currency_code, s.description,
    s.is_amount_parsed_successfully, s.is_date_parsed_successfully, s.data_quality_score,
    s.src_id, s.transform_batch_id, {AS_OF} AS transformed_at
  FROM stg_r s
  JOIN dim_person p ON s.person_name = p.person_name
  JOIN dim_location l ON s.location_name = l.location_name
  JOIN dim_category c ON s.category_name = c.category_name
  JOIN dim_payment_method m ON s.payment_method_name = m.payment_method_name
  WHERE s.reject_reason IS NULL
)"""

COMPLETE = """complete AS (
  SELECT f.spending_id, p.person_name, f.spending_date, f.spending_year, f.spending_month,
    f.spending_quarter, f.spending_day_of_week, c.category_name, c.category_group,
    f.amount_cleaned, f.currency_code, l.location_name, l.location_type, f.description,
    m.payment_method_name, m.payment_type, f.data_quality_score, f.src_id, f.transformed_at,
    f.person_id, f.category_id, f.location_id, f.payment_method_id
  FROM fact f
  JOIN dim_person p ON f.person_id = p.person_id
  JOIN dim_location l ON f.location_id = l.location_id
  JOIN dim_category c ON f.category_id = c.category_id
  JOIN dim_payment_method m ON f.payment_method_id = m.payment_method_id
)"""


def _snap(version, date, where):
    return f"""SELECT CAST({version} AS BIGINT) * 1000000000000 + spending_id AS snapshot_id,
      {version} AS snapshot_version, DATE '{date}' AS snapshot_date,
      'SNAP_{date.replace('-', '')}_v{version}' AS snapshot_batch_id,
      src_id, spending_id AS stg_spending_id, person_id, category_id, location_id, payment_method_id,
      person_name, category_name, category_group, location_name, location_type, payment_method_name,
      payment_type, spending_date, spending_year, spending_month, spending_quarter,
      CAST(isodow(spending_date) AS INTEGER) AS spending_day_of_week, amount_cleaned, currency_code,
      description, data_quality_score, {AS_OF} AS created_at
    FROM complete {where}"""


CURATED = f"""cur0 AS (
  {_snap(1, '2025-08-20', "WHERE spending_date < DATE '2000-01-01'")}
  UNION ALL
  {_snap(2, '2025-10-21', '')}
),
curated AS (
  SELECT snapshot_id, snapshot_version, snapshot_date, snapshot_batch_id,
    CASE WHEN snapshot_version = (SELECT MAX(snapshot_version) FROM cur0) THEN 1 ELSE 0 END AS is_latest,
    src_id, stg_spending_id, person_id, category_id, location_id, payment_method_id, person_name,
    category_name, category_group, location_name, location_type, payment_method_name, payment_type,
    spending_date, spending_year, spending_month, spending_quarter, spending_day_of_week,
    amount_cleaned, currency_code, description, data_quality_score, created_at
  FROM cur0
),
latest AS (SELECT * FROM curated WHERE is_latest = 1)"""

CHAIN = [RAW, SRC, STG0, STG, REJ, DIMS, FACT, COMPLETE, CURATED]


def with_chain(*extra: str) -> str:
    return "WITH " + ",\n".join(CHAIN + list(extra)) + "\n"
