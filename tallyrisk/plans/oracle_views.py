"""DuckDB twins of ``bindings.py``, written independently as SQL CTEs.

``with_views(sql, *names)`` prefixes a query with the CTEs it needs, so each
oracle string is self-contained and runs on the driver's pre-registered views.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {}

VIEWS["v_orig_tape"] = """
SELECT o.o_orderkey AS loan_id,
  CASE WHEN o.o_orderkey % 97 = 0 THEN ' ' WHEN o.o_orderkey % 89 = 0 THEN 'XX'
       ELSE CAST(280 + (o.o_orderkey * 7919) % 600 AS VARCHAR) END AS credit_score,
  CASE WHEN o.o_orderkey % 2 = 0 THEN strftime(o.o_orderdate, '%Y%m')
       ELSE strftime(o.o_orderdate, '%m%Y') END AS first_payment_date,
  CASE o.o_orderkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE ' ' END AS first_time_homebuyer_flag,
  strftime(CAST(o.o_orderdate AS DATE) + INTERVAL 360 MONTH, '%Y%m') AS maturity_date,
  CASE WHEN o.o_orderkey % 4 = 0 THEN CAST(o.o_orderkey % 35 AS VARCHAR) ELSE '' END AS mi_pct,
  CAST(1 + o.o_orderkey % 4 AS VARCHAR) AS num_units,
  CASE o.o_orderstatus WHEN 'F' THEN 'P' WHEN 'O' THEN 'I' ELSE 'S' END AS occupancy_status,
  CAST(40 + (o.o_orderkey * 31) % 80 + o.o_orderkey % 5 AS VARCHAR) AS orig_cltv,
  CASE WHEN o.o_orderkey % 59 = 0 THEN '' ELSE CAST(o.o_orderkey % 71 AS VARCHAR) END AS orig_dti,
  CAST(CAST(floor(o.o_totalprice * 2) AS BIGINT) AS VARCHAR) AS orig_upb,
  CAST(40 + (o.o_orderkey * 31) % 80 AS VARCHAR) AS orig_ltv,
  CAST(2 + (o.o_orderkey % 80) // 10 AS VARCHAR) || '.' || CAST(o.o_orderkey % 10 AS VARCHAR) AS orig_interest_rate,
  CASE substr(o.o_orderpriority, 1, 1) WHEN '1' THEN 'R' WHEN '2' THEN 'B' WHEN '3' THEN 'C'
       WHEN '4' THEN 'T' ELSE '9' END AS channel,
  CASE WHEN o.o_orderkey % 11 = 0 THEN 'Y' ELSE 'N' END AS ppm_flag,
  CASE WHEN o.o_orderkey % 53 = 0 THEN ' arm' WHEN o.o_orderkey % 7 = 0 THEN 'ARM' ELSE 'FRM' END AS amortization_type,
  'S' || CAST(c.c_nationkey AS VARCHAR) AS property_state,
  CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'SF' WHEN 'BUILDING' THEN 'PU' WHEN 'FURNITURE' THEN 'CO'
       WHEN 'HOUSEHOLD' THEN 'MH' WHEN 'MACHINERY' THEN 'CP' ELSE '' END AS property_type,
  'L' || lpad(CAST(o.o_orderkey AS VARCHAR), 10, '0') AS loan_sequence_number,
  CASE o.o_orderkey % 5 WHEN 0 THEN 'P' WHEN 1 THEN 'C' WHEN 2 THEN 'N' WHEN 3 THEN 'R' ELSE '9' END AS loan_purpose,
  CASE WHEN o.o_orderkey % 4 = 0 THEN '180' ELSE '360' END AS orig_loan_term,
  CAST(1 + o.o_orderkey % 2 AS VARCHAR) AS num_borrowers,
  CASE WHEN o.o_orderkey % 13 = 0 THEN 'Y' ELSE ' ' END AS super_conforming_flag,
  'N' AS io_indicator,
  CAST(year(o.o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o.o_orderdate) AS VARCHAR) AS quarter
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
"""

# Text cleaning shared by the typed views: blank → NULL, number → double.
_NUM = "TRY_CAST(trim(NULLIF(trim({c}), '')) AS DOUBLE)"
_INT = ("CASE WHEN {d} = floor({d}) THEN TRY_CAST({d} AS BIGINT) END")


def num(c: str) -> str:
    return _NUM.format(c=c)


def integer(c: str) -> str:
    return _INT.format(d=num(c))


def blank(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, '^\\s*$') THEN NULL ELSE {c} END"


def six_digit_period(s: str) -> str:
    """YYYYMM when the year is in 1900..2100 and month valid, else MMYYYY."""
    return f"""(CASE WHEN regexp_matches({s}, '^[0-9]{{6}}$') THEN
      CASE WHEN CAST(substr({s},1,4) AS INT) BETWEEN 1900 AND 2100 AND CAST(substr({s},5,2) AS INT) BETWEEN 1 AND 12
             THEN make_date(CAST(substr({s},1,4) AS INT), CAST(substr({s},5,2) AS INT), 1)
           WHEN CAST(substr({s},3,4) AS INT) BETWEEN 1900 AND 2100 AND CAST(substr({s},1,2) AS INT) BETWEEN 1 AND 12
             THEN make_date(CAST(substr({s},3,4) AS INT), CAST(substr({s},1,2) AS INT), 1) END END)"""


def parse_period(c: str) -> str:
    s = f"trim({c})"
    return f"""(CASE
      WHEN regexp_matches({s}, '^[0-9]{{6}}$') THEN {six_digit_period(s)}
      WHEN regexp_matches({s}, '^[0-9]{{8}}$') THEN date_trunc('month', try_strptime({s}, '%Y%m%d'))::DATE
      WHEN regexp_matches({s}, '^[0-9]{{4}}-[0-9]{{2}}$') AND CAST(substr({s},1,4) AS INT) BETWEEN 1900 AND 2100
           AND CAST(substr({s},6,2) AS INT) BETWEEN 1 AND 12
        THEN make_date(CAST(substr({s},1,4) AS INT), CAST(substr({s},6,2) AS INT), 1)
      WHEN regexp_matches({s}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}([ T].*)?$')
        THEN date_trunc('month', try_strptime(substr({s},1,10), '%Y-%m-%d'))::DATE
      END)"""


_ORIG_STR = ["first_payment_date", "first_time_homebuyer_flag", "maturity_date", "occupancy_status",
             "channel", "ppm_flag", "amortization_type", "property_state", "property_type",
             "loan_sequence_number", "loan_purpose", "super_conforming_flag", "io_indicator"]
_ORIG_DBL = ["credit_score", "mi_pct", "orig_cltv", "orig_dti", "orig_upb", "orig_ltv",
             "orig_interest_rate"]
_ORIG_INT = ["num_units", "orig_loan_term", "num_borrowers"]

VIEWS["v_orig"] = (
    "SELECT loan_id, "
    + ", ".join(f"{num(c)} AS {c}" for c in _ORIG_DBL) + ", "
    + ", ".join(f"{integer(c)} AS {c}" for c in _ORIG_INT) + ", "
    + ", ".join(f"{blank(c)} AS {c}" for c in _ORIG_STR) + ", quarter, "
    + f"{parse_period('first_payment_date')} AS first_payment_month FROM v_orig_tape"
)

VIEWS["v_perf_tape"] = """
SELECT a.l_orderkey AS loan_id,
  'L' || lpad(CAST(a.l_orderkey AS VARCHAR), 10, '0') AS loan_sequence_number,
  strftime(a.m, '%m%Y') AS monthly_reporting_period,
  CAST(CAST(floor(a.min_price) AS BIGINT) AS VARCHAR) AS current_actual_upb,
  CASE WHEN a.l_orderkey % 41 = 0 THEN 'XX' ELSE CAST(a.status AS VARCHAR) END AS current_delinquency_status,
  CAST((year(a.m) - year(o.o_orderdate)) * 12 + month(a.m) - month(o.o_orderdate) AS VARCHAR) AS loan_age,
  CAST(360 - ((year(a.m) - year(o.o_orderdate)) * 12 + month(a.m) - month(o.o_orderdate)) AS VARCHAR)
    AS remaining_months_to_legal_maturity,
  CASE WHEN a.max_flag = 'R' THEN 'Y' ELSE 'N' END AS modification_flag,
  CASE (a.l_orderkey + month(a.m)) % 23 WHEN 0 THEN '02' WHEN 1 THEN '03' WHEN 2 THEN '06'
       WHEN 3 THEN '09' WHEN 4 THEN '15' WHEN 5 THEN '01' END AS zero_balance_code,
  CAST(2 + (a.l_orderkey % 80) // 10 AS VARCHAR) || '.' || CAST((a.l_orderkey + month(a.m)) % 10 AS VARCHAR)
    AS current_interest_rate
FROM (SELECT l_orderkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS m,
             min(l_extendedprice) AS min_price, max(CAST(l_quantity AS BIGINT) % 5) AS status,
             max(l_returnflag) AS max_flag
      FROM lineitem GROUP BY 1, 2) a
LEFT JOIN orders o ON a.l_orderkey = o.o_orderkey
"""

VIEWS["v_perf"] = (
    "SELECT loan_id, loan_sequence_number, " + blank("monthly_reporting_period")
    + " AS monthly_reporting_period, "
    + f"{num('current_actual_upb')} AS current_actual_upb, "
    + f"{blank('current_delinquency_status')} AS current_delinquency_status, "
    + f"{integer('loan_age')} AS loan_age, "
    + f"{integer('remaining_months_to_legal_maturity')} AS remaining_months_to_legal_maturity, "
    + f"{blank('modification_flag')} AS modification_flag, zero_balance_code, "
    + f"{num('current_interest_rate')} AS current_interest_rate, "
    + f"{parse_period('monthly_reporting_period')} AS reporting_month FROM v_perf_tape"
)

VIEWS["v_panel"] = (
    "SELECT loan_id, reporting_month, CAST(" + integer("current_delinquency_status")
    + " * 30 AS INTEGER) AS dpd FROM v_perf"
)

VIEWS["v_score"] = """
SELECT o_orderkey AS id, ((o_orderkey * 7919) % 1000) / 1000.0 AS pd,
  CASE WHEN (o_orderkey * 104729) % 1000 < (o_orderkey * 7919) % 1000 THEN 1 ELSE 0 END AS label,
  strftime(o_orderdate, '%Y-%m') AS period
FROM orders
"""

VIEWS["v_ref"] = """
SELECT l_orderkey, l_quantity, l_extendedprice, l_discount, l_extendedprice AS price_shifted
FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-07-01'
"""

VIEWS["v_cur"] = """
SELECT l_orderkey, l_quantity, l_extendedprice, l_discount, l_extendedprice * 1.3 AS price_shifted
FROM lineitem WHERE NOT (l_shipdate < TIMESTAMP '1998-07-01')
"""

VIEWS["v_series_daily"] = """
SELECT CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'urgent' WHEN '2' THEN 'high'
            WHEN '3' THEN 'medium' WHEN '4' THEN 'not_specified' ELSE 'low' END AS series_id,
       CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS value
FROM orders GROUP BY 1, 2
"""

VIEWS["v_series_q"] = """
SELECT * FROM v_series_daily WHERE day(date) = 1 AND month(date) IN (1, 4, 7, 10)
"""

# Dependencies between views (a view must follow the views it reads).
_DEPS = {
    "v_orig": ["v_orig_tape"],
    "v_perf": ["v_perf_tape"],
    "v_panel": ["v_perf"],
    "v_series_q": ["v_series_daily"],
}


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        for d in _DEPS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(sql: str, *names: str, extra: dict[str, str] | None = None,
               dates: list[str] | None = None, stamps: list[str] | None = None) -> str:
    """Prefix ``sql`` with the CTEs of ``names`` (and their dependencies), then ``extra``.

    ``dates`` / ``stamps`` name output columns rendered as ISO text, matching the
    registered Spark queries, which present DATE and TIMESTAMP columns as text.
    """
    parts = [f"{n} AS ({VIEWS[n]})" for n in _closure(names)]
    parts += [f"{k} AS ({v})" for k, v in (extra or {}).items()]
    reps = [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in (dates or [])]
    reps += [f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in (stamps or [])]
    body = f"SELECT * REPLACE ({', '.join(reps)}) FROM ({sql}) _q" if reps else sql
    if not parts:
        return body
    lead = body.lstrip()
    if lead[:4].upper() == "WITH" and lead[4:5].isspace():
        # The query has CTEs of its own: continue one WITH list.
        return "WITH " + ",\n".join(parts) + ",\n" + lead[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body
