"""The same queries as SQL text for an independent engine (DuckDB dialect)."""

from __future__ import annotations

from stresslake.specs import FALLBACK_RATES, SCENARIOS, SPECS, TRANSFORMABLE

GEO = """geo AS (
  SELECT n_nationkey, r_name AS region_code,
         CASE r_name WHEN 'AMERICA' THEN 'USD' WHEN 'EUROPE' THEN 'EUR' WHEN 'ASIA' THEN 'JPY'
                     WHEN 'MIDDLE EAST' THEN 'AED' ELSE 'ZAR' END AS currency_code
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

DOMAIN = {
    "transactions": """transactions AS (
  SELECT o_orderkey AS transaction_id, o_custkey AS customer_id,
         CAST(o_orderdate AS DATE) AS transaction_date, o_orderpriority AS transaction_type,
         CAST(o_totalprice AS DECIMAL(18,2)) AS transaction_amount, region_code, currency_code
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN geo ON c_nationkey = n_nationkey)""",
    "cash": """cash AS (
  SELECT cash_position_id, region_code, currency_code, DATE '2024-01-31' AS business_date,
         closing_balance,
         CAST(closing_balance * CAST(0.90 AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS available_liquidity
  FROM (SELECT c_custkey AS cash_position_id, c_nationkey,
               CAST(c_acctbal AS DECIMAL(18,2)) AS closing_balance FROM customer)
  JOIN geo ON c_nationkey = n_nationkey)""",
    "loans": """loans AS (
  SELECT l_orderkey AS loan_id, l_linenumber AS tranche, l_suppkey AS branch_id,
         CAST(l_shipdate AS DATE) AS business_date,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS loan_amount,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
              AS DECIMAL(18,4)) AS outstanding_balance, l_tax * 100 AS interest_rate,
         region_code, currency_code
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN geo ON s_nationkey = n_nationkey)""",
    "intraday": """intraday AS (
  SELECT intraday_id, as_of_timestamp_date, region_code, currency_code, inflow_amount,
         outflow_amount, CAST(inflow_amount - outflow_amount AS DECIMAL(18,2)) AS net_position
  FROM (SELECT event_id AS intraday_id, user_id, CAST(ts AS DATE) AS as_of_timestamp_date,
          CASE WHEN event_type IN ('purchase','signup') THEN CAST(value AS DECIMAL(18,2))
               ELSE CAST(0 AS DECIMAL(18,2)) END AS inflow_amount,
          CASE WHEN event_type IN ('error','click') THEN CAST(value AS DECIMAL(18,2))
               ELSE CAST(0 AS DECIMAL(18,2)) END AS outflow_amount
        FROM events)
  JOIN customer ON user_id = c_custkey JOIN geo ON c_nationkey = n_nationkey)""",
}

_rate_rows = ", ".join(f"('{code}', {rate})" for code, rate in FALLBACK_RATES.items())
FX = f"""fx AS (
  SELECT currency_code, CAST(r AS DECIMAL(12,6)) AS rate_to_usd
  FROM (VALUES {_rate_rows}) AS t(currency_code, r))"""

_scenario_rows = ", ".join(f"({row[0]}, {row[-1]})" for row in SCENARIOS)
SCEN = f"""scen AS (
  SELECT scenario_id, CAST(f AS DECIMAL(6,2)) AS f, CAST(f AS DECIMAL(6,2)) AS market_stress_factor
  FROM (VALUES {_scenario_rows}) AS t(scenario_id, f))"""

ONE = "CAST(1 AS DECIMAL(12,6))"
LEVEL = "CASE WHEN f >= 1.5 THEN 'HIGH' WHEN f >= 1.2 THEN 'MEDIUM' ELSE 'LOW' END"

# Identifying columns of the converted rows.
KEYS = {
    "transactions": ["transaction_id"],
    "cash": ["cash_position_id"],
    "loans": ["loan_id", "tranche", "branch_id"],
    "intraday": ["intraday_id"],
}

FEED = """feed AS (
  SELECT o_orderkey AS fx_rate_id, currency_code, region_code,
         CAST((CASE currency_code WHEN 'USD' THEN CAST(1.0 AS DECIMAL(12,6))
                WHEN 'EUR' THEN CAST(1.09 AS DECIMAL(12,6))
                WHEN 'JPY' THEN CAST(0.0068 AS DECIMAL(12,6))
                WHEN 'AED' THEN CAST(0.2723 AS DECIMAL(12,6))
                ELSE CAST(0.0535 AS DECIMAL(12,6)) END)
              * CAST(o_orderkey % 101 + 950 AS DECIMAL(6,0)) * CAST(0.001 AS DECIMAL(4,3))
              AS DECIMAL(12,6)) AS fx_rate_to_usd,
         o_orderdate AS as_of_timestamp
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN geo ON c_nationkey = n_nationkey),
newest AS (
  SELECT currency_code, fx_rate_to_usd AS rate_to_usd FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY currency_code
                                 ORDER BY as_of_timestamp DESC, fx_rate_to_usd DESC) AS k
    FROM feed) WHERE k = 1)"""

RAW_LOANS = """raw_loans AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS loan_id, CAST(l_linenumber AS VARCHAR) AS tranche,
         ' BR_' || CAST(l_suppkey AS VARCHAR) AS branch_id,
         CASE WHEN l_linenumber = 7 THEN '31/12/2024'
              ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS loan_start_date,
         CASE WHEN l_linenumber = 6 THEN '12,5' WHEN l_linenumber = 5 THEN NULL
              ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS loan_amount,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) - CAST(l_quantity AS DECIMAL(18,2)) + 20
              AS VARCHAR) AS outstanding_balance,
         CAST(NULL AS VARCHAR) AS interest_rate,
         CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS start_date,
         l_returnflag AS loan_type
  FROM lineitem)"""
RAW_LOAN_COLUMNS = ["loan_id", "tranche", "branch_id", "loan_start_date", "loan_amount",
                    "outstanding_balance", "interest_rate", "start_date", "loan_type"]

RAW_TXN = """once AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS transaction_date,
         NULLIF(o_orderpriority, '4-NOT SPECIFIED') AS transaction_type,
         CAST(CASE WHEN o_orderstatus = 'P' THEN -CAST(o_totalprice AS DECIMAL(18,2))
                   ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS VARCHAR) AS transaction_amount
  FROM orders),
raw_txn AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE transaction_type = '1-URGENT')"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def money(expr: str, alias: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(38,4)) AS DOUBLE) AS {alias}"


def pct(part: str, whole: str) -> str:
    """Percentage with two decimals, half up, in integer arithmetic."""
    return f"CASE WHEN {whole} > 0 THEN (({part}) * 20000 + {whole}) // (2 * {whole}) / 100.0 ELSE 0.0 END"


def _usd(name: str) -> str:
    """Stressed amount of one expanded row."""
    amount = SPECS[name].measure.source.removesuffix("_usd")
    return f"{amount} * COALESCE(rate_to_usd, {ONE}) * f"


def _expanded(name: str) -> str:
    return f"{name} LEFT JOIN fx USING (currency_code) CROSS JOIN scen"


def base(*names: str) -> str:
    return with_(GEO, *[DOMAIN[n] for n in names], FX, SCEN)


def region_totals(name: str, with_count: bool = False) -> str:
    count = ", COUNT(*) AS n" if with_count else ""
    return (
        base(name)
        + f"SELECT scenario_id, region_code, {money(f'SUM({_usd(name)})', SPECS[name].measure.total)}{count}\n"
        + f"FROM {_expanded(name)} GROUP BY scenario_id, region_code"
    )


def rollup(name: str) -> str:
    total = money(f"SUM({_usd(name)})", SPECS[name].measure.combined)
    return base(name) + f"SELECT scenario_id, {total} FROM {_expanded(name)} GROUP BY scenario_id"


def _per_scenario(name: str) -> str:
    total = SPECS[name].measure.combined
    return (f"{name}_total AS (SELECT scenario_id, SUM({_usd(name)}) AS {total} "
            f"FROM {_expanded(name)} GROUP BY scenario_id)")


def _combined_ctes() -> str:
    return with_(GEO, *DOMAIN.values(), FX, SCEN, *map(_per_scenario, TRANSFORMABLE))


_COMBINED_FROM = "FROM " + " FULL JOIN ".join(
    f"{n}_total" + (" USING (scenario_id)" if i else "") for i, n in enumerate(TRANSFORMABLE)
)


def combined() -> str:
    metrics = [SPECS[n].measure.combined for n in TRANSFORMABLE]
    cols = ", ".join(money(f"COALESCE({m}, 0)", m) for m in metrics)
    return _combined_ctes() + f"SELECT scenario_id, {cols} {_COMBINED_FROM}"


def conversion(name: str) -> str:
    cols = ", ".join(
        money(f"{a} * COALESCE(rate_to_usd, {ONE})", f"{a}_usd") for a in SPECS[name].amounts
    )
    return (
        base(name) + f"SELECT {', '.join(KEYS[name])}, currency_code, "
        f"{money(f'COALESCE(rate_to_usd, {ONE})', 'rate_to_usd')}, {cols}\n"
        f"FROM {name} LEFT JOIN fx USING (currency_code)"
    )


def _live() -> str:
    return """live AS (
  SELECT upper(lower(currency_code)) AS currency_code, rate_to_usd FROM newest
  WHERE currency_code NOT IN ('AED', 'USD')
  UNION ALL SELECT 'USD', CAST(1 AS DECIMAL(12,6)))"""


# The whole feed as the live answer.
_LIVE_ALL = """live AS (
  SELECT currency_code, rate_to_usd FROM newest WHERE currency_code <> 'USD'
  UNION ALL SELECT 'USD', CAST(1 AS DECIMAL(12,6)))"""

_PER_CURRENCY = """chosen AS (
  SELECT * FROM live
  UNION ALL SELECT * FROM fx WHERE currency_code NOT IN (SELECT currency_code FROM live))"""


def resolved(mode: str) -> str:
    chosen = _PER_CURRENCY if mode == "per_currency" else "chosen AS (SELECT * FROM live)"
    return with_(GEO, FX, FEED, _live(), chosen) + (
        "SELECT currency_code, CAST(rate_to_usd AS DOUBLE) AS rate_to_usd FROM chosen"
    )


LATEST_RATES = with_(GEO, FEED) + (
    "SELECT currency_code, CAST(rate_to_usd AS DOUBLE) AS rate_to_usd FROM newest"
)

CONVERT_FEED = with_(GEO, FX, DOMAIN["transactions"], FEED, _LIVE_ALL, _PER_CURRENCY) + f"""
SELECT currency_code,
       {money(f"SUM(transaction_amount * COALESCE(rate_to_usd, {ONE}))", "amount_usd")}, COUNT(*) AS n
FROM transactions LEFT JOIN chosen USING (currency_code) GROUP BY currency_code"""

CONVERT_INVERTED = with_(GEO, DOMAIN["transactions"]) + f"""
SELECT currency_code, CAST(rate AS DOUBLE) AS rate_to_usd,
       {money("SUM(transaction_amount * rate)", "amount_usd")}
FROM (SELECT *, CAST(CASE currency_code WHEN 'EUR' THEN 1.25 WHEN 'JPY' THEN 0.00625
                     WHEN 'AED' THEN 0.25 ELSE 1.0 END AS DECIMAL(12,6)) AS rate FROM transactions)
GROUP BY currency_code, rate"""

CONVERT_TO_BASE = base("transactions") + f"""
SELECT transaction_id, {money(f"transaction_amount * COALESCE(rate_to_usd, {ONE})", "amount_usd")}
FROM (SELECT transaction_id, transaction_amount,
             CASE WHEN transaction_type = '1-URGENT' THEN NULL ELSE currency_code END AS currency_code
      FROM transactions) LEFT JOIN fx USING (currency_code)"""

SCENARIO_EXPAND_LOANS = base("loans") + f"""
SELECT loan_id, tranche, branch_id, CAST(business_date AS VARCHAR) AS business_date, scenario_id,
       {money("f", "market_stress_factor")}, {money(_usd("loans"), "stressed_exposure")},
       {LEVEL} AS stress_level
FROM {_expanded("loans")}"""

SCENARIO_FIRST_N = base("cash") + """
SELECT scenario_id, COUNT(*) AS n, CAST(CAST(SUM(closing_balance) AS DECIMAL(38,4)) AS DOUBLE) AS closing_balance
FROM cash CROSS JOIN (SELECT * FROM scen ORDER BY scenario_id LIMIT 3) GROUP BY scenario_id"""

LEVELS = base("loans") + (
    f"SELECT {LEVEL} AS stress_level, COUNT(*) AS records, "
    f"{money(f'SUM({_usd('loans')})', 'stressed_exposure')} FROM {_expanded('loans')} GROUP BY 1"
)

DEDUP_ROWS = """
SELECT DISTINCT * REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate)
FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem)"""

CLEAN_TYPES = """
SELECT event_id,
       CASE WHEN event_type IN ('view', 'error') THEN 0.0 ELSE value END AS amount,
       COALESCE(NULLIF(event_type, 'click'), 'UNKNOWN') AS label,
       CASE WHEN event_type = 'signup' THEN NULL ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS day,
       CAST(1.5 AS DOUBLE) AS fee, 'UNKNOWN' AS branch, '1999-12-31' AS loaded
FROM events"""

NORMALIZE_NAMES = """
SELECT o_orderkey AS order_key, o_orderpriority AS priority, o_orderstatus AS order_status,
       o_custkey AS cust_key, o_totalprice AS total_price,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date FROM orders"""

DEFAULT_REGION = """
SELECT s_suppkey, 'UNKNOWN' AS region_code, '1999-12-31' AS business_date FROM supplier"""

DEFAULT_CURRENCY = """
SELECT o_orderkey AS transaction_id, 'USD' AS currency_code,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS transaction_amount_usd FROM orders"""

DATE_FROM_TIMESTAMP = """
SELECT 'UNKNOWN' AS region_code, CAST(CAST(ts AS DATE) AS VARCHAR) AS as_of_timestamp_date,
       COUNT(*) AS n
FROM events GROUP BY 1, 2"""

# --- validation -----------------------------------------------------------------


def _check(layer: str, table: str, check: str, value: str, source: str, bad: str) -> str:
    """One check row. ``bad`` is the status of a non-zero value, or a CASE over ``v``."""
    status = bad if bad.startswith("CASE") else f"CASE WHEN v = 0 THEN 'PASS' ELSE '{bad}' END"
    return (f"SELECT '{layer}' AS layer, '{table}' AS table_name, '{check}' AS check_name, "
            f"CAST(v AS BIGINT) AS value, {status} AS status FROM (SELECT {value} AS v FROM {source})")


_ROWS = "CASE WHEN v > 0 THEN 'PASS' ELSE 'FAIL' END"
_INFO = "CASE WHEN v >= 0 THEN 'INFO' END"


def _listed(names) -> str:
    """Names with their positions as a relation (p, c)."""
    return "(VALUES " + ", ".join(f"({i}, '{c}')" for i, c in enumerate(names)) + ") AS r(p, c)"


def _bronze(table: str, source: str) -> list[str]:
    absent = f"(SELECT c FROM {_listed(SPECS[table].required)} EXCEPT SELECT column_name FROM (DESCRIBE {source}))"
    return [
        _check("bronze", table, "row_count", "COUNT(*)", source, _ROWS),
        _check("bronze", table, "missing_columns", "COUNT(*)", absent, "FAIL"),
    ]


VALIDATE_BRONZE = with_(GEO, *DOMAIN.values(), FEED, SCEN) + "\nUNION ALL ".join(
    [row for n in TRANSFORMABLE for row in _bronze(n, n)]
    + _bronze("fx_rates", "feed") + _bronze("scenario", "scen")
)

_SILVER_DOMAINS = {
    "transactions": (["transaction_id", "customer_id", "transaction_date", "transaction_type",
                      "transaction_amount", "region_code", "currency_code"], "transaction_id"),
    "cash": (["cash_position_id", "region_code", "currency_code", "business_date", "closing_balance",
              "available_liquidity"], "cash_position_id"),
    "loans": (["loan_id", "tranche", "branch_id", "business_date", "loan_amount", "outstanding_balance",
               "interest_rate", "region_code", "currency_code"], "loan_id, tranche"),
    "intraday": (["intraday_id", "as_of_timestamp_date", "region_code", "currency_code", "inflow_amount",
                  "outflow_amount", "net_position"], "intraday_id"),
}


def _silver_checks(name: str, source: str = "", key: str = "", more: tuple[str, ...] = ()) -> list[str]:
    table = name
    columns, own_key = _SILVER_DOMAINS[name]
    columns, key, name = [*columns, *more], key or own_key, source or name
    with_nulls = " + ".join(f"CAST(COUNT(*) > COUNT({c}) AS INT)" for c in columns)
    return [
        _check("silver", table, "row_count", "COUNT(*)", name, _INFO),
        _check("silver", table, "null_columns", with_nulls, name, "WARN"),
        *[f"SELECT * FROM ({_check('silver', table, f'nulls:{c}', f'COUNT(*) - COUNT({c})', name, 'WARN')}) WHERE value > 0"
          for c in columns],
        _check("silver", table, "duplicate_keys", "COUNT(*)",
               f"(SELECT 1 FROM {name} GROUP BY {key} HAVING COUNT(*) > 1)", "WARN"),
    ]


VALIDATE_SILVER = with_(GEO, *[DOMAIN[n] for n in ("cash", "loans", "intraday")], FEED, RAW_TXN) + "\nUNION ALL ".join(
    [row for n in ("cash", "loans", "intraday") for row in _silver_checks(n)] + [
    _check("silver", "transactions", "row_count", "COUNT(*)", "raw_txn", _INFO),
    _check("silver", "transactions", "null_columns",
           "CAST(COUNT(*) > COUNT(transaction_type) AS INT)", "raw_txn", "WARN"),
    _check("silver", "transactions", "nulls:transaction_type",
           "COUNT(*) - COUNT(transaction_type)", "raw_txn", "WARN"),
    _check("silver", "transactions", "duplicate_keys", "COUNT(*)",
           "(SELECT transaction_id FROM raw_txn GROUP BY 1 HAVING COUNT(*) > 1)", "WARN"),
    _check("silver", "fx_rates", "row_count", "COUNT(*)", "feed", _INFO),
    _check("silver", "fx_rates", "null_columns", " + ".join(
        f"CAST(COUNT(*) > COUNT({c}) AS INT)"
        for c in ("fx_rate_id", "currency_code", "region_code", "fx_rate_to_usd", "as_of_timestamp")
    ), "feed", "WARN"),
    _check("silver", "fx_rates", "non_positive_rate",
           "COUNT(*) FILTER (fx_rate_to_usd <= 0)", "feed", "FAIL"),
    _check("silver", "fx_rates", "duplicate_keys", "COUNT(*)",
           "(SELECT fx_rate_id FROM feed GROUP BY 1 HAVING COUNT(*) > 1)", "WARN"),
])

_NEGATIVE_GOLD = {"transactions": "negative_stressed_amount", "cash": "negative_liquidity"}


def _gold_checks(name: str, rows: str = "") -> list[str]:
    source = _expanded(name).replace(name, rows or name, 1)
    rows = [
        _check("gold", name, "row_count", "COUNT(*)", source, _INFO),
        _check("gold", name, "non_positive_factor", "COUNT(*) FILTER (f <= 0)", source, "FAIL"),
    ]
    if name in _NEGATIVE_GOLD:
        negative = f"COUNT(*) FILTER ({_usd(name)} < 0)"
        rows.append(_check("gold", name, _NEGATIVE_GOLD[name], negative, source, "WARN"))
    return rows


VALIDATE_GOLD = base(*TRANSFORMABLE) + "\nUNION ALL ".join(
    row for name in TRANSFORMABLE for row in _gold_checks(name)
)

ROW_COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}"
    for t in ("orders", "lineitem", "customer", "events")
)

DUPLICATE_KEYS = """
SELECT COUNT(*) AS duplicate_keys FROM (
  SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)"""

KEY_COUNTS = with_(RAW_TXN) + (
    "SELECT transaction_type, COUNT(*) AS row_count FROM raw_txn GROUP BY transaction_type"
)

# --- quality profile ------------------------------------------------------------

NULL_METRICS = with_(RAW_LOANS) + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count, "
    f"{pct(f'COUNT(*) - COUNT({c})', 'COUNT(*)')} AS null_pct FROM raw_loans"
    for c in RAW_LOAN_COLUMNS
)

WORST_NULL = with_(RAW_TXN) + """
SELECT column_name, null_count FROM (
  """ + "\n  UNION ALL ".join(
    f"SELECT {i} AS p, '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count FROM raw_txn"
    for i, c in enumerate(["transaction_id", "customer_id", "transaction_date", "transaction_type",
                           "transaction_amount"])
) + ") ORDER BY null_count DESC, p LIMIT 1"


def _duplicates(table: str, source: str, key: str) -> str:
    return f"""SELECT '{table}' AS table_name, n AS total_rows, n - d AS duplicate_rows,
       {pct("n - d", "n")} AS duplicate_pct, n - k AS pk_duplicate_count
FROM (SELECT (SELECT COUNT(*) FROM {source}) AS n,
             (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM {source})) AS d,
             (SELECT COUNT(*) FROM (SELECT DISTINCT {key} FROM {source})) AS k)"""


DUPLICATE_METRICS = with_(RAW_TXN, RAW_LOANS) + (
    _duplicates("transactions", "raw_txn", "transaction_id")
    + "\nUNION ALL " + _duplicates("loans", "raw_loans", "loan_id, tranche")
)

_NUMBER = r"'[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?'"


def _type_of(col: str, source: str) -> str:
    number = f"regexp_full_match(trim({col}), {_NUMBER})"
    stamp = f"TRY_CAST(trim({col}) AS TIMESTAMP)"
    return f"""SELECT '{col}' AS column_name,
  CASE WHEN COUNT({col}) = 0 THEN 'float'
       WHEN COUNT(*) FILTER ({number}) = COUNT({col}) THEN
         CASE WHEN COUNT(*) FILTER (regexp_full_match(trim({col}), '[+-]?[0-9]+')) = COUNT(*)
              THEN 'int' ELSE 'float' END
       WHEN COUNT({stamp}) = COUNT({col}) THEN
         CASE WHEN bool_or({stamp} > date_trunc('day', {stamp})) THEN 'datetime' ELSE 'date' END
       ELSE 'string' END AS semantic_type FROM {source}"""


_TEXT_EVENTS = """text_events AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(ts AS VARCHAR) AS event_time, event_type,
         CASE WHEN event_type <> 'view' THEN CAST(user_id AS VARCHAR) END AS user_text FROM events)"""

SEMANTIC_TYPES = with_(RAW_LOANS, _TEXT_EVENTS) + "\nUNION ALL ".join(
    [_type_of(c, "raw_loans") for c in RAW_LOAN_COLUMNS]
    + [_type_of(c, "text_events") for c in ("event_id", "event_time", "user_text", "event_type")]
    + ["SELECT 'event_day', 'date'", "SELECT 'value', 'float'"]
)


def _schema_rows() -> str:
    expected = SPECS["loans"].columns
    rows = [
        f"('{c}', '{kind}')" for c, kind in expected.items()
    ]
    return f"""expected AS (SELECT * FROM (VALUES {', '.join(rows)}) AS t(column_name, expected_type))"""


SCHEMA_CHECK = with_(
    RAW_LOANS,
    "found AS (" + "\nUNION ALL ".join(_type_of(c, "raw_loans") for c in RAW_LOAN_COLUMNS) + ")",
    _schema_rows(),
) + """
SELECT column_name, expected_type,
       CASE WHEN expected_type IS NOT NULL THEN semantic_type END AS actual_type,
       CASE WHEN expected_type IS NULL THEN 'extra' WHEN semantic_type IS NULL THEN 'missing'
            WHEN semantic_type = expected_type
              OR (expected_type = 'float' AND semantic_type = 'int')
              OR (expected_type = 'datetime' AND semantic_type = 'date') THEN 'ok'
            ELSE 'type_mismatch' END AS issue
FROM expected FULL JOIN found USING (column_name)"""

FORMAT_VALIDITY = with_(RAW_LOANS) + "\nUNION ALL ".join([
    *[f"SELECT '{c}' AS column_name, 'Invalid numeric values' AS check_name, "
      f"COUNT(*) FILTER (NOT regexp_full_match(trim({c}), {_NUMBER})) AS invalid_count FROM raw_loans"
      for c in ("loan_amount", "outstanding_balance")],
    *[f"SELECT '{c}', 'Invalid date format', "
      f"COUNT(*) FILTER ({c} IS NOT NULL AND TRY_CAST(trim({c}) AS TIMESTAMP) IS NULL) FROM raw_loans"
      for c in ("loan_start_date", "start_date")],
])


def _numeric_stats(position: int, col: str, expr: str) -> str:
    return f"""SELECT {position} AS position, '{col}' AS column_name, 'numeric' AS kind,
  CAST(MIN({expr}) AS DOUBLE) AS min_value, CAST(MAX({expr}) AS DOUBLE) AS max_value,
  round(CAST(SUM({expr}) AS DOUBLE) / COUNT({expr}), 4) AS mean_value,
  COUNT(DISTINCT {expr}) AS distinct_count, CAST(NULL AS VARCHAR) AS top_value,
  CAST(NULL AS DOUBLE) AS top_pct FROM lineitem"""


def _text_stats(position: int, col: str, expr: str) -> str:
    return f"""SELECT {position}, '{col}', 'categorical', NULL, NULL, NULL, d, v, {pct("n", "total")}
FROM (SELECT v, n, COUNT(*) OVER () AS d, SUM(n) OVER () AS total,
             ROW_NUMBER() OVER (ORDER BY n DESC, v) AS k
      FROM (SELECT CAST({expr} AS VARCHAR) AS v, COUNT(*) AS n FROM lineitem GROUP BY 1)) WHERE k = 1"""


COLUMN_STATISTICS = "\nUNION ALL ".join([
    _numeric_stats(0, "l_orderkey", "l_orderkey"),
    _numeric_stats(1, "l_extendedprice", "CAST(l_extendedprice AS DECIMAL(18,2))"),
    _text_stats(2, "l_shipdate", "CAST(l_shipdate AS DATE)"),
    _text_stats(3, "l_returnflag", "l_returnflag"),
    _numeric_stats(4, "l_linenumber", "l_linenumber"),
])


def _rule(label: str, violated: str, source: str) -> str:
    return (f"SELECT '{label}' AS rule_name, n AS violations, "
            f"CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS status "
            f"FROM (SELECT COUNT(*) FILTER ({violated}) AS n FROM {source})")


_OVER = "TRY_CAST(outstanding_balance AS DECIMAL(18,2)) > TRY_CAST(loan_amount AS DECIMAL(18,2))"
# '12,5' has to stay unreadable whatever the engine makes of the comma.
_OVER_LOAN = f"regexp_full_match(loan_amount, {_NUMBER}) AND {_OVER}"
_NEGATIVE = "CAST(transaction_amount AS DECIMAL(18,2)) < 0"
_FUTURE = "CAST(transaction_date AS DATE) > DATE '1999-12-31'"

BUSINESS_RULES = with_(GEO, DOMAIN["cash"], DOMAIN["intraday"], FEED, RAW_TXN, RAW_LOANS) + "\nUNION ALL ".join([
    _rule("Negative transaction amount", _NEGATIVE, "raw_txn"),
    _rule("Future transaction date", _FUTURE, "raw_txn"),
    _rule("Outstanding balance > loan amount", _OVER_LOAN, "raw_loans"),
    _rule("Available liquidity > closing balance", "available_liquidity > closing_balance", "cash"),
    _rule("Net position mismatch (inflow - outflow)", "inflow_amount > 50", "intraday"),
    _rule("FX rate <= 0", "fx_rate_to_usd <= 0", "feed"),
])

RECORD_COUNT = "\nUNION ALL ".join(
    f"SELECT '{text}' AS expected_rows, COUNT(*) AS actual_rows, "
    f"CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END AS status FROM orders"
    for text, ok in [
        ("Not enforced", "true"),
        *[(f"~{n}", f"abs(COUNT(*) - {n}) <= {max(5, n * 5 // 100)}") for n in (15000, 14286, 100)],
    ]
)


def _invalid(table: str, columns: list[str]) -> str:
    """Values of number and date columns that do not read as such."""
    tests = {
        "float": f"NOT regexp_full_match(trim({{c}}), {_NUMBER})", "int": f"NOT regexp_full_match(trim({{c}}), {_NUMBER})",
        "date": "{c} IS NOT NULL AND TRY_CAST(trim({c}) AS TIMESTAMP) IS NULL",
        "datetime": "{c} IS NOT NULL AND TRY_CAST(trim({c}) AS TIMESTAMP) IS NULL",
    }
    kinds = SPECS[table].columns
    checked = [(c, tests[kinds[c]]) for c in columns if kinds.get(c) in tests]
    return " + ".join(f"COUNT(*) FILTER ({test.format(c=c)})" for c, test in checked)


def _report(table: str, source: str, columns: list[str], rules: str, key: str = "") -> str:
    """One report row of a source whose columns are all text."""
    expected = SPECS[table].columns
    key = key or ", ".join(SPECS[table].key)
    found = f"(SELECT column_name FROM (DESCRIBE {source}))"
    kinds = "(VALUES " + ", ".join(f"('{c}', '{k}')" for c, k in expected.items()) + ") AS e(column_name, expected_type)"
    counted = "\n  UNION ALL ".join(
        f"SELECT {i} AS p, '{c}' AS c, COUNT(*) - COUNT({c}) AS n FROM {source}" for i, c in enumerate(columns)
    )
    types = "\n  UNION ALL ".join(_type_of(c, source) for c in columns)
    mismatched = f"""SELECT COUNT(*) FROM ({types}) JOIN {kinds} USING (column_name)
    WHERE semantic_type <> expected_type AND NOT (expected_type = 'float' AND semantic_type = 'int')
      AND NOT (expected_type = 'datetime' AND semantic_type = 'date')"""
    return f"""SELECT * EXCLUDE (worst, missing, extra), 9 - passed_checks AS failed_checks,
  CASE WHEN passed_checks = 9 THEN 'Proceed to ingestion'
       ELSE 'Fix schema / validity issues and deduplicate before ingestion' END AS recommendation
FROM (SELECT *, CASE WHEN final_score >= 95 THEN 'GOOD' WHEN final_score >= 85 THEN 'NEEDS ATTENTION'
                     ELSE 'POOR' END AS grade,
  CAST(overall_nulls = 0 AS INT) + CAST(duplicate_rows = 0 AS INT) + CAST(pk_duplicate_count = 0 AS INT)
  + CAST(missing_columns = 0 AS INT) + CAST(extra_columns = 0 AS INT) + CAST(type_mismatches = 0 AS INT)
  + CAST(invalid_formats = 0 AS INT) + CAST(rule_violations = 0 AS INT) + 1 AS passed_checks,
  coalesce(nullif(concat_ws('; ', CASE WHEN overall_nulls > 0 THEN worst || ' has nulls' END,
    CASE WHEN pk_duplicate_count > 0 THEN 'duplicate {key} found' END,
    'missing column(s): ' || missing, 'extra column(s): ' || extra), ''), 'No major issues detected') AS major_issues
FROM (SELECT * EXCLUDE (v), round(v, 2) AS validity,
             round((completeness + uniqueness + v) / 3.0, 2) AS final_score
FROM (SELECT *, round((1 - overall_nulls / total_cells) * 100.0, 2) AS completeness,
  round(100.0 - duplicate_pct, 2) AS uniqueness,
  greatest(0.0, 100.0 - (invalid_formats + rule_violations + missing_columns + extra_columns
           + type_mismatches) / total_rows * 100.0) AS v, 'PASS' AS record_count_status
FROM (SELECT *, total_rows * total_columns AS total_cells FROM ({_duplicates(table, source, key)})
      CROSS JOIN (SELECT COUNT(*) AS total_columns FROM {found}))
CROSS JOIN (SELECT SUM(n)::BIGINT AS overall_nulls, arg_max(c, n * 1000 - p) AS worst FROM ({counted}))
CROSS JOIN (SELECT COUNT(*) AS missing_columns, string_agg(c, ', ' ORDER BY p) AS missing
            FROM {_listed(expected)} WHERE c NOT IN {found})
CROSS JOIN (SELECT COUNT(*) AS extra_columns, string_agg(c, ', ' ORDER BY p) AS extra FROM {_listed(columns)}
            WHERE c NOT IN (SELECT c FROM {_listed(expected)}) AND c IN {found})
CROSS JOIN (SELECT {_invalid(table, columns)} AS invalid_formats, {rules} AS rule_violations,
                   ({mismatched}) AS type_mismatches FROM {source}))))"""


_TXN_COLUMNS = ["transaction_id", "customer_id", "transaction_date", "transaction_type",
                "transaction_amount"]
_TXN_RULES = f"COUNT(*) FILTER ({_NEGATIVE}) + COUNT(*) FILTER ({_FUTURE})"
# The same for a load after the last order.
_LATER_RULES = _TXN_RULES.replace("1999-12-31", "2024-01-31")
_LOAN_RULES = f"COUNT(*) FILTER ({_OVER_LOAN})"
QUALITY_REPORT = with_(RAW_TXN, RAW_LOANS) + (
    _report("transactions", "raw_txn", _TXN_COLUMNS, _TXN_RULES)
    + "\nUNION ALL BY NAME "
    + _report("loans", "raw_loans", RAW_LOAN_COLUMNS, _LOAN_RULES, "loan_id, tranche")
)

# --- layered runs ---------------------------------------------------------------

INGESTED = with_(GEO, DOMAIN["intraday"]) + """
SELECT intraday_id, CAST(as_of_timestamp_date AS VARCHAR) AS as_of_timestamp_date, region_code,
       currency_code, CAST(net_position AS DOUBLE) AS net_position FROM intraday"""

INGESTED_ALL = with_(GEO, *DOMAIN.values(), FEED, SCEN) + "\nUNION ALL ".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS n, {money(f'SUM({amount})', 'total')} FROM {source}"
    for name, source, amount in [
        *[(n, n, SPECS[n].measure.source.removesuffix("_usd")) for n in TRANSFORMABLE],
        ("fx_rates", "feed", "fx_rate_to_usd"), ("scenario", "scen", "f"),
    ]
)

_DISTINCT = {n: f"{n}_rows AS (SELECT DISTINCT * FROM {n})" for n in TRANSFORMABLE}
LAYER_TOTALS = with_(GEO, *DOMAIN.values(), FX, SCEN, *_DISTINCT.values()) + "\nUNION ALL ".join(
    f"SELECT '{n}' AS table_name, scenario_id, region_code, {money(f'SUM({_usd(n)})', 'total')} "
    f"FROM {_expanded(n).replace(n, n + '_rows', 1)} GROUP BY scenario_id, region_code"
    for n in TRANSFORMABLE
)



def _extracts(name: str) -> list[str]:
    """Gold rows, regional totals and the combined metric of one domain."""
    total, combined = money(f"SUM({_usd(name)})", "total"), SPECS[name].measure.combined
    regional = f"{total} FROM {_expanded(name)} GROUP BY scenario_id, region_code"
    return [
        f"SELECT '{name}' AS extract, scenario_id, region_code, COUNT(*) AS n, {regional}",
        f"SELECT 'aggregates_{name}', scenario_id, region_code, 1, {regional}",
        f"SELECT 'aggregates_combined', scenario_id, '{combined}', 1, {total} "
        f"FROM {_expanded(name)} GROUP BY scenario_id",
    ]


REPORTED = base(*TRANSFORMABLE) + "\nUNION ALL ".join(
    part for name in TRANSFORMABLE for part in _extracts(name)
)

RUN_REPORT = with_(GEO, *DOMAIN.values()) + "\nUNION ALL ".join(
    f"SELECT 'bronze' AS stage, '{n}' AS table_name, 'written' AS status, COUNT(*) AS rows, '' AS note FROM {n}"
    if n != "intraday" else
    "SELECT 'bronze', 'intraday', 'skipped', CAST(NULL AS BIGINT), 'no raw drop'"
    for n in TRANSFORMABLE
)

ROW_COUNT_CUSTOMERS = (
    f"SELECT COUNT(*) AS n, {money('SUM(CAST(c_acctbal AS DECIMAL(18,2)))', 'balance')} FROM customer"
)

# Silver tables: distinct rows with their rate and converted amounts.
_SILVER = {
    n: f"{n}_silver AS (SELECT *, COALESCE(rate_to_usd, {ONE}) AS rate, "
       + ", ".join(f"{a} * COALESCE(rate_to_usd, {ONE}) AS {a}_usd" for a in SPECS[n].amounts)
       + f" FROM {n}_rows LEFT JOIN fx USING (currency_code))"
    for n in TRANSFORMABLE
}
_LAYER_CTES = with_(GEO, *DOMAIN.values(), FX, FEED, SCEN, *_DISTINCT.values(), *_SILVER.values())
_RUN_CHECKS = [
    row for n in TRANSFORMABLE for row in [
        *_silver_checks(n, f"{n}_silver", ", ".join(SPECS[n].key), ("rate", *[f"{a}_usd" for a in SPECS[n].amounts])),
        *_gold_checks(n, f"{n}_rows"),
    ]
]
VALIDATE_LAYERS = _LAYER_CTES + "\nUNION ALL ".join(
    [row for n in TRANSFORMABLE for row in _bronze(n, n)]
    + _bronze("fx_rates", "feed") + _bronze("scenario", "scen") + _RUN_CHECKS
)
VALIDATE_OBSERVED = _LAYER_CTES + "\nUNION ALL ".join(_RUN_CHECKS)

FULL_TXN = DOMAIN["transactions"] + """,
full_txn AS (
  SELECT 'T' || transaction_id AS transaction_id, 'A' || customer_id AS account_id, 'C' || customer_id AS customer_id,
         'BR_' || region_code AS branch_id, CAST(transaction_date AS VARCHAR) AS transaction_date, transaction_type,
         CAST(transaction_amount AS VARCHAR) AS transaction_amount, currency_code, region_code,
         'L' || customer_id AS loan_id, CAST(transaction_date AS VARCHAR) AS start_date,
         CAST(transaction_date AS VARCHAR) AS end_date, 'Base' AS baseline,
         CASE WHEN transaction_amount < 100000 THEN 'small' ELSE 'large' END AS amount_bucket
  FROM transactions)"""
_FULL_COLUMNS = list(SPECS["transactions"].columns)


def gated(report: str, extra: str = "") -> str:
    """What the gate makes of a drop with this report."""
    return f"""SELECT {extra} CASE WHEN failed_checks = 0 THEN 'written' ELSE 'refused' END AS status, total_rows AS rows,
       CASE WHEN failed_checks = 0 THEN '' ELSE major_issues END AS note FROM ({report})"""


# A refused step of a batch run names no rows.
QUALITY_GATE = with_(GEO, FULL_TXN, RAW_LOANS) + (
    "SELECT stage, table_name, status, CASE WHEN status = 'written' THEN rows END AS rows, note FROM (\n"
    + gated(_report("transactions", "full_txn", _FULL_COLUMNS, _LATER_RULES), "'bronze' AS stage, table_name,")
    + "\nUNION ALL BY NAME "
    + gated(_report("loans", "raw_loans", RAW_LOAN_COLUMNS, _LOAN_RULES), "'bronze' AS stage, table_name,")
    + ")"
)


def _half(name: str, condition: str) -> str:
    return f"{name} AS (SELECT f.* FROM full_txn f JOIN orders ON transaction_id = 'T' || o_orderkey WHERE {condition})"


def _loaded(load: str, source: str, columns: list[str]) -> str:
    amount = money("(SELECT SUM(CAST(transaction_amount AS DECIMAL(18,2))) FROM " + source + ")", "total")
    return gated(_report("transactions", source, columns, _LATER_RULES), f"'{load}' AS load_id, {amount},")


STREAMED = with_(
    GEO, FULL_TXN, RAW_TXN, _half("first_half", "o_orderstatus = 'F'"), _half("second_half", "o_orderstatus <> 'F'"),
) + "\nUNION ALL BY NAME ".join([
    _loaded("transactions_1.csv", "first_half", _FULL_COLUMNS),
    _loaded("transactions_2.csv", "second_half", _FULL_COLUMNS),
    _loaded("transactions_3.csv", "raw_txn", _TXN_COLUMNS),
])

PARTITION_FAILURE = "SELECT COUNT(*) AS n, 'missing transaction_date' AS status FROM orders"


def combined_missing() -> str:
    """The combined view with the cash total of scenario 3 left out."""
    metrics = [SPECS[n].measure.combined for n in TRANSFORMABLE]
    values = {m: f"COALESCE({m}, 0)" for m in metrics}
    values["liq_total"] = "CASE WHEN scenario_id = 3 THEN 0 ELSE COALESCE(liq_total, 0) END"
    cols = ", ".join(money(v, m) for m, v in values.items())
    return _combined_ctes() + f"SELECT scenario_id, {cols} {_COMBINED_FROM}"


# --- reporting measures ---------------------------------------------------------

KPI_CARDS = _combined_ctes() + "SELECT scenario_id, " + ", ".join(
    money(m, n) for m, n in {
        "txn_total": "transaction_volume", "liq_total": "total_liquidity",
        "loan_total": "total_exposure", "intraday_total": "net_intraday_position"}.items()
) + f" {_COMBINED_FROM}"

KPI_VOLUME = base("transactions") + (
    f"SELECT scenario_id, COUNT(*) AS transaction_count, "
    f"{money(f'SUM({_usd('transactions')})', 'transaction_volume')} "
    f"FROM {_expanded('transactions')} GROUP BY scenario_id"
)

KPI_IMPACT = _combined_ctes() + ", long AS (" + "\nUNION ALL ".join(
    f"SELECT scenario_id, '{SPECS[n].measure.combined}' AS metric, "
    f"{money(SPECS[n].measure.combined, 'scenario_total')} FROM {n}_total" for n in TRANSFORMABLE
) + """)
SELECT l.scenario_id, l.metric, l.scenario_total, b.scenario_total AS base_total,
       (l.scenario_total - b.scenario_total) / abs(b.scenario_total) * 100 AS impact_pct
FROM long l JOIN long b ON l.metric = b.metric AND b.scenario_id = 1"""

KPI_SHARE = base("loans") + f"""
SELECT scenario_id, region_code, region_total,
       round(region_total / SUM(region_total) OVER (PARTITION BY scenario_id) * 100, 6) AS share_pct
FROM (SELECT scenario_id, region_code, {money(f"SUM({_usd('loans')})", "region_total")}
      FROM {_expanded("loans")} GROUP BY scenario_id, region_code)"""

KPI_TREND = base("intraday") + f"""
SELECT scenario_id, region_code, CAST(day AS VARCHAR) AS day, {money("t", "daily_total")},
       {money("LAG(t) OVER w", "previous_total")}, {money("t - LAG(t) OVER w", "change")},
       {money("SUM(t) OVER (w ROWS UNBOUNDED PRECEDING)", "running_total")}
FROM (SELECT scenario_id, region_code, as_of_timestamp_date AS day, SUM({_usd("intraday")}) AS t
      FROM {_expanded("intraday")} GROUP BY ALL)
WINDOW w AS (PARTITION BY scenario_id, region_code ORDER BY day)"""

KPI_PIVOT = base("transactions") + "SELECT region_code, " + ", ".join(
    money(f"SUM(CASE WHEN scenario_id = {i} THEN {_usd('transactions')} END)", f"scenario_{i}")
    for i in range(1, 6)
) + f" FROM {_expanded('transactions')} GROUP BY region_code"

KPI_LEVELS = base("loans") + f"""
SELECT {LEVEL} AS stress_level, COUNT(*) AS records,
       {money(f"SUM({_usd('loans')})", "total_stressed_exposure")}
FROM {_expanded("loans")} GROUP BY 1"""

KPI_SLICE = base("cash") + f"""
SELECT scenario_id, region_code, {money(f"SUM({_usd('cash')})", "total_stressed_liquidity")}, COUNT(*) AS n
FROM {_expanded("cash")}
WHERE scenario_id IN (1, 5) AND region_code IN ('ASIA', 'EUROPE') GROUP BY scenario_id, region_code"""
