"""Registered queries over values that hold for a time, with the SQL they must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stresslake.functions.columns import literal_frame
from stresslake.operators import history, scenario
from stresslake.plans import domains
from stresslake.plans import oracle as sql
from stresslake.plans.catalog import iso, money, priced, register

# The feed as published, one rate per currency and day (the largest).
HISTORY = """marks AS (
  SELECT currency_code, CAST(as_of_timestamp AS DATE) + CAST(3 + fx_rate_id % 45 AS INTEGER) AS as_of,
         MAX(fx_rate_to_usd) AS rate_to_usd
  FROM feed GROUP BY ALL)"""


def _asof(name: str, date: str) -> str:
    return sql.with_(sql.GEO, sql.DOMAIN[name], sql.FEED, HISTORY, f"""rated AS (
  SELECT t.*, COALESCE(m.rate_to_usd, {sql.ONE}) AS rate, m.as_of AS rate_as_of
  FROM {name} t ASOF LEFT JOIN marks m ON t.currency_code = m.currency_code AND t.{date} >= m.as_of)""")


ASOF_TRANSACTIONS = _asof("transactions", "transaction_date") + f"""
SELECT transaction_id, currency_code, CAST(transaction_date AS VARCHAR) AS transaction_date,
       CAST(rate AS DOUBLE) AS rate_to_usd, CAST(rate_as_of AS VARCHAR) AS rate_as_of,
       {sql.money("transaction_amount * rate", "transaction_amount_usd")}
FROM rated"""

ASOF_LOANS = _asof("loans", "business_date") + f"""
SELECT currency_code, CAST(date_trunc('month', business_date)::DATE AS VARCHAR) AS month, COUNT(*) AS n,
       COUNT(rate_as_of) AS rated, {sql.money("SUM(outstanding_balance * rate)", "exposure_usd")}
FROM rated GROUP BY 1, 2"""


@register("fx_asof_transactions", ASOF_TRANSACTIONS)
def fx_asof_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each transaction at the newest rate published by its own date."""
    rows = domains.domain(spark, sf_dir, "transactions")
    usd = history.convert_amounts_asof(rows, "transactions", domains.fx_history(spark, sf_dir))
    return usd.select(
        "transaction_id", "currency_code", iso("transaction_date"),
        F.col("rate_to_usd").cast("double").alias("rate_to_usd"), iso(history.AS_OF), money("transaction_amount_usd"),
    )


@register("fx_asof_loans_monthly", ASOF_LOANS)
def fx_asof_loans_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exposure per currency and month, each tranche at the rate of its own date."""
    rows = domains.domain(spark, sf_dir, "loans")
    usd = history.convert_amounts_asof(rows, "loans", domains.fx_history(spark, sf_dir))
    month = F.trunc("business_date", "month").cast("string").alias("month")
    totals = usd.groupBy("currency_code", month).agg(
        F.count(F.lit(1)).alias("n"), F.count(history.AS_OF).alias("rated"),
        F.sum("outstanding_balance_usd").alias("exposure_usd"),
    )
    return totals.select("currency_code", "month", "n", "rated", money("exposure_usd"))


# Versions of the scenarios: open at either end, overlapping, back to back, and never valid.
VERSIONS = (
    (1, "1.00", None, None),
    (2, "1.10", "1993-02-15", "1996-01-01"),
    (2, "1.12", "1996-01-01", None),
    (3, "1.22", None, "1995-06-17"),
    (3, "1.25", "1995-01-01", "1997-03-31"),
    (4, "1.40", "1994-05-05", "1994-05-06"),
    (5, "1.55", "1998-01-01", "1994-01-01"),
)


def scenario_versions(spark: SparkSession) -> DataFrame:
    kinds = {"scenario_id": "int", "market_stress_factor": "decimal(6,2)",
             "effective_date": "date", "expiry_date": "date"}
    return literal_frame(spark, F.array(*[
        F.struct(*[F.lit(None if v is None else str(v)).cast(k).alias(c)
                   for v, (c, k) in zip(row, kinds.items(), strict=True)])
        for row in VERSIONS
    ]))


def _text(value: object, kind: str) -> str:
    return "NULL" if value is None else f"CAST('{value}' AS {kind})"


_VERSION_ROWS = ", ".join(
    f"({i}, {_text(f, 'DECIMAL(6,2)')}, {_text(a, 'DATE')}, {_text(b, 'DATE')})" for i, f, a, b in VERSIONS
)
VALID = sql.with_(sql.GEO, sql.DOMAIN["loans"], sql.FX) + f"""
SELECT loan_id, tranche, branch_id, CAST(business_date AS VARCHAR) AS business_date, scenario_id,
       {sql.money("f", "market_stress_factor")},
       {sql.money(f"outstanding_balance * COALESCE(rate_to_usd, {sql.ONE}) * f", "stressed_exposure")}
FROM loans LEFT JOIN fx USING (currency_code)
JOIN (VALUES {_VERSION_ROWS}) AS v(scenario_id, f, a, b)
  ON (a IS NULL OR a <= business_date) AND (b IS NULL OR business_date < b)"""


@register("scenario_valid_loans", VALID)
def scenario_valid_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans under the scenario versions that are valid on each loan's own date."""
    rows = priced(domains.domain(spark, sf_dir, "loans"), "loans")
    valid = history.expand_valid_scenarios(rows, scenario_versions(spark), "business_date")
    return scenario.add_stress(valid, "loans").select(
        "loan_id", "tranche", "branch_id", iso("business_date"), "scenario_id",
        money("market_stress_factor"), money("stressed_exposure"),
    )
