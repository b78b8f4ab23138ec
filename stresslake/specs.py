"""Table registry: one :class:`TableSpec` per banking table, and the lake layout.

Every stage asks the registry instead of naming columns itself, so the schema,
the key, the date column and the money columns of a table are stated once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

REGION = "region_code"
CURRENCY = "currency_code"
SCENARIO = "scenario_id"
FACTOR = "market_stress_factor"
RATE = "rate_to_usd"


@dataclass(frozen=True)
class Measure:
    """The one stressed amount of a table and the names of its totals."""

    source: str          # USD amount that is multiplied by the factor
    target: str          # stressed amount in the gold layer
    total: str           # sum per scenario and region
    combined: str        # sum per scenario in the combined metrics


@dataclass(frozen=True)
class TableSpec:
    name: str
    folder: str
    columns: dict[str, str]            # column -> string | float | int | date | datetime
    key: tuple[str, ...]
    required: tuple[str, ...]          # columns a bronze table cannot lack
    date_col: str | None = None
    date_from: str | None = None       # timestamp the date column is derived from
    amounts: tuple[str, ...] = ()
    measure: Measure | None = None
    has_region: bool = True

    @property
    def partitions(self) -> list[str]:
        """Partition columns of the bronze and silver layers."""
        return [REGION, self.date_col] if self.date_col else []

    @property
    def gold_partitions(self) -> list[str]:
        return [SCENARIO, *self.partitions]

    @property
    def is_transformable(self) -> bool:
        return self.measure is not None

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c, SPARK_TYPES[kind]) for c, kind in self.columns.items()]
        )


SPARK_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "float": T.DoubleType(),
    "int": T.IntegerType(),
    "date": T.DateType(),
    "datetime": T.TimestampType(),
}


# The column lists and keys of the six tables.
SPECS: dict[str, TableSpec] = {
    s.name: s
    for s in (
        TableSpec(
            name="transactions",
            folder="transactions",
            columns={
                "transaction_id": "string",
                "account_id": "string",
                "customer_id": "string",
                "branch_id": "string",
                "transaction_date": "date",
                "transaction_type": "string",
                "transaction_amount": "float",
                "currency_code": "string",
                "region_code": "string",
                "loan_id": "string",
                "start_date": "date",
                "end_date": "date",
                "baseline": "string",
                "amount_bucket": "string",
            },
            key=("transaction_id",),
            required=("transaction_id", "customer_id", "transaction_amount"),
            date_col="transaction_date",
            amounts=("transaction_amount",),
            measure=Measure(
                "transaction_amount_usd", "stressed_transaction_amount",
                "total_stressed_transactions", "txn_total",
            ),
        ),
        TableSpec(
            name="cash",
            folder="cash",
            columns={
                "cash_position_id": "string",
                "account_id": "string",
                "customer_id": "string",
                "branch_id": "string",
                "business_date": "date",
                "opening_balance": "float",
                "closing_balance": "float",
                "available_liquidity": "float",
                "currency_code": "string",
                "region_code": "string",
                "start_date": "date",
                "end_date": "date",
                "baseline": "string",
            },
            key=("cash_position_id",),
            required=("region_code", "available_liquidity"),
            date_col="business_date",
            amounts=("closing_balance", "available_liquidity"),
            measure=Measure(
                "available_liquidity_usd", "stressed_liquidity",
                "total_stressed_liquidity", "liq_total",
            ),
        ),
        TableSpec(
            name="loans",
            folder="loans",
            columns={
                "loan_id": "string",
                "customer_id": "string",
                "account_id": "string",
                "branch_id": "string",
                "loan_start_date": "date",
                "loan_amount": "float",
                "outstanding_balance": "float",
                "interest_rate": "float",
                "currency_code": "string",
                "region_code": "string",
                "start_date": "date",
                "end_date": "date",
                "baseline": "string",
                "loan_type": "string",
            },
            key=("loan_id",),
            required=("loan_id", "customer_id", "outstanding_balance"),
            date_col="business_date",
            amounts=("loan_amount", "outstanding_balance"),
            measure=Measure(
                "outstanding_balance_usd", "stressed_exposure",
                "total_stressed_exposure", "loan_total",
            ),
        ),
        TableSpec(
            name="intraday",
            folder="intraday",
            columns={
                "intraday_id": "string",
                "account_id": "string",
                "customer_id": "string",
                "loan_id": "string",
                "branch_id": "string",
                "as_of_timestamp": "datetime",
                "inflow_amount": "float",
                "outflow_amount": "float",
                "net_position": "float",
                "currency_code": "string",
                "region_code": "string",
                "start_date": "date",
                "end_date": "date",
                "baseline": "string",
            },
            key=("intraday_id",),
            required=("intraday_id", "net_position"),
            date_col="as_of_timestamp_date",
            date_from="as_of_timestamp",
            amounts=("inflow_amount", "outflow_amount", "net_position"),
            measure=Measure(
                "net_position_usd", "stressed_net_position",
                "total_stressed_position", "intraday_total",
            ),
        ),
        TableSpec(
            name="fx_rates",
            folder="fx",
            columns={
                "fx_rate_id": "string",
                "currency_code": "string",
                "region_code": "string",
                "fx_rate_to_usd": "float",
                "fx_rate_from_usd": "float",
                "as_of_timestamp": "datetime",
                "start_date": "date",
                "end_date": "date",
                "baseline": "string",
            },
            key=("fx_rate_id",),
            required=("currency_code", "fx_rate_to_usd"),
            date_col="as_of_date",
        ),
        TableSpec(
            name="scenario",
            folder="scenario",
            columns={
                "scenario_id": "int",
                "scenario_name": "string",
                "deposit_runoff_pct": "float",
                "loan_drawdown_pct": "float",
                "fx_shock_pct": "float",
                "liquidity_haircut_pct": "float",
                "funding_cost_increase_pct": "float",
                "market_stress_factor": "float",
                "effective_date": "date",
                "expiry_date": "date",
            },
            key=("scenario_id",),
            required=("scenario_id", "market_stress_factor"),
            has_region=False,
        ),
    )
}

TRANSFORMABLE: list[str] = [n for n, s in SPECS.items() if s.is_transformable]

# The five stress scenarios, valid 2026-06-10 to 2099-12-31.
# id, name, runoff, drawdown, fx shock, haircut, funding cost, stress factor
SCENARIOS: tuple[tuple, ...] = (
    (1, "Base", "0.00", "0.00", "0.00", "0.00", "0.00", "1.00"),
    (2, "1 Notch Downgrade", "0.05", "0.04", "0.03", "0.06", "0.02", "1.10"),
    (3, "3 Notch Downgrade", "0.10", "0.08", "0.07", "0.12", "0.05", "1.22"),
    (4, "Severe Downgrade", "0.18", "0.14", "0.12", "0.20", "0.09", "1.40"),
    (5, "Combined", "0.25", "0.18", "0.15", "0.25", "0.12", "1.55"),
)
SCENARIO_START = "2026-06-10"
SCENARIO_END = "2099-12-31"
BASE_SCENARIO = 1

# Static rates, one unit of the currency in USD (quote -> base).
BASE_CURRENCY = "USD"
FALLBACK_RATES: dict[str, float] = {
    "USD": 1.0,
    "EUR": 1.09,
    "JPY": 0.0068,
    "AED": 0.2723,
    "GBP": 1.27,
    "CAD": 0.73,
}


def spec_for(table: str | TableSpec) -> TableSpec:
    """Look a table up by name (``fx`` is short for ``fx_rates``)."""
    if isinstance(table, TableSpec):
        return table
    name = table.strip().lower()
    name = "fx_rates" if name == "fx" else name
    if name not in SPECS:
        raise ValueError(f"unknown table {table!r}; known: {', '.join(SPECS)}")
    return SPECS[name]


@dataclass(frozen=True)
class Layout:
    """Where the layers live below one root path.

    Aggregates are kept beside the gold base tables, never inside them, so a
    base table can be read and rewritten without touching its aggregates.

    Tables are partitioned by region and date. Where a table holds little data per
    day, that makes very many small files; name it in ``undated`` to leave the
    date out of its directories.
    """

    root: str
    undated: tuple[str, ...] = ()

    def partitions(self, spec: TableSpec, layer: str) -> list[str]:
        columns = spec.gold_partitions if layer == "gold" else spec.partitions
        return [c for c in columns if c != spec.date_col or spec.name not in self.undated]

    def many_directories(self, spec: TableSpec) -> bool:
        """Whether a table has directories by date, so that its rows are best grouped first."""
        return spec.date_col is not None and spec.name not in self.undated

    def path(self, layer: str, table: str) -> str:
        folder = SPECS[table].folder if table in SPECS else table
        return f"{self.root.rstrip('/')}/{layer}/{folder}"

    def raw(self, table: str) -> str:
        return self.path("raw", table)

    def bronze(self, table: str) -> str:
        return self.path("bronze", table)

    def silver(self, table: str) -> str:
        return self.path("silver", table)

    def gold(self, table: str) -> str:
        return self.path("gold", table)

    def aggregate(self, table: str) -> str:
        return self.path("aggregates", table)

    def report(self, table: str) -> str:
        return self.path("report", table)
