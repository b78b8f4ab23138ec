"""Layer checks as data: one row per check with its value and status.

All counting checks of a table share one aggregate over the table; only the
duplicate-key check needs an exchange of its own. The same aggregates can be observed
while a table is written (``layer_metrics``), and read as checks afterwards.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stresslake.operators.cleaning import missing_columns
from stresslake.specs import FACTOR, TableSpec, spec_for

FAIL, WARN, PASS, INFO = "FAIL", "WARN", "PASS", "INFO"
CHECK_COLUMNS = ["layer", "table_name", "check_name", "value", "status"]


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column: name, position and number of NULLs, from one pass."""
    one_row = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_{i}")
                       for i, c in enumerate(df.columns)])
    rows = [
        F.struct(
            F.lit(c).alias("column_name"), F.lit(i).alias("position"),
            F.col(f"_{i}").alias("null_count"),
        )
        for i, c in enumerate(df.columns)
    ]
    return one_row.select(F.inline(F.array(*rows)))


def key_counts(df: DataFrame, *key: str) -> DataFrame:
    """Rows per key value; a NULL key is one group."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count"))


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    """Number of key values that occur more than once."""
    repeated = key_counts(df, *key).where("row_count > 1")
    return repeated.agg(F.count(F.lit(1)).alias("duplicate_keys"))


def _checks(one_row: DataFrame, layer: str, table: str, checks) -> DataFrame:
    """Turn one row of counts into check rows. ``checks``: name, value, bad status."""
    rows = [
        F.struct(
            F.lit(layer).alias("layer"),
            F.lit(table).alias("table_name"),
            F.lit(name).alias("check_name"),
            value.cast("bigint").alias("value"),
            status.alias("status"),
        )
        for name, value, status in checks
    ]
    return one_row.select(F.inline(F.array(*rows)))


def _zero_or(value: Column, status: str) -> Column:
    return F.when(value == 0, PASS).otherwise(status)


def validate_bronze(df: DataFrame, table: str | TableSpec) -> DataFrame:
    """Bronze: the table has rows, and the required columns exist."""
    spec = spec_for(table)
    absent = missing_columns(df, spec.required)
    rows, absent_count = F.col("row_count"), F.lit(len(absent))
    return _checks(count_rows(df), "bronze", spec.name, [
        ("row_count", rows, F.when(rows > 0, PASS).otherwise(FAIL)),
        ("missing_columns", absent_count, _zero_or(absent_count, FAIL)),
    ])


def validate_silver(df: DataFrame, table: str | TableSpec, key: tuple[str, ...] = ()) -> DataFrame:
    """Silver: NULLs per column, non-positive rates, repeated keys.

    Columns without NULLs are summed up in ``null_columns``, the number of columns
    that have some; each of those also gets its own row.
    """
    spec = spec_for(table)
    counts = {c: F.count_if(F.col(f"`{c}`").isNull()).alias(f"_null_{i}")
              for i, c in enumerate(df.columns)}
    extra = []
    if "fx_rate_to_usd" in df.columns:
        extra.append(F.count_if(F.col("fx_rate_to_usd") <= 0).alias("_bad_rate"))
    one_row = df.agg(F.count(F.lit(1)).alias("row_count"), *counts.values(), *extra)
    nulls = [(c, F.col(f"_null_{i}")) for i, c in enumerate(df.columns)]
    with_nulls = sum((F.when(n > 0, 1).otherwise(0) for _, n in nulls), F.lit(0))
    checks = [
        ("row_count", F.col("row_count"), F.lit(INFO)),
        ("null_columns", with_nulls, _zero_or(with_nulls, WARN)),
        *[(f"nulls:{c}", n, _zero_or(n, WARN)) for c, n in nulls],
    ]
    if extra:
        checks.append(("non_positive_rate", F.col("_bad_rate"), _zero_or(F.col("_bad_rate"), FAIL)))
    found = _checks(one_row, "silver", spec.name, checks).where(
        ~F.col("check_name").startswith("nulls:") | (F.col("value") > 0)
    )
    keys = key_checks(df, spec, key)
    return found if keys is None else found.unionByName(keys)


def key_checks(df: DataFrame, table: str | TableSpec, key: tuple[str, ...] = ()) -> DataFrame | None:
    """The check for repeated keys of a silver table; ``None`` if it lacks a key column."""
    spec = spec_for(table)
    key = key or spec.key
    if missing_columns(df, key):
        return None
    repeated = F.col("duplicate_keys")
    return _checks(duplicate_keys(df, *key), "silver", spec.name, [
        ("duplicate_keys", repeated, _zero_or(repeated, WARN)),
    ])


def _gold_rules() -> dict[str, tuple[str, Column, str]]:
    """Column, condition and bad status by check name."""
    return {
        "non_positive_factor": (FACTOR, F.col(FACTOR) <= 0, FAIL),
        "negative_stressed_amount": (
            "stressed_transaction_amount", F.col("stressed_transaction_amount") < 0, WARN),
        "negative_liquidity": ("stressed_liquidity", F.col("stressed_liquidity") < 0, WARN),
    }


def validate_gold(df: DataFrame, table: str | TableSpec) -> DataFrame:
    """Gold: positive factors, and no negative stressed amounts or liquidity."""
    spec = spec_for(table)
    held = {n: r for n, r in _gold_rules().items() if r[0] in df.columns}
    one_row = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(bad).alias(f"_{n}") for n, (_, bad, _s) in held.items()],
    )
    return _checks(one_row, "gold", spec.name, [
        ("row_count", F.col("row_count"), F.lit(INFO)),
        *[(n, F.col(f"_{n}"), _zero_or(F.col(f"_{n}"), s)) for n, (_, _b, s) in held.items()],
    ])


def validate(df: DataFrame, layer: str, table: str | TableSpec) -> DataFrame:
    """Checks of one table in one layer."""
    by_layer = {"bronze": validate_bronze, "silver": validate_silver, "gold": validate_gold}
    if layer not in by_layer:
        raise ValueError(f"unknown layer {layer!r}")
    return by_layer[layer](df, table)


# --- checks observed during a write ---------------------------------------------


def layer_metrics(df: DataFrame, layer: str, table: str | TableSpec) -> dict[str, Column]:
    """Aggregates behind the counting checks of a layer, for ``DataFrame.observe``."""
    metrics = {"row_count": F.count(F.lit(1))}
    if layer == "silver":
        metrics |= {f"nulls:{c}": F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns}
        if "fx_rate_to_usd" in df.columns:
            metrics["non_positive_rate"] = F.count_if(F.col("fx_rate_to_usd") <= 0)
    if layer == "gold":
        metrics |= {n: F.count_if(bad) for n, (c, bad, _) in _gold_rules().items() if c in df.columns}
    return metrics


def checks_of(
    values: Mapping[str, int], layer: str, table: str | TableSpec, columns: list[str]
) -> Iterator[tuple[str, str, str, int, str]]:
    """Check rows from observed values, as the validators give them for the same table."""
    spec, rows = spec_for(table), values["row_count"]

    def row(name: str, value: int, bad: str) -> tuple[str, str, str, int, str]:
        return layer, spec.name, name, value, bad if value else PASS

    if layer == "bronze":
        yield layer, spec.name, "row_count", rows, PASS if rows else FAIL
        absent = [c for c in spec.required if c not in columns]
        yield row("missing_columns", len(absent), FAIL)
        return
    yield layer, spec.name, "row_count", rows, INFO
    if layer == "silver":
        nulls = {n: v for n, v in values.items() if n.startswith("nulls:") and v}
        yield row("null_columns", len(nulls), WARN)
        yield from (row(n, v, WARN) for n, v in nulls.items())
        if "non_positive_rate" in values:
            yield row("non_positive_rate", values["non_positive_rate"], FAIL)
    if layer == "gold":
        yield from (row(n, values[n], bad) for n, (_, _, bad) in _gold_rules().items() if n in values)


def check_frame(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    """Check rows as a frame."""
    return spark.createDataFrame(
        list(rows), "layer string, table_name string, check_name string, value bigint, status string"
    )
