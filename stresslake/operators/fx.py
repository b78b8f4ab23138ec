"""Currency conversion.

A rate says what one unit of the currency is worth in the base currency
(quote -> base). A feed quoted the other way round has to say so with
``direction="base_to_quote"`` and is inverted once, when rates are resolved.
"""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stresslake.functions.columns import literal_frame, one_of_type
from stresslake.operators.cleaning import (
    default_column, dedup_rows, ensure_date, normalize_names, require_columns,
)
from stresslake.specs import BASE_CURRENCY, CURRENCY, FALLBACK_RATES, RATE, TableSpec, spec_for

_REPEATED = "rates hold a currency more than once; rows would multiply"
_CLASH = "live rates differ for codes that are equal but for their case"

Rates = Mapping[str, object] | DataFrame


def _known(rate: object) -> Decimal | None:
    """The rate as a decimal; missing and non-finite rates are no rate."""
    value = None if rate is None else Decimal(str(rate))
    return value if value is not None and value.is_finite() else None


def rate_type_of(rates: Mapping[str, object]) -> str:
    """Double, or the decimal type that holds all rates if they are ``Decimal``.

    Rates that are all missing count as doubles.
    """
    known = [r for r in rates.values() if _known(r) is not None]
    if not known or not all(isinstance(r, Decimal) for r in known):
        return "double"
    scale = max(6, *(-r.as_tuple().exponent for r in known))
    whole = max(6, *(r.adjusted() + 1 for r in known))
    return f"decimal({whole + scale},{scale})"


def rates_frame(
    spark: SparkSession, rates: Mapping[str, object] = FALLBACK_RATES, rate_type: str | None = None
) -> DataFrame:
    """Mapping of currency to rate as a two-column frame.

    Rates are doubles unless all of them are ``Decimal``; then they stay exact.
    """
    rate_type = rate_type or rate_type_of(rates)
    literal = F.array(*[
        F.struct(
            F.lit(code).alias(CURRENCY),
            F.lit(_known(rate)).cast(rate_type).alias(RATE),
        )
        for code, rate in rates.items()
    ]).cast(f"array<struct<{CURRENCY}:string,{RATE}:{rate_type}>>")
    return literal_frame(spark, literal)


def resolve_rates(
    live: DataFrame | None,
    fallback: DataFrame,
    mode: str = "all_or_nothing",
    direction: str = "quote_to_base",
    source: str = "api",
    base: str = BASE_CURRENCY,
) -> DataFrame:
    """Choose between live and static rates.

    Live codes are upper-cased and the base currency is always present with rate
    1. ``all_or_nothing`` uses the static table when there is no live answer or a live
    rate cannot be read; ``per_currency`` fills the currencies that the live answer
    lacks or leaves without a rate. Rates keep the larger scale of both tables. Codes
    that differ in case only must agree on their rate.
    ``source="fallback"`` ignores the live answer.
    """
    if mode not in ("all_or_nothing", "per_currency"):
        raise ValueError(f"unknown mode {mode!r}")
    if direction not in ("quote_to_base", "base_to_quote"):
        raise ValueError(f"unknown direction {direction!r}")
    if source not in ("api", "fallback"):
        raise ValueError(f"unknown source {source!r}")
    if live is None or source == "fallback":
        return fallback

    rate_type = _common_type(live.schema[RATE].dataType, fallback.schema[RATE].dataType)
    rate = _no_nan(F.col(RATE), live.schema[RATE].dataType)
    if direction == "base_to_quote":
        rate = F.try_divide(F.lit(1).cast("decimal(12,6)"), rate)
    one = one_of_type(1, rate_type)
    value = rate.cast(rate_type)
    fallback = fallback.select(CURRENCY, F.col(RATE).cast(rate_type).alias(RATE))
    clash = F.min("_r") != F.max("_r")
    answered = (
        live.select(F.upper(CURRENCY).alias(CURRENCY), value.alias("_r"))
        # The base row is set below.
        .where(F.col(CURRENCY) != base)
        .groupBy(CURRENCY).agg(
            F.when(clash, F.raise_error(F.lit(_CLASH)).cast(rate_type)).otherwise(F.max("_r")).alias(RATE),
            F.bool_or(F.col("_r").isNull()).alias("_broken"),
        )
    )
    base_row = fallback.sparkSession.range(1).select(F.lit(base).alias(CURRENCY), one.alias(RATE))
    if mode == "per_currency":
        known = answered.where(F.col(RATE).isNotNull()).select(CURRENCY, RATE).unionByName(base_row)
        return known.unionByName(fallback.join(known.select(CURRENCY), CURRENCY, "left_anti"))
    # One rate that cannot be read spoils the whole answer.
    both = (
        answered.withColumn("_live", F.lit(True))
        .unionByName(base_row.select("*", F.lit(False).alias("_broken"), F.lit(True).alias("_live")))
        .unionByName(fallback.select("*", F.lit(False).alias("_broken"), F.lit(False).alias("_live")))
    )
    spoilt = F.bool_or("_broken").over(W.partitionBy())
    return both.withColumn("_spoilt", spoilt).where("_live <> _spoilt").select(CURRENCY, RATE)


def _common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """Decimal with room for both decimals, else double."""
    if not (isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType)):
        return T.DoubleType()
    scale = max(a.scale, b.scale)
    whole = max(a.precision - a.scale, b.precision - b.scale)
    return T.DecimalType(min(38, whole + scale), scale)


def _no_nan(rate: Column, dtype: T.DataType) -> Column:
    """A NaN is no rate."""
    return F.nanvl(rate, F.lit(None)) if isinstance(dtype, (T.DoubleType, T.FloatType)) else rate


def _one_per_currency(rates: DataFrame) -> DataFrame:
    """Rates by currency; reading one that is there twice fails the job."""
    dtype = rates.schema[RATE].dataType
    twice = F.count(F.lit(1)) > 1
    rate = F.when(twice, F.raise_error(F.lit(_REPEATED)).cast(dtype)).otherwise(F.max(RATE))
    known = rates.where(F.col(CURRENCY).isNotNull()).groupBy(CURRENCY).agg(rate.alias(RATE))
    return known.withColumn(RATE, _no_nan(F.col(RATE), dtype))


def attach_rates(df: DataFrame, rates: Rates) -> DataFrame:
    """Left join the rate of each row's currency; no rate means 1.

    The code has to match exactly. The join key moves to the front. Spark chooses the
    join by measured size, and adaptive execution splits the rows of a frequent
    currency. No job runs here.
    """
    df = default_column(df, CURRENCY, BASE_CURRENCY)
    if isinstance(rates, Mapping):
        side = rates_frame(df.sparkSession, rates)
    else:
        side = _one_per_currency(rates)
    joined = df.join(side, CURRENCY, "left")
    one = one_of_type(1, side.schema[RATE].dataType)
    return joined.withColumn(RATE, F.coalesce(F.col(RATE), one))


def convert_amounts(df: DataFrame, table: str | TableSpec, rates: Rates) -> DataFrame:
    """Add ``<amount>_usd`` for every money column of the table that is present."""
    present = [c for c in spec_for(table).amounts if c in df.columns]
    return attach_rates(df, rates).withColumns(
        {f"{c}_usd": F.col(c) * F.col(RATE) for c in present}
    )


def convert_to_base(
    amount: Column, currency: Column, rates: Mapping[str, object] = FALLBACK_RATES
) -> Column:
    """One amount in the base currency, any case of the code.

    A NULL or unknown currency leaves the amount as it is.
    """
    rate_type = rate_type_of(rates)
    pairs = [
        F.lit(x) for code, rate in rates.items() for x in (code.upper(), _known(rate))
    ]
    known = F.create_map(*pairs).cast(f"map<string,{rate_type}>")
    one = F.lit(1).cast(rate_type)
    return amount * F.coalesce(F.try_element_at(known, F.upper(currency)), one)


def to_silver(
    df: DataFrame, table: str | TableSpec, rates: Rates, as_of: str | None = None,
    repeated: DataFrame | None = None,
) -> DataFrame:
    """Bronze to silver: normalise names, drop copies, convert money, fix the date.

    ``repeated`` are the frame's ``repeated_rows``, if they are known.
    """
    spec = spec_for(table)
    if not spec.is_transformable:
        raise ValueError(f"{spec.name} has no silver layer")
    clean = dedup_rows(normalize_names(df), repeated)
    silver = ensure_date(convert_amounts(clean, spec, rates), spec.date_col, as_of)
    return require_columns(silver, spec.partitions, f"silver {spec.name}")


def latest_rates(fx_rates: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Newest stored rate per currency, optionally not later than ``as_of``.

    Of several rates at that time the largest counts. Rows without a time do not.
    """
    rows = fx_rates if as_of is None else fx_rates.where(F.col("as_of_timestamp") <= as_of)
    rows = rows.select(CURRENCY, "as_of_timestamp", "fx_rate_to_usd")
    newest = rows.groupBy(CURRENCY).agg(F.max("as_of_timestamp").alias("_newest"))
    newest = newest.withColumnRenamed(CURRENCY, "_code")
    same = F.col(CURRENCY).eqNullSafe(F.col("_code")) & (F.col("as_of_timestamp") == F.col("_newest"))
    # Plain maxima fold by hash; a maximum over pairs would sort the whole feed.
    return rows.join(newest, same).groupBy(CURRENCY).agg(F.max("fx_rate_to_usd").alias(RATE))


