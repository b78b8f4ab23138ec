"""Values that hold for a time: as-of rates and scenarios with a validity.

An as-of join gives a row the newest value that is not later than the row's own time.
Only the distinct (key, time) pairs of the rows take part in the search, so a frequent
currency or day reaches it as one row. The search runs in buckets of time: within a
bucket by a running last value, and into it comes the last value of all buckets before.
A key with a long history is thus cut over many tasks; what runs over a whole key is one
row per bucket.

An interval join gives a row every entry that is valid on its date. Entries are unfolded
over the months that the rows have, and rows meet them by month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stresslake.functions.columns import one_of_type
from stresslake.operators.cleaning import default_column, require_columns
from stresslake.specs import BASE_CURRENCY, CURRENCY, FACTOR, RATE, SCENARIO, TableSpec, spec_for

AS_OF = "rate_as_of"


def asof_lookup(
    moments: DataFrame, history: DataFrame, key: str, time: str, value: str, bucket: str = "month"
) -> DataFrame:
    """Per distinct (key, time) of ``moments`` the newest value of ``history`` not later.

    ``moments`` has ``key`` and ``time``, ``history`` also ``value``; times of both have
    one type. Of several values at one time the largest counts. Returns key, time, value
    and ``as_of``, the time of the value; both are NULL before a key's first value. Rows
    with a NULL key, time or value do not take part. ``bucket`` is a unit of ``date_trunc``
    that holds a moderate number of distinct times per key.
    """
    value_type, time_type = history.schema[value].dataType, history.schema[time].dataType
    asked = moments.select(
        F.col(key).alias("k"), F.col(time).alias("t"), F.lit(None).cast(value_type).alias("v"), F.lit(True).alias("asked")
    )
    known = history.where(F.col(value).isNotNull()).select(
        F.col(key).alias("k"), F.col(time).alias("t"), F.col(value).alias("v"), F.lit(False).alias("asked")
    )
    # One row per key and time: folds repeated moments and ties at once, on the map side.
    points = (
        asked.unionByName(known).where("k IS NOT NULL AND t IS NOT NULL")
        .groupBy("k", "t").agg(F.max("v").alias("v"), F.max("asked").alias("asked"))
        .withColumn("b", F.date_trunc(bucket, F.col("t").cast("timestamp")))
    )
    mark = F.when(F.col("v").isNotNull(), F.struct("t", "v"))
    ends = points.groupBy("k", "b").agg(F.max(mark).alias("end"))
    earlier = W.partitionBy("k").orderBy("b").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select("k", "b", F.last("end", ignorenulls=True).over(earlier).alias("carry"))
    within = W.partitionBy("k", "b").orderBy("t").rowsBetween(W.unboundedPreceding, W.currentRow)
    found = points.withColumn("own", F.last(mark, ignorenulls=True).over(within))
    best = F.coalesce("own", "carry")
    return found.join(carried, ["k", "b"]).where("asked").select(
        F.col("k").alias(key), F.col("t").cast(time_type).alias(time),
        best["v"].alias(value), best["t"].alias("as_of"),
    )


def asof_rates(
    df: DataFrame, history: DataFrame, time: str, bucket: str = "month",
    rate: str = "fx_rate_to_usd", rate_time: str = "as_of_timestamp",
) -> DataFrame:
    """Rows with the rate of their currency as of their own ``time``.

    Adds the rate, and the time it is from. Rows before the first rate of their
    currency, and rows without a currency or time, get rate 1 and no time. A missing
    currency column counts as the base currency. Codes have to match exactly.

    The rows meet the looked-up pairs by currency and time, so a frequent currency is
    spread, and adaptive execution splits a frequent pair.
    """
    df = default_column(df, CURRENCY, BASE_CURRENCY)
    time_type = df.schema[time].dataType
    past = history.select(
        F.col(CURRENCY), F.col(rate_time).cast(time_type).alias(time), F.col(rate).alias(RATE)
    )
    found = asof_lookup(df.select(CURRENCY, time), past, CURRENCY, time, RATE, bucket)
    found = found.withColumnRenamed("as_of", AS_OF)
    one = one_of_type(1, found.schema[RATE].dataType)
    return df.join(found, [CURRENCY, time], "left").withColumn(RATE, F.coalesce(RATE, one))


def convert_amounts_asof(
    df: DataFrame, table: str | TableSpec, history: DataFrame, time: str | None = None, bucket: str = "month"
) -> DataFrame:
    """``<amount>_usd`` for the table's money columns at the rate of each row's own date.

    ``time`` is the table's date column unless named.
    """
    spec = spec_for(table)
    time = time or spec.date_col
    require_columns(df, [time], f"as-of rates for {spec.name}")
    rated = asof_rates(df, history, time, bucket)
    return rated.withColumns({f"{c}_usd": F.col(c) * F.col(RATE) for c in spec.amounts if c in df.columns})


def _month(date: Column) -> Column:
    return F.trunc(date, "month")


def join_valid(
    df: DataFrame, entries: DataFrame, date: str, start: str = "effective_date", end: str = "expiry_date"
) -> DataFrame:
    """Rows with every entry valid on their date (``start`` inclusive, ``end`` exclusive).

    A NULL start or end leaves a validity open. Entries may overlap: a row comes once
    per entry that is valid, and not at all where none is. Rows without a date match
    nothing, and entries whose end is not after their start never hold. The columns of
    ``df`` come first, then those of ``entries`` without ``start`` and ``end``.

    Rows and entries meet by month. Entries are unfolded over the months that rows have,
    which bounds open validities; that set of months is a scalar subquery.
    """
    other = [c for c in entries.columns if c not in (start, end)]
    clash = sorted(set(other) & set(df.columns))
    if clash:
        raise ValueError(f"columns on both sides: {clash}")
    months = df.agg(F.array_sort(F.collect_set(_month(F.col(date)))).alias("m"))
    first, last = F.col("e").getField(start), F.col("e").getField(end)
    packed = entries.select(
        F.struct(*[F.col(f"`{c}`") for c in entries.columns]).alias("e"), months.scalar().alias("months")
    )
    met = F.filter("months", lambda m: (
        F.coalesce(m >= _month(first), F.lit(True)) & F.coalesce(m < last, F.lit(True))
    ))
    unfolded = packed.select("e", F.explode(met).alias("month"))
    own = F.col("d").getField(date)
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("d"))
    valid = F.coalesce(first <= own, F.lit(True)) & F.coalesce(own < last, F.lit(True))
    return rows.join(unfolded, (_month(own) == F.col("month")) & valid).select(
        *[F.col("d").getField(c).alias(c) for c in df.columns],
        *[F.col("e").getField(c).alias(c) for c in other],
    )


def expand_valid_scenarios(df: DataFrame, scenarios: DataFrame, date: str) -> DataFrame:
    """Every row once per scenario that is valid on its ``date``, with id and factor."""
    needed = [SCENARIO, FACTOR, "effective_date", "expiry_date"]
    return join_valid(df, require_columns(scenarios, needed, "scenario").select(needed), date)
