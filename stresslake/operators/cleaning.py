"""Column back-fill, type repair, name normalisation and row de-duplication."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stresslake.functions.columns import as_date, as_number
from stresslake.specs import REGION, TableSpec, spec_for


def default_column(df: DataFrame, name: str, value) -> DataFrame:
    """Add ``name`` with a constant if the column is absent; NULLs stay NULL."""
    return df if name in df.columns else df.withColumn(name, F.lit(value))


def run_date(as_of: str | None = None) -> Column:
    """The load date: a fixed ISO date if given, else the current date."""
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def default_date(df: DataFrame, name: str, as_of: str | None = None) -> DataFrame:
    """Add a date column holding the load date if the column is absent."""
    return df if name in df.columns else df.withColumn(name, run_date(as_of))


def date_from_timestamp(df: DataFrame, source: str, target: str) -> DataFrame:
    return df.withColumn(target, as_date(F.col(source), df.schema[source].dataType))


def require_columns(df: DataFrame, names: list[str], what: str) -> DataFrame:
    """Fail while the plan is built if columns are missing; no job is run."""
    absent = missing_columns(df, names)
    if absent:
        raise ValueError(f"{what}: missing {absent}; present: {df.columns}")
    return df


def missing_columns(df: DataFrame, names) -> list[str]:
    """Expected names that the frame lacks, in expected order."""
    present = set(df.columns)
    return [n for n in names if n not in present]


def normalize_names(df: DataFrame) -> DataFrame:
    """Trim, lower-case and underscore all column names.

    Two names that become equal would be ambiguous downstream, so they raise.
    """
    names = [c.strip().lower().replace(" ", "_") for c in df.columns]
    clashes = sorted(n for n, k in Counter(names).items() if k > 1)
    if clashes:
        raise ValueError(f"column names collide after normalisation: {clashes}")
    return df.toDF(*names)


def ensure_numeric(df: DataFrame, name: str, default: float = 0.0) -> DataFrame:
    """Double column without NULLs; bad text, NULL and a missing column give ``default``."""
    if name not in df.columns:
        return df.withColumn(name, F.lit(float(default)))
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.NumericType):
        value = F.col(name).cast("double")
    elif isinstance(dtype, T.StringType):
        value = as_number(F.col(name))
    else:  # dates and the like hold no number
        value = F.lit(None).cast("double")
    return df.withColumn(name, F.coalesce(value, F.lit(float(default))))


def ensure_string(df: DataFrame, name: str, default: str = "UNKNOWN") -> DataFrame:
    if name not in df.columns:
        return df.withColumn(name, F.lit(default))
    return df.withColumn(name, F.coalesce(F.col(name).cast("string"), F.lit(default)))


def ensure_date(df: DataFrame, name: str, as_of: str | None = None) -> DataFrame:
    """Date column; bad text gives NULL, a missing column gives the load date."""
    if name not in df.columns:
        return df.withColumn(name, run_date(as_of))
    return df.withColumn(name, as_date(F.col(name), df.schema[name].dataType))


_HASHED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)


def _row_hash(df: DataFrame) -> Column:
    """A hash that equal rows share; it leaves NULLs out, so flags tell where they are.

    Columns of other types than plain values do not take part.
    """
    columns = [
        F.col(f"`{f.name}`") for f in df.schema
        if isinstance(f.dataType, _HASHED) or f.dataType == T.StringType()
    ]
    return F.xxhash64(F.lit(0), *columns, *[c.isNull() for c in columns])


def repeated_rows(df: DataFrame) -> DataFrame:
    """Hashes that more than one row has: those of all copies, and chance hits."""
    hashes = df.select(_row_hash(df).alias("_hash"))
    return hashes.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_hash")


def dedup_rows(df: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """Drop whole-row copies.

    Grouping by every column is combined on the map side first, so a large group
    of copies reaches its reducer as one row per map task. With the ``repeated_rows`` of
    the frame only rows of such a hash are grouped; all others stay in their place.
    """
    if repeated is None:
        return df.dropDuplicates()
    hashed = df.withColumn("_hash", _row_hash(df))
    once = hashed.join(repeated, "_hash", "left_anti").drop("_hash")
    again = hashed.join(repeated, "_hash", "left_semi").drop("_hash")
    return once.unionByName(again.dropDuplicates())


def to_bronze(df: DataFrame, table: str | TableSpec, as_of: str | None = None) -> DataFrame:
    """Raw drop to bronze: back-fill region and date, check the partition columns."""
    spec = spec_for(table)
    if spec.has_region:
        df = default_column(df, REGION, "UNKNOWN")
    if spec.date_from and spec.date_from in df.columns:
        df = date_from_timestamp(df, spec.date_from, spec.date_col)
    elif spec.date_col:
        df = default_date(df, spec.date_col, as_of)
    return require_columns(df, spec.partitions, f"bronze {spec.name}")
