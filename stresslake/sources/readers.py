"""Reading raw drops and layer tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stresslake.functions.columns import as_date, as_number, as_timestamp
from stresslake.specs import REGION, TableSpec, spec_for

# Text that a typed CSV reader takes as "no value".
NULL_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def table_format(spark: SparkSession) -> str:
    """``delta`` where the session has its extension, else ``parquet``."""
    return "delta" if "delta" in spark.conf.get("spark.sql.extensions", "").lower() else "parquet"


def read_table(
    spark: SparkSession, path: str, fmt: str | None = None, schema: T.StructType | str | None = None
) -> DataFrame:
    """A layer table.

    Types of partition columns are guessed from directory names, which would turn a
    region ``01`` into a number. Regions are therefore always read as text.
    """
    reader = spark.read.format(fmt or table_format(spark))
    if schema is not None:
        return reader.schema(schema).load(path)
    df = reader.load(path)
    if REGION not in df.columns or df.schema[REGION].dataType == T.StringType():
        return df
    kept = [T.StructField(REGION, T.StringType()) if f.name == REGION else f for f in df.schema]
    return reader.schema(T.StructType(kept)).load(path)


def read_if_exists(
    spark: SparkSession, path: str, fmt: str | None = None, schema: T.StructType | str | None = None
) -> DataFrame | None:
    """A layer table, or ``None`` if the path holds no data."""
    try:
        return read_table(spark, path, fmt, schema)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def is_finished(spark: SparkSession, path: str) -> bool:
    """Whether a drop is a file, or a directory whose writer has finished (``_SUCCESS``)."""
    jvm = spark.sparkContext._jvm
    drop = jvm.org.apache.hadoop.fs.Path(path)
    files = drop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(drop):
        return False
    return not files.getFileStatus(drop).isDirectory() or files.exists(
        jvm.org.apache.hadoop.fs.Path(drop, "_SUCCESS")
    )


def latest_snapshot(spark: SparkSession, folder: str, prefix: str = "") -> str | None:
    """Newest CSV drop in a folder, or ``None`` if there is none.

    A drop is an entry of the folder itself: a ``.csv`` file, or a ``.csv`` directory
    that its writer has finished (it holds ``_SUCCESS``). Drops are compared by
    modification time, then by name. With ``prefix`` only names such as
    ``<prefix>_20260702.csv`` count.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        return None
    drops = []
    for entry in files.listStatus(path):
        name = entry.getPath().getName()
        if not name.endswith(".csv") or (prefix and not name.startswith(f"{prefix}_")):
            continue
        changed = entry.getModificationTime()
        if entry.isDirectory():
            done = jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS")
            if not files.exists(done):
                continue
            changed = files.getFileStatus(done).getModificationTime()
        drops.append((changed, name))
    return f"{folder.rstrip('/')}/{max(drops)[1]}" if drops else None


def read_text_columns(spark: SparkSession, path: str) -> DataFrame:
    """CSV with every column as text, "no value" words as NULL: input of the profile."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return raw.select([
        F.when(~F.col(f"`{c}`").isin(*NULL_WORDS), F.col(f"`{c}`")).alias(c) for c in raw.columns
    ])


def apply_types(df: DataFrame, table: str | TableSpec) -> DataFrame:
    """Give text columns their registry types by name; bad text becomes NULL.

    Missing columns stay missing and unknown ones stay text, so a drop with
    another column order or extra columns still loads.
    """
    kinds = spec_for(table).columns
    text = T.StringType()

    def typed(name: str):
        col = F.col(f"`{name}`")
        kind = kinds.get(name.strip().lower().replace(" ", "_"), "string")
        if kind == "float":
            return as_number(col)
        if kind == "int":
            return F.trim(col).try_cast("int")
        if kind == "date":
            return as_date(col, text)
        if kind == "datetime":
            return as_timestamp(col)
        return col

    return df.select([typed(c).alias(c) for c in df.columns])


def read_raw_csv(
    spark: SparkSession, path: str, table: str | TableSpec | None = None
) -> DataFrame:
    """CSV with header. With ``table`` the types come from the registry and the file
    is read once; without it Spark infers them with an extra pass."""
    if table is None:
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    return apply_types(spark.read.option("header", True).csv(path), table)
