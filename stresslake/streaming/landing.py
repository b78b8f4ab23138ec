"""Incremental bronze: raw CSV files are picked up as they arrive.

The same cleaning as the batch run is applied to a file stream. The checkpoint
remembers which files were taken, so a restarted run continues where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stresslake.operators.cleaning import to_bronze
from stresslake.sources.readers import apply_types, table_format
from stresslake.specs import Layout, TableSpec, spec_for


def raw_stream(spark: SparkSession, folder: str, table: str | TableSpec) -> DataFrame:
    """Rows of all files below ``folder``, typed by the registry.

    A stream has to know its columns beforehand: files follow the registry order.
    """
    columns = spec_for(table).columns
    text = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    files = (
        spark.readStream.schema(text)
        .option("header", True)
        .option("enforceSchema", False)
        .option("recursiveFileLookup", True)
        .csv(folder)
    )
    return apply_types(files, table)


def stream_to_bronze(
    spark: SparkSession, layout: Layout, table: str | TableSpec, as_of: str | None = None
) -> StreamingQuery:
    """Append all files that are new since the last run, then stop."""
    spec = spec_for(table)
    bronze = to_bronze(raw_stream(spark, layout.raw(spec.name), spec), spec, as_of)
    return (
        bronze.writeStream.format(table_format(spark))
        .partitionBy(*layout.partitions(spec, "bronze"))
        .option("checkpointLocation", layout.path("checkpoints", spec.name))
        .trigger(availableNow=True)
        .outputMode("append")
        .start(layout.bronze(spec.name))
    )
