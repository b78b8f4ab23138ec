"""Writing layer tables, raw drops and report extracts.

Overwrites go through the writer's own commit; nothing is deleted beforehand, so
a failed write does not cost the previous version.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stresslake.operators.cleaning import require_columns
from stresslake.sources.readers import table_format

MAX_RECORDS_PER_FILE = 5_000_000
# Directories that a task writes to at once; rows of further ones are sorted by directory.
OPEN_FILES = 64
# Tasks per core in which rows are sorted, at most.
RUNS_PER_CORE = 2
# Row groups are small, since a task buffers one per open file. Whole numbers are written as
# differences, and pages are bounded by their bytes, not by 20,000 rows.
PARQUET = {
    "compression": "zstd", "parquet.block.size": 16 << 20,
    "parquet.writer.version": "PARQUET_2_0", "parquet.page.row.count.limit": 200_000,
}


@contextmanager
def _open_files(spark: SparkSession, number: int) -> Iterator[None]:
    """Writes in this block keep that many files open per task instead of sorting the rows."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, number)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _parquet(df: DataFrame) -> dict[str, object]:
    """Options of a Parquet write; dictionaries of amounts would be about as large as the amounts."""
    amounts = [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)]
    return PARQUET | {f"parquet.enable.dictionary#{name}": "false" for name in amounts}


def write_partitioned(
    df: DataFrame, path: str, partitions: Sequence[str] = (), fmt: str | None = None,
    rebalance: bool = True, touched_only: bool = False, order: Sequence[str] = (),
) -> None:
    """Overwrite a table, partitioned by the given columns.

    ``touched_only`` replaces the directories that the rows belong to and leaves others.
    ``order`` are columns by which a task sorts its rows where they are not rebalanced, so
    that columns which rise together take less room, there and in what is read from there.

    Rebalancing on the partition columns keeps the number of files per directory
    low where directories are many, and adaptive execution cuts a large partition into
    several tasks. Without it rows are written where they are: a task keeps a file open
    for each directory, so rows are neither exchanged nor sorted.
    """
    columns = list(partitions)
    require_columns(df, columns, f"write {path}")
    rebalance = rebalance and bool(columns)
    out = df.hint("rebalance", *columns) if rebalance else df
    if order and not rebalance:
        # The longer the sorted runs, the smaller the steps in them.
        tasks = RUNS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism
        out = df.coalesce(tasks).sortWithinPartitions(*order)
    fmt = fmt or table_format(df.sparkSession)
    writer = out.write.mode("overwrite").format(fmt).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    if fmt == "parquet":
        writer = writer.options(**_parquet(df))
    if touched_only:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    with _open_files(df.sparkSession, 0 if rebalance else OPEN_FILES):
        (writer.partitionBy(*columns) if columns else writer).save(path)


def write_unpartitioned(df: DataFrame, path: str, fmt: str | None = "parquet") -> None:
    write_partitioned(df, path, (), fmt)


def write_csv_drop(df: DataFrame, folder: str, table: str, stamp: str) -> str:
    """A raw drop ``<folder>/<table>_<stamp>.csv`` with header; returns its path."""
    path = f"{folder.rstrip('/')}/{table}_{stamp}.csv"
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def export_report(df: DataFrame, path: str, single_file: bool) -> None:
    """Parquet extract for reporting. Only aggregates should ask for a single file."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).options(**_parquet(df)).parquet(path)


def scratch_root(spark: SparkSession) -> str:
    """A fresh folder for intermediate tables.

    It lies in the shared folder that the session names for checkpoints, so that
    all executors see it. Only a session on one machine may go without: it gets a
    temporary folder there. On a cluster that would be no shared place, so it raises.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return f"{shared.rstrip('/')}/stresslake-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="stresslake-")
