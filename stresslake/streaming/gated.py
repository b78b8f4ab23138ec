"""Near-real-time bronze behind the quality gate.

A file stream tells which drops have arrived. Every micro-batch judges its drops with the
same profile as a batch run: a drop that passes goes to bronze, one that fails goes to
quarantine with its issues, and one that its writer has not finished waits for the next
batch. What happened to each drop stands in a log.

A drop is written below a directory of its own (``load_id=<drop>``) that a write replaces
as a whole, and the log entry follows the data. A batch that is run again after a crash
therefore leaves the same files, and a drop that the log knows is not taken twice.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stresslake.operators.cleaning import to_bronze
from stresslake.plans.medallion import REFUSED, WRITTEN, quality_gate
from stresslake.sources import readers, writers
from stresslake.specs import Layout, spec_for

LOAD = "load_id"
WAITING = "waiting"
_FILE = "path string, modificationTime timestamp, length bigint, content binary"
_LOG = "batch bigint, load_id string, status string, rows bigint, note string"


def bronze_path(layout: Layout, table: str) -> str:
    return layout.path("streamed", table)


def quarantine_path(layout: Layout, table: str) -> str:
    return layout.path("quarantine", table)


def log_path(layout: Layout, table: str) -> str:
    return layout.path("load_log", table)


def load_log(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    """The last entry of each drop: load_id, status, rows and note."""
    log = readers.read_if_exists(spark, log_path(layout, table), "parquet", _LOG)
    if log is None:
        log = spark.createDataFrame([], _LOG)
    last = F.max(F.struct("batch", "status", "rows", "note")).alias("e")
    return log.groupBy(LOAD).agg(last).select(LOAD, "e.status", "e.rows", "e.note")


def streamed_bronze(spark: SparkSession, layout: Layout, table: str) -> DataFrame | None:
    """All accepted rows, with the drop that each came from."""
    return readers.read_if_exists(spark, bronze_path(layout, table))


def quarantined(spark: SparkSession, layout: Layout, table: str) -> DataFrame | None:
    """All refused rows as text, with the drop that each came from."""
    return readers.read_if_exists(spark, quarantine_path(layout, table), "parquet")


def _drop_name(folder: str):
    """Name of the drop that a file belongs to: the entry of ``folder`` above it."""
    below = F.substring_index(F.col("_metadata.file_path"), f"/{folder.rstrip('/').rsplit('/', 1)[-1]}/", -1)
    return F.substring_index(F.url_decode(below), "/", 1)


def _take(
    spark: SparkSession, layout: Layout, table: str, name: str, as_of: str | None, key: tuple[str, ...]
) -> tuple[str, int | None, str]:
    """Judge and write one drop; status, rows and note."""
    spec = spec_for(table)
    path = f"{layout.raw(table)}/{name}"
    if not readers.is_finished(spark, path):
        return WAITING, None, "not finished"
    accepted, issues = quality_gate(spark, path, spec, as_of=as_of, key=key)
    load = F.lit(name).alias(LOAD)
    seen = Observation(f"load {name}")
    if not accepted:
        text = readers.read_text_columns(spark, path).select(load, "*")
        writers.write_partitioned(
            text.observe(seen, F.count(F.lit(1)).alias("rows")), quarantine_path(layout, table), [LOAD],
            "parquet", rebalance=False, touched_only=True,
        )
        return REFUSED, seen.get["rows"], issues
    rows = to_bronze(readers.read_raw_csv(spark, path, spec), spec, as_of).select(load, "*")
    writers.write_partitioned(
        rows.observe(seen, F.count(F.lit(1)).alias("rows")), bronze_path(layout, table),
        [LOAD, *layout.partitions(spec, "bronze")], rebalance=layout.many_directories(spec), touched_only=True,
    )
    return WRITTEN, seen.get["rows"], ""


def _judge(
    batch: DataFrame, number: int, layout: Layout, table: str, as_of: str | None, key: tuple[str, ...]
) -> None:
    """One micro-batch. The names of its drops are few: ``max_files`` bounds the files."""
    spark = batch.sparkSession
    arrived = {r[0] for r in batch.select("drop").distinct().collect()}
    log = readers.read_if_exists(spark, log_path(layout, table), "parquet", _LOG)
    # Entries of this very batch are from a run that did not finish; they are replaced.
    past = [] if log is None else log.where(F.col("batch") < number).select(LOAD, "status").distinct().collect()
    done = {r[0] for r in past if r[1] != WAITING}
    waiting = {r[0] for r in past if r[1] == WAITING}
    entries = [
        (number, name, *_take(spark, layout, table, name, as_of, key))
        for name in sorted((arrived | waiting) - done)
    ]
    if entries:
        frame = spark.createDataFrame(entries, _LOG).coalesce(1)
        writers.write_partitioned(
            frame, log_path(layout, table), ["batch"], "parquet", rebalance=False, touched_only=True
        )


def stream_gated(
    spark: SparkSession, layout: Layout, table: str, as_of: str | None = None,
    key: tuple[str, ...] = (), max_files: int = 1000,
) -> StreamingQuery:
    """Take all drops that are new since the last run through the gate, then stop.

    Drops are ``.csv`` files or finished ``.csv`` directories in the raw folder of the
    table. Directories named there by the time they are seen unfinished wait, and are
    looked at again in the next batch that brings a file. ``key`` replaces the table's key
    in the gate. A restarted run goes on from its checkpoint.
    """
    folder = layout.raw(spec_for(table).name)
    # A row per file that holds anything; contents are not selected and so not read.
    arrivals = (
        spark.readStream.format("binaryFile").schema(_FILE).option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv").option("maxFilesPerTrigger", max_files).load(folder)
        .where("length > 0").select(_drop_name(folder).alias("drop"))
    )
    judge = functools.partial(_judge, layout=layout, table=table, as_of=as_of, key=key)
    return (
        arrivals.writeStream.foreachBatch(judge)
        .option("checkpointLocation", layout.path("checkpoints", f"gated_{table}"))
        .trigger(availableNow=True).start()
    )
