"""Helpers that several operators share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = 1_000
# White space as the contracts define it: blank and the controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Settings that the Python side of a query needs.

    Workers find this package where the driver has it; clusters whose machines lack
    that folder ship it as usual (``--py-files``). Batches to the workers hold few rows,
    because one text may be very long: memory is bounded by rows times text length.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of the session.

    Only a session on one machine may go without and gets a temporary folder; on a
    cluster that would be no shared place, so it raises.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not folder:
        folder = getattr(scratch_dir, "own", None) or tempfile.mkdtemp(prefix="llm-")
        scratch_dir.own = folder
    return folder.rstrip("/")


def materialize(df: DataFrame, **options: int) -> DataFrame:
    """Write a table to the shared folder and read it again; ``options`` are the writer's.

    This cuts the lineage: executors lost later do not bring back the work above.
    The files stay until the owner of the shared folder clears it.
    """
    path = f"{scratch_dir(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.options(compression="zstd", **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from: crc32 of the id as text leaves 2 on division by 4.

    A NULL id counts as the empty text (remainder 0), so it is never held out.
    """
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def smallest_hashes(rows: DataFrame, name: str, bound: int, count: int) -> DataFrame:
    """At most ``bound`` of ``count`` rows, those with the smallest value of a 64-bit hash.

    A first cut of the hash's range leaves about twice the rows wanted, however many
    there are, so the sort behind it stays small in every task. Rows that share a hash
    should have been folded.
    """
    share = min(1.0, (2 * bound + 100) / max(count, 1))
    cut = min((1 << 63) - 1, -(1 << 63) + int(share * (1 << 64)))
    return rows.where(F.col(name) <= F.lit(cut)).orderBy(name).limit(bound)


def word_count(text: Column) -> Column:
    """Number of words; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


# Elements that one step of a scan collects before they are set aside.
SCAN_CHUNK = 256


def scan_array(items: Column, carry: Column, step, element: str) -> Column:
    """Running fold over an array that keeps an element per item.

    ``step(carry, item)`` gives the next carry and the element, of type ``element``.
    Elements are collected in chunks, so the cost grows in proportion to the array;
    appending to one array would copy it at every item.
    """
    nothing = F.array().cast(f"array<{element}>")

    def inner(state: Column, item: Column) -> Column:
        after, made = step(state["carry"], item)
        return F.struct(after.alias("carry"), F.concat(state["out"], F.array(made)).alias("out"))

    def whole(held: Column) -> Column:
        def outer(state: Column, k: Column) -> Column:
            part = F.slice(held, k * SCAN_CHUNK + 1, F.lit(SCAN_CHUNK))
            begin = F.struct(state["carry"].alias("carry"), nothing.alias("out"))
            return F.aggregate(part, begin, inner, lambda s: F.struct(
                s["carry"].alias("carry"), F.concat(state["out"], F.array(s["out"])).alias("out")))

        chunks = F.sequence(F.lit(0), F.greatest(F.floor((F.size(held) - 1) / SCAN_CHUNK).cast("int"), F.lit(0)))
        empty = F.array().cast(f"array<array<{element}>>")
        begin = F.struct(carry.alias("carry"), empty.alias("out"))
        return F.aggregate(chunks, begin, outer, lambda s: F.flatten(s["out"]))

    # A variable of the lambda, so that the array is computed once and not per chunk.
    return F.transform(F.array(items), whole)[0]
