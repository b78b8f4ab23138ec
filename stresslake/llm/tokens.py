"""Token counts of documents in flat token files, by a separator scan.

A flat token file is a stream of token ids in which each document ends with an
end-of-document id; nothing says where documents begin. It is read as a table of
blocks of fixed length (file, block, data), which know nothing of documents either.

A vectorised search finds the separators of each block. A prefix scan over the short
block summaries of a file (length, separators, place of the last one) gives each block
its offset, the number of documents ended before it and the end of the last of them,
so a document that spans blocks is put together without reading its tokens again.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stresslake.llm.common import materialize, read

RANKS_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END_OF_DOCUMENT = 50256
# Pattern that cuts texts before merging, as published with the vocabulary.
PATTERN = (
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Tokens of a block; two bytes each.
BLOCK_TOKENS = 1 << 16
# Blocks that one row of the reader stands for.
RANGE_BLOCKS = 64
TOKEN_TYPE = "<u2"


def _encoding(ranks: bytes):
    import tiktoken

    pairs = (line.split() for line in ranks.splitlines() if line)
    merges = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})


def write_flat(docs: DataFrame, ranks_path: str = RANKS_PATH) -> tuple[DataFrame, DataFrame]:
    """Tokenise documents into flat streams; returns the blocks and the order of documents.

    One stream per input partition, written to the shared folder as blocks (file,
    block, data). The second table (file, ordinal, doc_id) only names the documents of
    a stream in order; it holds no places. NULL texts count as empty. Text that spells
    a special token is ordinary text, so the separator never comes from a text.
    """
    with open(ranks_path, "rb") as file:
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"file int, block bigint, data binary, ordinal bigint, doc_id {id_type}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(ranks.value)
        file = TaskContext.get().partitionId()
        held = np.empty(0, TOKEN_TYPE)
        block = ordinal = 0
        ids_as = None

        def rows(blocks: list[bytes], ids: pa.Array) -> pa.RecordBatch:
            b, d = len(blocks), len(ids)
            return pa.RecordBatch.from_arrays([
                pa.array([file] * (b + d), pa.int32()),
                pa.array([*range(block, block + b), *[None] * d], pa.int64()),
                pa.array([*blocks, *[None] * d], pa.binary()),
                pa.array([*[None] * b, *range(ordinal, ordinal + d)], pa.int64()),
                pa.concat_arrays([pa.nulls(b, ids.type), ids]),
            ], names=["file", "block", "data", "ordinal", "doc_id"])

        for batch in batches:
            ids = batch.column("doc_id")
            ids_as = ids.type
            parts = [held]
            for text in batch.column("text").to_pylist():
                tokens = encoding.encode_ordinary(text) if text else []
                parts.append(np.array([*tokens, END_OF_DOCUMENT], TOKEN_TYPE))
            held = np.concatenate(parts)
            full = len(held) // BLOCK_TOKENS * BLOCK_TOKENS
            blocks = [held[i:i + BLOCK_TOKENS].tobytes() for i in range(0, full, BLOCK_TOKENS)]
            held = held[full:]
            yield rows(blocks, ids)
            block, ordinal = block + len(blocks), ordinal + len(ids)
        if len(held):
            yield rows([held.tobytes()], pa.nulls(0, ids_as))

    flat = materialize(docs.select("doc_id", "text").mapInArrow(run, schema))
    blocks = flat.where("data IS NOT NULL").select("file", "block", "data")
    return blocks, flat.where("data IS NULL").select("file", "ordinal", "doc_id")


def _uri(path: str) -> str:
    """Path as Spark lists it, in the form that Arrow's file systems read."""
    return f"file://{path.removeprefix('file:')}" if path.startswith("file:/") and not path.startswith("file:///") else path


def read_flat(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of raw token files (16-bit little-endian ids) under a path.

    Spark lists the files with their lengths only. Ranges of blocks are dealt to the
    tasks, and a task reads the bytes of its range through Arrow's file systems, a block
    at a time: a file of any size is read by many tasks and held by none. An odd byte at
    the end of a file raises an error; empty files have no blocks.
    """
    step = 2 * block_tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, first, length in zip(*(batch.column(c).to_pylist() for c in ("path", "first", "length")), strict=True):
                if length % 2:
                    raise ValueError(f"{name} does not hold whole tokens")
                source, inner = fs.FileSystem.from_uri(_uri(name))
                with source.open_input_file(inner) as file:
                    last = min(first + RANGE_BLOCKS, -(-length // step))
                    for number in range(first, last):
                        data = file.read_at(min(step, length - number * step), number * step)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name]), pa.array([number], pa.int64()), pa.array([data])],
                            names=["file", "block", "data"],
                        )

    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    last = F.floor((F.col("length") - 1) / step).cast("long")
    ranges = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(RANGE_BLOCKS).cast("long"))).alias("first"))
    spread = ranges.repartition(spark.sparkContext.defaultParallelism * 4, "path", "first")
    return spread.mapInArrow(run, "file string, block bigint, data binary")


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Length of each block and the places of its separators."""
    for batch in batches:
        tokens = [np.frombuffer(d.as_buffer(), TOKEN_TYPE) for d in batch.column("data")]
        ends = [np.flatnonzero(t == END_OF_DOCUMENT).astype(np.int32) for t in tokens]
        yield pa.RecordBatch.from_arrays([
            batch.column("file"), batch.column("block"),
            pa.array([len(t) for t in tokens], pa.int64()), pa.array(ends, pa.list_(pa.int32())),
        ], names=["file", "block", "size", "ends"])


def scan(blocks: DataFrame) -> DataFrame:
    """Documents of flat token files: file, ordinal, start, n_tokens and ended.

    ``n_tokens`` leaves the separator out; separators in a row are documents without
    tokens. Tokens behind the last separator of a file form a document with ``ended``
    false. Blocks may come in any order, but none may be missing or repeated. An empty
    table gives an empty result.
    """
    file_type = blocks.schema["file"].dataType.simpleString()
    found = materialize(
        blocks.where("length(data) > 0").mapInArrow(_ends, f"file {file_type}, block bigint, size bigint, ends array<int>")
    )
    last = F.when(F.size("ends") > 0, F.element_at("ends", -1))
    summary = found.select("file", "block", "size", F.size("ends").alias("n"), last.alias("last"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    summary = summary.withColumn("offset", F.coalesce(F.sum("size").over(before), zero))
    summary = summary.select(
        F.col("file").alias("f"), F.col("block").alias("b"), "offset",
        F.coalesce(F.sum("n").over(before), zero).alias("ended_before"),
        # Where the document that is open at the block's begin starts.
        F.coalesce(F.max(F.col("offset") + F.col("last") + 1).over(before), zero).alias("open_from"),
    )
    placed = found.join(summary, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b")))

    def previous(i: Column) -> Column:
        within = F.col("offset") + F.element_at("ends", F.greatest(i, F.lit(1))) + 1
        return F.when(i > 0, within).otherwise(F.col("open_from"))

    documents = placed.select("file", "offset", "ended_before", "open_from", "ends", F.posexplode("ends").alias("i", "end"))
    documents = documents.select(
        "file", (F.col("ended_before") + F.col("i")).alias("ordinal"), previous(F.col("i")).alias("start"),
        (F.col("offset") + F.col("end")).alias("stop"),
    )
    finished = documents.select(
        "file", "ordinal", "start", (F.col("stop") - F.col("start")).alias("n_tokens"), F.lit(True).alias("ended")
    )
    whole = placed.groupBy("file").agg(
        F.sum("size").alias("length"), F.sum(F.size("ends")).cast("long").alias("ordinal"),
        F.max(F.greatest("open_from", F.col("offset") + last + 1)).alias("start"),
    )
    rest = whole.where("length > start").select(
        "file", "ordinal", "start", (F.col("length") - F.col("start")).alias("n_tokens"), F.lit(False).alias("ended")
    )
    return finished.unionByName(rest)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document, counted by the scan of flat streams written from them."""
    blocks, order = write_flat(read(spark, sf_dir, "documents"))
    counts = scan(blocks)
    return order.join(counts, ["file", "ordinal"]).select("doc_id", "n_tokens", "ended")
