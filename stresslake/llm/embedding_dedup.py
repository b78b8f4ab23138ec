"""Embedding near-duplicates by an all-pairs join of packed chunks.

Vectors are folded, packed into chunks of bounded size (a row holds thousands of them, in
single precision where that is exact) and written once. Every chunk then meets every other
and itself: a cartesian product of chunk rows, which reads the written chunks again and
exchanges nothing, so disk grows with the vectors and not with their pairs.

Within a tile of two chunks

* the vectors are rotated (random signs and a Hadamard transform, which spreads every
  vector evenly over the coordinates); the leading coordinates and the length of the rest
  bound the cosine from above, so one narrow matrix product leaves few pairs;
* the exact cosine in doubles decides.

What leaves a task grows with the vectors it has met: links counted per vector and a
spanning set of links, not the pairs themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stresslake.llm.common import materialize, read
from stresslake.llm.components import connected_components
from stresslake.llm.simhash import forest
from stresslake.llm.vectors import is_finite, rows_of

MIN_COSINE = 0.9
# Vectors that one chunk holds, and bytes of them in doubles; a tile compares two chunks.
CHUNK = 8_192
CHUNK_BYTES = 8 << 20
# Rows of a tile whose products are taken at once, against so many others.
_SLICE, _WIDTH = 128, 2_048
# Pairs verified at once, and links held before they are reduced.
_PAIRS = 1 << 16
# Of a slice with a larger share of candidates all cosines are taken at once.
_DENSE = 1 / 64
# Deviations below the mean at which the leading coordinates leave a random pair.
_DEVIATIONS = 4.2
# Tiles that travel to a worker at once.
_TILES = 2
# Heads of chunks that a task keeps.
_HEADS_BYTES = 64 << 20
# Room for rounding in the search and in a matrix product of doubles; the cosine itself decides.
SLACK, _CLOSE = 1e-5, 1e-9
SEED = 42


def rotate(unit: np.ndarray) -> np.ndarray:
    """Random signs and a Hadamard transform; lengths and distances stay."""
    n, dim = unit.shape
    width = 1 << max(0, (dim - 1).bit_length())
    x = np.zeros((n, width))
    x[:, :dim] = unit * np.random.default_rng(SEED).choice([-1.0, 1.0], dim)
    half = 1
    while half < width:
        x = x.reshape(n, -1, 2, half)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        half *= 2
    return x.reshape(n, width) / np.sqrt(width)


def normalize(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors; scaling by the largest component first keeps squares in range."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def head_width(width: int, min_cosine: float) -> int:
    """Leading coordinates that tell nearly all random pairs from those that are close.

    Over h of them the squared distance of a random pair is chi-squared with h degrees of
    freedom (in units of 2 / width); Wilson and Hilferty's cube root makes that normal.
    """
    reach = (1 - min_cosine) * width
    for h in range(1, width):
        spread = 2 / (9 * h)
        if np.cbrt(reach / h) <= 1 - spread - _DEVIATIONS * np.sqrt(spread):
            return h
    return width


def heads_of(unit: np.ndarray, min_cosine: float) -> np.ndarray:
    """Leading rotated coordinates and the length of the rest, in single precision.

    Their inner product is the cosine or more, up to rounding.
    """
    dim = unit.shape[1]
    width = 1 << max(0, (dim - 1).bit_length())
    h = head_width(width, min_cosine)
    if h + 1 >= dim:
        return unit.astype(np.float32)
    lead = unit @ np.ascontiguousarray(rotate(np.eye(dim))[:, :h])
    rest = np.sqrt(np.maximum(0, 1 - (lead * lead).sum(1, keepdims=True)))
    return np.concatenate([lead, rest], axis=1).astype(np.float32)


class Chunk:
    """Packed vectors; the number of a vector is ``start`` and its place."""

    def __init__(self, start: int, dim: int, single: bool, copies: np.ndarray, vectors: pa.Buffer):
        self.start, self.copies = start, copies
        self.raw = np.frombuffer(vectors, "<f4" if single else "<f8").reshape(len(copies), dim)

    @cached_property
    def unit(self) -> np.ndarray:
        return normalize(self.raw.astype(np.float64))

    def units(self, at: np.ndarray) -> np.ndarray:
        """Unit vectors at some places, the same to the last bit as those of ``unit``."""
        return self.unit[at] if "unit" in self.__dict__ else normalize(self.raw[at].astype(np.float64))


def _cosines(a: Chunk, b: Chunk, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return (a.units(i) * b.units(j)).sum(1)


def tile_links(
    a: Chunk, b: Chunk, head_a: np.ndarray, head_b: np.ndarray, min_cosine: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs of a tile whose cosine is high enough, in bounded portions.

    Of a chunk with itself each pair comes once.
    """
    one, held, count = a is b, [], 0

    def verified() -> tuple[np.ndarray, np.ndarray]:
        i, j = (np.concatenate(x) for x in zip(*held, strict=True))
        good = _cosines(a, b, i, j) >= min_cosine
        return i[good], j[good]

    for first in range(0, len(head_b), _WIDTH):
        others = np.ascontiguousarray(head_b[first:first + _WIDTH].T)
        for at in range(0, min(len(head_a), first + _WIDTH) if one else len(head_a), _SLICE):
            near = head_a[at:at + _SLICE] @ others
            found = np.flatnonzero(near >= min_cosine - SLACK)
            if not len(found):
                continue
            sure = None
            if len(found) > near.size * _DENSE:
                near = a.unit[at:at + _SLICE] @ b.unit[first:first + _WIDTH].T
                sure = near >= min_cosine + _CLOSE
                found = np.flatnonzero(~sure & (near >= min_cosine - _CLOSE))
                sure = np.flatnonzero(sure)
            for places, known in ((found, False), (sure, True)):
                for k in range(0, 0 if places is None else len(places), _PAIRS):
                    i, j = np.divmod(places[k:k + _PAIRS], near.shape[1])
                    i, j = i + at, j + first
                    if one:
                        i, j = i[i < j], j[i < j]
                    if known:
                        yield i, j
                        continue
                    held.append((i, j))
                    count += len(i)
                    if count >= _PAIRS:
                        yield verified()
                        held, count = [], 0
    if count:
        yield verified()


def _spanning(links: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Fewer links than vectors that join the same parts."""
    a, b = (np.concatenate(x) for x in zip(*links, strict=True))
    numbers, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = forest(len(numbers), place[:len(a)], place[len(a):])
    return numbers[left], numbers[right]


def _tiles(min_cosine: float):
    """mapInArrow over pairs of chunks: counted links per vector, and links that join them."""
    names = ("chunk", "dim", "single", "copies", "vectors")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])

    def chunk_of(batch: pa.RecordBatch, side: str, k: int) -> Chunk:
        start, dim, single, copies, vectors = (batch.column(f"{n}_{side}")[k] for n in names)
        return Chunk(start.as_py(), dim.as_py(), single.as_py(), copies.values.to_numpy(), vectors.as_buffer())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        heads: dict[int, np.ndarray] = {}
        links: list[tuple[np.ndarray, np.ndarray]] = []
        held, least, a = 0, _PAIRS, None
        for batch in batches:
            for k in range(batch.num_rows):
                # The chunk on the left comes again and again: it is unpacked once.
                if a is None or batch.column("chunk_a")[k].as_py() != a.start:
                    a = chunk_of(batch, "a", k)
                    head_a = heads_of(a.unit, min_cosine)
                b = chunk_of(batch, "b", k)
                if b.start == a.start:
                    b, head_b = a, head_a
                elif b.start in heads:
                    head_b = heads[b.start]
                else:
                    head_b = heads_of(b.unit, min_cosine)
                    if sum(h.nbytes for h in heads.values()) < _HEADS_BYTES:
                        heads[b.start] = head_b
                    del b.unit
                count_a, count_b = (counts.setdefault(c.start, np.zeros(len(c.copies), np.int64)) for c in (a, b))
                for i, j in tile_links(a, b, head_a, head_b, min_cosine):
                    np.add.at(count_a, i, b.copies[j])
                    np.add.at(count_b, j, a.copies[i])
                    links.append((i + a.start, j + b.start))
                    held += len(i)
                    # Only links that join parts are kept, so they do not outnumber the vectors.
                    if held >= least:
                        links = [_spanning(links)]
                        held = len(links[0][0])
                        least = 2 * held + _PAIRS
        for start, count in counts.items():
            linked = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([
                pa.array(linked + start), pa.nulls(len(linked), pa.int64()), pa.array(count[linked])], schema=schema)
        if links:
            left, right = _spanning(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(left), pa.array(right), pa.nulls(len(left), pa.int64())], schema=schema)

    return run


def _pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow: an id and the bytes of its vector; equal vectors give equal bytes.

    The first byte is the size of a component: 4 where single precision is exact, else 8.
    """
    for batch in batches:
        vectors = batch.column("vector")
        lengths = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy()
        packed: list[bytes | None] = [None] * len(lengths)
        for dim in np.unique(lengths[lengths > 0]):
            at = np.flatnonzero(lengths == dim)
            values = rows_of(vectors.take(pa.array(at)), np.float64) + 0.0  # no negative zero
            with np.errstate(over="ignore", under="ignore"):
                short = values.astype("<f4")
            exact = (short.astype(np.float64) == values).all(1)
            for k, row, small, single in zip(at, values.astype("<f8"), short, exact, strict=True):
                packed[k] = b"\x04" + small.tobytes() if single else b"\x08" + row.tobytes()
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(packed, pa.binary())], names=["vec_id", "packed"])


def _pack_chunks(most: int):
    """mapInArrow: rows of up to ``most`` vectors of one length and precision."""
    names = ["chunk", "dim", "single", "first_id", "copies", "digest", "vectors"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Vectors are numbered on from the first of their partition.
        start = TaskContext.get().partitionId() << 40
        held: dict[tuple[int, int], list[pa.RecordBatch]] = {}
        waiting = 0

        def chunk(size: int, dim: int, rows: pa.Table) -> pa.RecordBatch:
            nonlocal start
            ends = pa.array([0, len(rows)], pa.int32())
            lists = [
                pa.ListArray.from_arrays(ends, pa.concat_arrays(rows[n].chunks))
                for n in ("first_id", "copies", "digest")
            ]
            start += len(rows)
            return pa.RecordBatch.from_arrays([
                pa.array([start - len(rows)]), pa.array([dim], pa.int32()), pa.array([size == 4]), *lists,
                pa.array([b"".join(p[1:] for p in rows["packed"].to_pylist())], pa.binary()),
            ], names=names)

        def full(size: int, dim: int, last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal waiting
            limit = max(1, min(most, CHUNK_BYTES // (8 * dim)))
            table = pa.Table.from_batches(held.pop((size, dim)))
            used = len(table) if last else len(table) // limit * limit
            for at in range(0, used, limit):
                yield chunk(size, dim, table.slice(at, min(limit, used - at)))
            waiting -= used * size * dim
            if used < len(table):
                held[size, dim] = table.slice(used).combine_chunks().to_batches()

        for batch in batches:
            packed = batch.column("packed")
            sizes = np.array([p[0] for p in packed.to_pylist()], np.int64)
            dims = (pc.binary_length(packed).to_numpy() - 1) // np.maximum(sizes, 1)
            for size, dim in set(zip(sizes.tolist(), dims.tolist(), strict=True)):
                some = batch.take(pa.array(np.flatnonzero((sizes == size) & (dims == dim))))
                parts = held.setdefault((size, dim), [])
                parts.append(some)
                waiting += len(some) * size * dim
                if sum(map(len, parts)) >= min(most, CHUNK_BYTES // (8 * dim)):
                    yield from full(size, dim, False)
            # Vectors of many lengths do not pile up.
            if waiting > 4 * CHUNK_BYTES:
                for key in list(held):
                    yield from full(*key, True)
        for key in list(held):
            yield from full(*key, True)

    return run


@contextmanager
def _batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Queries run in this block send the Python workers that many rows at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _links(chunks: DataFrame, min_cosine: float) -> DataFrame:
    """Rows of (a, NULL, links) and (a, b, NULL) over distinct usable vectors."""
    sides = [
        chunks.select(*[F.col(c).alias(f"{c}_{side}") for c in ("chunk", "dim", "single", "copies", "vectors")])
        for side in "ab"
    ]
    a, b = F.col("chunk_a"), F.col("chunk_b")
    # Of a pair of chunks one order counts, by a hash, so that tasks get like shares.
    even = F.xxhash64(a).bitwiseXOR(F.xxhash64(b)).bitwiseAND(F.lit(1)) == 0
    met = (F.col("dim_a") == F.col("dim_b")) & ((a == b) | ((a != b) & ((a < b) == even)))
    # A cartesian product reads both sides anew in each task: nothing is exchanged or sent to all.
    tiles = sides[0].join(sides[1].hint("shuffle_replicate_nl"), met)
    return tiles.mapInArrow(_tiles(min_cosine), "a long, b long, links long")


def _usable(vector: Column) -> Column:
    return is_finite(vector) & F.exists(vector, lambda x: x != 0)


def near_duplicates(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", min_cosine: float = MIN_COSINE
) -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links, component_id and kept.

    Two rows are linked if the cosine of their vectors is ``min_cosine`` or more.
    ``component_id`` is the smallest id reachable by links and ``kept`` tells whether
    it is the row's own. Equal vectors are linked and folded before the join; rows find
    theirs again by 128 bits of the SHA-256 of its values.
    Vectors that are NULL, empty or zero or hold NULL or non-finite components link
    with nothing, as do vectors of different lengths among each other. NULL ids count
    only where a component has no other. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    # Unusable vectors get no bytes, and so no partner.
    rows = rows.withColumn("vector", F.when(_usable(F.col("vector")), F.col("vector")))
    id_type = rows.schema["vec_id"].dataType
    packed = rows.mapInArrow(
        _pack_rows, T.StructType().add("vec_id", id_type).add("packed", T.BinaryType())
    )
    digest = F.unhex(F.substring(F.sha2("packed", 256), 1, 32))
    folded = packed.where("packed IS NOT NULL").groupBy("packed").agg(
        F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies")
    )
    # No more parts than the session has cores, unless they are large: chunks stay few.
    parts = max(spark.sparkContext.defaultParallelism, -(-vectors.count() // CHUNK))
    chunks = folded.withColumn("digest", digest).coalesce(parts).mapInArrow(
        _pack_chunks(CHUNK),
        T.StructType().add("chunk", "long").add("dim", "integer").add("single", "boolean")
        .add("first_id", T.ArrayType(id_type)).add("copies", T.ArrayType(T.LongType()))
        .add("digest", T.ArrayType(T.BinaryType())).add("vectors", "binary"),
    )
    # Numbered in the written table, so the numbers stay. A row is large, so sizes are looked at often.
    chunks = materialize(chunks, **{
        "parquet.block.size": CHUNK_BYTES, "parquet.page.size.row.check.min": 1,
        "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 1,
    })
    with _batches_of(spark, _TILES):
        found = materialize(_links(chunks, min_cosine))
    places = chunks.select("chunk", F.posexplode(F.arrays_zip("first_id", "copies", "digest")))
    nodes = places.select((F.col("chunk") + F.col("pos")).alias("node"), "col.first_id", "col.copies", "col.digest")
    degree = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    groups = connected_components(found.where("b IS NOT NULL").select("a", "b"))
    named = groups.join(nodes.select("node", "first_id"), "node")
    least = named.groupBy("component").agg(F.min("first_id").alias("least_id"))
    labels = named.join(least, "component").select("node", "least_id")
    placed = (
        nodes.join(degree, "node", "left").join(labels, "node", "left")
        .select(
            F.col("digest").alias("_digest"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("least_id", "first_id").alias("component_id"),
        )
    )
    joined = packed.select("vec_id", digest.alias("_key")).join(placed, F.col("_key") == F.col("_digest"), "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (component.isNull() | F.coalesce(F.col("vec_id") == component, F.lit(False))).alias("kept"),
    )


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "embeddings"))


OP10_SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9
), reach(a, b) AS (
  SELECT a, b FROM links
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), degree AS (SELECT a, count(*) AS n FROM links GROUP BY a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(l.m, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(l.m, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN degree d ON e.vec_id = d.a LEFT JOIN least l ON e.vec_id = l.a
"""
