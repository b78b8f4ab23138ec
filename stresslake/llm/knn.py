"""Exact top-k search by inner product with one KD-tree per shard.

Candidates are dealt to shards by a hash. A task holds one shard: it builds the shard's
KD-tree once (median splits on the widest side, a tight bounding box per node), and the
queries stream past it in batches, each searched best first. The largest inner product
that a box allows is the bound of a node; a search ends when no open node can beat the
kth score. Candidates move once per round, and queries once per shard.

The search runs in two rounds. First each query searches one home shard. Its kth
score there is a lower bound of the final one and travels with the query to all other
shards, where it prunes from the start. The k best of each shard are then merged.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stresslake.llm.common import materialize, read
from stresslake.llm.vectors import is_finite, rows_of

TOP_K = 20
SHARD_ROWS = 32_768
# Queries of a batch that are searched at once; their bounds for all nodes are held.
BLOCK_QUERIES = 1_024
LEAF_ROWS = 128
# Products of whole numbers are exact in doubles up to this sum.
EXACT = 2.0**53
NO_FLOOR = -(1 << 63)


class KDTree:
    """Median splits over the rows of a matrix, with a tight box per node."""

    def __init__(self, points: np.ndarray, leaf_rows: int = LEAF_ROWS) -> None:
        order = np.arange(len(points))
        spans, self.children, low, high = [(0, len(points))], [], [], []
        at = 0
        while at < len(spans):
            begin, end = spans[at]
            part = points[order[begin:end]]
            low.append(part.min(0))
            high.append(part.max(0))
            width = high[-1] - low[-1]
            # Equal points need no split.
            if end - begin > leaf_rows and width.max(initial=0) > 0:
                middle = (end - begin) // 2
                ranks = np.argpartition(part[:, width.argmax()], middle)
                order[begin:end] = order[begin:end][ranks]
                self.children.append((len(spans), len(spans) + 1))
                spans += [(begin, begin + middle), (begin + middle, end)]
            else:
                self.children.append(None)
            at += 1
        self.order, self.spans = order, spans
        self.low, self.high = np.array(low), np.array(high)
        self.points = points[order]
        self.leaves = sum(c is None for c in self.children)
        # Leaves that searches have looked into.
        self.visited = 0

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Largest inner product that each node's box allows, per query."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T


def _exact(a: np.ndarray, b: np.ndarray) -> bool:
    largest = np.abs(a).max(initial=0).astype(float) * np.abs(b).max(initial=0).astype(float)
    return largest * max(1, a.shape[1]) < EXACT


def search(
    tree: KDTree, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, floors: list[int], k: int
) -> list[tuple[int, int, int]]:
    """(query id, id, score) of the k best rows per query that reach the query's floor.

    Ties go to the smaller id. A row with the query's id is the query itself.
    """
    # Whole numbers in doubles multiply fast; beyond their exact range, as integers.
    kind = np.float64 if _exact(tree.points, queries) else np.int64
    points, wanted = tree.points.astype(kind), queries.astype(kind)
    own_ids = ids[tree.order]
    bounds = tree.bounds(wanted)
    out = []
    for q, query_id, floor in zip(range(len(queries)), query_ids, floors, strict=True):
        best: list[tuple[int, int]] = []  # (score, -id), the worst in front
        bound = bounds[q]
        open_nodes = [(-bound[0], 0)]
        while open_nodes:
            limit, node = heapq.heappop(open_nodes)
            # A node as good as the kth score may still hold a smaller id.
            if -limit < floor or (len(best) == k and -limit < best[0][0]):
                break
            pair = tree.children[node]
            if pair is not None:
                for child in pair:
                    heapq.heappush(open_nodes, (-bound[child], child))
                continue
            tree.visited += 1
            begin, end = tree.spans[node]
            scores = points[begin:end] @ wanted[q]
            least = max(floor, best[0][0]) if len(best) == k else floor
            for i in np.flatnonzero(scores >= least):
                found = (int(scores[i]), -int(own_ids[begin + i]))
                if -found[1] == query_id:
                    continue
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
        out += [(query_id, -i, s) for s, i in best]
    return out


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _search_shards(k: int):
    """mapInArrow over rows sorted by shard, candidates before queries."""

    def trees_of(held: list[pa.RecordBatch]) -> dict[int, tuple[KDTree, np.ndarray]]:
        table = pa.Table.from_batches(held)
        dims = table["dim"].to_numpy()
        out = {}
        for dim in np.unique(dims):
            rows = table.take(pa.array(np.flatnonzero(dims == dim)))
            out[dim] = KDTree(rows_of(rows["vector"], np.int64)), rows["vec_id"].to_numpy()
        return out

    def answers(trees, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            if dim not in trees:
                continue
            rows = batch.take(pa.array(np.flatnonzero(dims == dim)))
            floors = [NO_FLOOR if f is None else f for f in rows.column("floor").to_pylist()]
            vectors, ids = rows_of(rows.column("vector"), np.int64), rows.column("vec_id").to_numpy()
            for at in range(0, len(ids), BLOCK_QUERIES):
                part = slice(at, at + BLOCK_QUERIES)
                found = search(*trees[dim], vectors[part], ids[part], floors[part], k)
                columns = list(zip(*found, strict=True)) if found else [(), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, trees = None, [], {}
        for batch in batches:
            keys = batch.column("shard").to_numpy().astype(np.int64) * 2 + batch.column("kind").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                part, (shard, kind) = batch.slice(a, b - a), divmod(int(keys[a]), 2)
                if shard != current:
                    current, held, trees = shard, [], {}
                if kind == 0:
                    held.append(part)
                    continue
                if held:
                    trees, held = trees_of(held), []
                yield from answers(trees, part)

    return run


def _round(candidates: DataFrame, queries: DataFrame, shards: int, k: int) -> DataFrame:
    columns = ["shard", "kind", "dim", "vec_id", "vector", "floor"]
    side = candidates.withColumns({"kind": F.lit(0), "floor": F.lit(None).cast("long")})
    rows = side.select(columns).unionByName(queries.withColumn("kind", F.lit(1)).select(columns))
    placed = rows.repartitionById(shards, "shard").sortWithinPartitions("shard", "kind")
    return placed.mapInArrow(_search_shards(k), "query_id long, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def quantize(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 64) -> DataFrame:
    """``vec_id`` and ``vector`` of whole numbers floor(scale * x); unusable rows are left out.

    Vectors that are NULL or hold NULL or non-finite components take no part, nor do
    rows without an id.
    """
    whole = F.transform(F.col(vector), lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    return vectors.where(is_finite(F.col(vector)) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("long").alias("vec_id"), whole.alias("vector")
    )


def top_k(candidates: DataFrame, queries: DataFrame, k: int = TOP_K) -> DataFrame:
    """The k largest inner products of each query with every candidate but itself.

    Both tables have ``vec_id`` and ``vector`` (arrays of whole numbers) and should be
    cheap to read twice. Returns query_id, rank (from 1), vec_id and score; ties go to
    the smaller id, and fewer candidates give fewer rows. Only vectors of the query's
    length are compared. Rows that share the query's id count as the query. Repeated
    candidate rows are separate candidates; a repeated query id is searched once, with
    the least of its vectors. Empty tables give an empty result.
    """
    sized = candidates.withColumn("dim", F.size("vector")).where("dim > 0")
    asked = queries.where(F.size("vector") > 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = asked.withColumn("dim", F.size("vector"))
    # Small tables are spread over the cores all the same.
    spread = sized.sparkSession.sparkContext.defaultParallelism
    shards = max(1, spread, -(-sized.count() // SHARD_ROWS))
    # The vector takes part, so rows that share an id are spread unless they are equal.
    sized = sized.withColumn("shard", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)).cast("int"))
    home = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")

    first = asked.withColumns({"shard": home, "floor": F.lit(None).cast("long")})
    at_home = materialize(_best(_round(sized, first, shards, k), k))
    # Fewer than k rows at home give no bound.
    kth = at_home.where(F.col("rank") == k).select(F.col("query_id").alias("q"), F.col("score").alias("floor"))
    elsewhere = F.explode(F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != home))
    second = asked.join(kth, F.col("vec_id") == F.col("q"), "left").withColumn("shard", elsewhere)
    found = at_home.drop("rank")
    if shards > 1:
        found = found.unionByName(_round(sized, second, shards, k))
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = materialize(quantize(read(spark, sf_dir, "embeddings")))
    return top_k(vectors, vectors.where("vec_id % 20 = 0"))


OP5_SQL = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""
