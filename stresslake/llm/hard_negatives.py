"""Hard-negative mining with exact scores by a product in a residue number system.

Vectors become whole numbers floor(scale * x), and a score is their inner product. It is
computed exactly with single-precision matrix products: both matrices are reduced modulo
a few small primes, to residues around zero, such that every partial sum of a product
stays below 2^24 and so is a whole number without rounding. The products, reduced again,
are the residues of the scores, and the Chinese remainder theorem puts the signed score
together. As many primes are taken as the largest possible score of the two matrices
asks for (Cauchy-Schwarz), so no score leaves their range.

Candidates are dealt to shards of bounded size. A task holds one shard and the anchors
stream past it in batches; nothing else is kept but the best few per anchor:

* the first round finds each anchor's positives, the best rows of its label;
* in the second an anchor brings the scores of its positives, and of the other labels
  the best rows within the window that each positive opens are selected.

What the shards return is merged per anchor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stresslake.llm.common import materialize, read
from stresslake.llm.vectors import is_finite, rows_of

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
# A negative scores between LOW and HIGH percent of its positive.
LOW, HIGH = 50, 95
SHARD_ROWS = 32_768
# Columns multiplied before the sums are reduced again.
INNER = 256
# Scores computed at once.
_SCORES = 1 << 21
_NO_ID = np.iinfo(np.int64).max


def moduli(width: int, bound: int) -> list[int]:
    """Primes, largest first, whose product exceeds ``2 * bound + 1``.

    Sums of ``width`` products of residues around zero stay below 2^24.
    """
    half = int(np.sqrt((1 << 24) / max(1, min(width, INNER)))) - 1
    found, product, p = [], 1, 2 * half + 1
    while product <= 2 * bound + 1:
        if p < 3 or product * p >= 1 << 62:
            raise OverflowError(f"scores up to {bound} do not fit")
        if all(p % q for q in range(3, int(p**0.5) + 1, 2)):
            found.append(p)
            product *= p
        p -= 2
    return found


def residues(matrix: np.ndarray, p: int) -> np.ndarray:
    """Residues around zero as single-precision numbers."""
    half = p // 2
    return ((matrix + half) % p - half).astype(np.float32)


def residue_product(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """``a @ b.T`` modulo ``p``, from matrices of residues; values in 0..p-1."""
    total = 0
    for k in range(0, a.shape[1], INNER):
        part = (a[:, k:k + INNER] @ b[:, k:k + INNER].T).astype(np.int32) % p
        total = part if k == 0 else (total + part) % p
    return total


def combine(parts: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Signed whole numbers from their residues (mixed radix, in 64 bits)."""
    value, product = parts[0].astype(np.int64), primes[0]
    for part, p in zip(parts[1:], primes[1:], strict=True):
        inverse = pow(product % p, -1, p)
        value += product * (((part - value % p) * inverse) % p)
        product *= p
    value[value > product // 2] -= product
    return value


def largest_score(a: np.ndarray, b: np.ndarray) -> int:
    """A bound of all inner products of rows of ``a`` and ``b``."""
    longest = [np.sqrt((m.astype(np.float64) ** 2).sum(1).max(initial=0)) for m in (a, b)]
    return int(np.ceil(longest[0] * longest[1] * (1 + 1e-9))) + 1


class Shard:
    """Candidates of one length, by id, with their residues modulo each prime in use."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, nodes: np.ndarray, labels: np.ndarray) -> None:
        order = np.lexsort((nodes, ids))
        self.vectors, self.ids, self.nodes, self.labels = (
            x[order] for x in (vectors, ids, nodes, labels)
        )
        self.known: dict[int, np.ndarray] = {}

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Exact inner products, one row per anchor."""
        primes = moduli(anchors.shape[1], largest_score(anchors, self.vectors))
        parts = []
        for p in primes:
            if p not in self.known:
                self.known[p] = residues(self.vectors, p)
            parts.append(residue_product(residues(anchors, p), self.known[p], p))
        return combine(parts, primes)


def best_of(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, largest first; of equal ones the first places."""
    if len(scores) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > kth)
        at = np.concatenate([above, np.flatnonzero(scores == kth)[:k - len(above)]])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((at, -scores[at]))]


def _positives(shard: Shard, k: int):
    """The k best rows of the anchor's label, the anchor itself left out."""

    def pick(scores, node, label, _):
        at = np.flatnonzero((shard.labels == label) & (shard.nodes != node))
        at = at[best_of(scores[at], k)]
        return [(0, shard.ids[i], scores[i]) for i in at]

    return pick


def _negatives(shard: Shard, k: int, low: int, high: int):
    """Per positive the k best rows of other labels within its window."""

    def pick(scores, _, label, positives):
        # The windows of an anchor overlap: what lies in none is left behind first.
        spans = [(-(-low * p // 100), high * p // 100) for p in positives]
        other = shard.labels != label
        first, last = min(s[0] for s in spans), max(s[1] for s in spans)
        at = np.flatnonzero(other & (scores >= first) & (scores <= last))
        near, found = scores[at], []
        for number, (a, b) in enumerate(spans):
            inside = np.flatnonzero((near >= a) & (near <= b))
            chosen = at[inside[best_of(near[inside], k)]]
            found += [(number, shard.ids[i], scores[i]) for i in chosen]
        return found

    return pick


_FOUND = "node long, place int, vec_id long, score long"


def _scan(make: Callable[[Shard], Callable]) -> Callable:
    """mapInArrow over rows sorted by shard, candidates before anchors."""

    def shards_of(held: list[pa.RecordBatch]) -> dict[int, Shard]:
        table = pa.Table.from_batches(held)
        dims = table["dim"].to_numpy()
        out = {}
        for dim in np.unique(dims):
            rows = table.take(pa.array(np.flatnonzero(dims == dim)))
            ids = rows["vec_id"].fill_null(_NO_ID).to_numpy()
            out[dim] = Shard(
                rows_of(rows["vector"], np.int64), ids, rows["node"].to_numpy(), rows["label"].to_numpy()
            )
        return out

    def answers(shards: dict[int, Shard], batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            shard = shards.get(dim)
            if shard is None:
                continue
            rows = batch.take(pa.array(np.flatnonzero(dims == dim)))
            vectors = rows_of(rows.column("vector"), np.int64)
            nodes, labels = rows.column("node").to_numpy(), rows.column("label").to_numpy()
            lists = rows.column("positives").to_pylist()
            pick = make(shard)
            step = max(1, _SCORES // len(shard.ids))
            for at in range(0, len(nodes), step):
                scores = shard.scores(vectors[at:at + step])
                found = [
                    (nodes[at + i], *row)
                    for i in range(len(scores))
                    for row in pick(scores[i], nodes[at + i], labels[at + i], lists[at + i])
                ]
                node, place, ids, score = zip(*found, strict=True) if found else ((),) * 4
                ids = np.array(ids, np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(node, pa.int64()), pa.array(place, pa.int32()),
                    pa.array(ids, pa.int64(), mask=ids == _NO_ID), pa.array(score, pa.int64()),
                ], names=["node", "place", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, shards = None, [], {}
        for batch in batches:
            keys = batch.column("shard").to_numpy().astype(np.int64) * 2 + batch.column("kind").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                part, (number, kind) = batch.slice(a, b - a), divmod(int(keys[a]), 2)
                if number != current:
                    current, held, shards = number, [], {}
                if kind == 0:
                    held.append(part)
                    continue
                if held:
                    shards, held = shards_of(held), []
                yield from answers(shards, part)

    return run


def _round(candidates: DataFrame, anchors: DataFrame, shards: int, make) -> DataFrame:
    columns = ["shard", "kind", "dim", "node", "vec_id", "label", "vector", "positives"]
    none = F.lit(None).cast("array<long>")
    side = candidates.withColumns({"kind": F.lit(0), "positives": none})
    asked = anchors.withColumns({
        "kind": F.lit(1), "shard": F.explode(F.sequence(F.lit(0), F.lit(shards - 1))),
    })
    rows = side.select(columns).unionByName(asked.select(columns))
    placed = rows.repartitionById(shards, "shard").sortWithinPartitions("shard", "kind")
    return placed.mapInArrow(_scan(make), _FOUND)


def _top(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = W.partitionBy(*keys).orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def quantize(vectors: DataFrame, vec_id: str, vector: str, label: str, anchor: Column, scale: int) -> DataFrame:
    """Rows that take part, numbered, with whole components; written once."""
    whole = F.transform(F.col(vector), lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    usable = is_finite(F.col(vector)) & F.col(label).isNotNull() & (F.size(F.col(vector)) > 0)
    rows = vectors.where(usable).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
        whole.alias("vector"), F.size(F.col(vector)).alias("dim"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    )
    return materialize(rows.withColumn("node", F.monotonically_increasing_id()))


def mine(
    vectors: DataFrame, anchor: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
) -> DataFrame:
    """Hard negatives of every row for which ``anchor`` is true, against all rows.

    An anchor's positives are the ``positives`` best other rows of its label. For each of
    them the ``negatives`` best rows of other labels are returned whose score lies between
    ``low`` and ``high`` percent of the positive's: anchor_id, positive_id, rank (from 1),
    negative_id, positive_score and negative_score. Ties go to the smaller id.

    Rows without a label, or whose vector is NULL, empty or holds NULL or non-finite
    components, take no part; only vectors of the anchor's length are compared. Rows
    without an id are candidates and come last among ties. Repeated rows are rows of
    their own. Scores that a long does not hold raise an error. Other columns do not
    matter, and an empty table gives an empty result.
    """
    rows = quantize(vectors, vec_id, vector, label, anchor, scale)
    spread = rows.sparkSession.sparkContext.defaultParallelism
    # Small tables are spread over the cores all the same.
    shards = max(1, spread, -(-rows.count() // SHARD_ROWS))
    dealt = F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int").alias("shard")
    candidates = rows.select("*", dealt)
    anchors = rows.where("anchor")

    asked = anchors.withColumn("positives", F.lit(None).cast("array<long>"))
    found = _round(candidates, asked, shards, lambda shard: _positives(shard, positives))
    best = materialize(_top(found, ["node"], positives).select("node", "rank", "vec_id", "score"))

    listed = best.groupBy(F.col("node").alias("n")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]).alias("positives")
    )
    asked = anchors.join(listed, anchors["node"] == listed["n"])
    found = _round(candidates, asked, shards, lambda shard: _negatives(shard, negatives, low, high))
    chosen = _top(found, ["node", "place"], negatives).select(
        "node", (F.col("place") + 1).alias("of"), "rank",
        F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"),
    )
    pairs = best.select(
        F.col("node").alias("n"), F.col("rank").alias("of_rank"),
        F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
    )
    named = anchors.select(F.col("node").alias("a"), F.col("vec_id").alias("anchor_id"))
    return (
        chosen.join(pairs, (F.col("node") == F.col("n")) & (F.col("of") == F.col("of_rank")))
        .join(named, F.col("node") == F.col("a"))
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
                "negative_id", "positive_score", "negative_score")
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


OP12_SQL = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM usable a JOIN usable c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v)
  WHERE a.vec_id % 50 = 0
), positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id))::INTEGER AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positive p JOIN scored s
  ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
