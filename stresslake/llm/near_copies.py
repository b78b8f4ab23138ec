"""Near copies by the exact Jaccard similarity of their sets of word shingles.

Two documents are near copies if their sets of ``SHINGLE``-word shingles (64-bit hashes)
have a Jaccard similarity of ``SIMILARITY`` or more. Exact comparison decides. What is
compared has a key in common, and keys come from two tables:

* Each set has ``FINGERPRINTS`` independent SimHashes. Pivot distance tables (see
  ``simhash``) link fingerprints within three bits, and a set's keys are its fingerprints
  and their links. This finds close copies: at 0.8 fingerprints differ by about ten
  bits and by up to twenty, which no table of distances separates from chance.
* For the rest MinHash: of each set the least values under ``BANDS`` x ``ROWS`` orders
  are taken, ``ROWS`` to a band; a whole band is a key.

Sets that keys join, also in a chain, form a group. Within a group the pairs that share
a key are compared, unless links found before join them already. Large groups are cut
into tiles by the number of their shingles, and no such pair is left out.

Equal sets are folded before. Texts without words have the empty set and form one group.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stresslake.llm.common import materialize
from stresslake.llm.components import connected_components
from stresslake.llm.simhash import SEED, fingerprint_links, majority_bits

SHINGLE = 5
SIMILARITY = 0.8
FINGERPRINTS = 4
BANDS, ROWS = 40, 6
# Shingles of one chunk of a group; more are cut into tiles of two chunks each.
CHUNK_SHINGLES = 1 << 20
# Parts in which the sets of a group meet the group's size.
SALTS = 16
# Hashes that meet all orders at once.
_SLICE = 256
_ODD = [random.Random(SEED * 1000 + i).getrandbits(64) | 1 for i in range(FINGERPRINTS + 1)]
_ORDERS = np.array([random.Random(SEED + i).getrandbits(32) | 1 for i in range(BANDS * ROWS)], np.uint32)


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles of the whole text; a shorter text is one shingle."""
    # bytes.lower() and bytes.split() know ASCII letters and white space only.
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(p, SEED) for p in parts], np.uint64))


def band_keys(hashes: np.ndarray) -> list[int]:
    """A signed 64-bit key per band of a set; none for the empty set."""
    if not len(hashes):
        return []
    # Odd numbers times odd numbers: each order is a permutation of them.
    odd = (hashes >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    least = np.full(len(_ORDERS), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(odd), _SLICE):
        least = np.minimum(least, (_ORDERS[:, None] * odd[None, at:at + _SLICE]).min(1))
    keys = [xxhash.xxh64_intdigest(band.tobytes(), i) for i, band in enumerate(least.reshape(BANDS, ROWS))]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def fingerprints(hashes: np.ndarray) -> list[int]:
    """Independent SimHashes of a set, as signed numbers; none for the empty set."""
    if not len(hashes):
        return []
    found = []
    for i in range(FINGERPRINTS):
        mixed = hashes * np.uint64(_ODD[i])
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(_ODD[i + 1])
        found.append(majority_bits(mixed ^ (mixed >> np.uint64(29))))
    return found


def with_set_hash(docs: DataFrame, text: str = "text", name: str = "simhash") -> DataFrame:
    """``docs`` with a hash of each text's shingle set as a long, and its ``sketch``:
    the set's fingerprints, band keys and size. Columns of these names are replaced."""

    @F.arrow_udf("fp long, fps array<long>, bands array<long>, size int")
    def sketch(texts: pa.Array) -> pa.Array:
        fps, own, bands, sizes = [], [], [], []
        for t in texts:
            hashes = shingle_set(t.as_py())
            fps.append(xxhash.xxh64_intdigest(hashes.tobytes(), SEED))
            own.append(fingerprints(hashes))
            bands.append(band_keys(hashes))
            sizes.append(len(hashes))
        fps = pa.array(np.array(fps, np.uint64).view(np.int64))
        lists = [pa.array(x, pa.list_(pa.int64())) for x in (own, bands)]
        return pa.StructArray.from_arrays([fps, *lists, pa.array(sizes, pa.int32())], ["fp", "fps", "bands", "size"])

    marked = docs.withColumn("sketch", sketch(F.col(text)))
    return marked.withColumn(name, F.col("sketch.fp"))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sorted sets of hashes, not both empty."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


class Tile:
    """Sets of a group and the links that join the similar ones among them."""

    def __init__(self, both: bool) -> None:
        """``both``: pairs within a chunk belong to this tile."""
        self.both = both
        self.sets: list[np.ndarray] = []
        self.chunks: list[int] = []
        self.fps: list[int] = []
        self.parent: list[int] = []
        # Per key the sets that have it, by the part they were joined to.
        self.holders: dict[int, dict[int, list[int]]] = {}
        self.links: list[tuple[int, int]] = []

    def root(self, at: int) -> int:
        while self.parent[at] != at:
            self.parent[at] = self.parent[self.parent[at]]
            at = self.parent[at]
        return at

    def _parts(self, key: int) -> dict[int, list[int]]:
        """Sets with a key, parts that were joined meanwhile put together."""
        held = self.holders.setdefault(key, {})
        for old in [r for r in held if self.parent[r] != r]:
            members, new = held.pop(old), self.root(old)
            if new in held and len(held[new]) < len(members):
                members, held[new] = held[new], members
            held.setdefault(new, []).extend(members)
        return held

    def _similar(self, own: int, other: int) -> bool:
        if not self.both and self.chunks[other] == self.chunks[own]:
            return False
        return jaccard(self.sets[other], self.sets[own]) >= SIMILARITY

    def add(self, fp: int, chunk: int, keys: list[int], hashes: np.ndarray) -> None:
        """Compare a set with those that share a key and are not joined to it yet.

        Of a part that one comparison joins no more is compared, so a group whose sets
        are all alike costs a comparison per set.
        """
        own = len(self.sets)
        self.sets.append(hashes)
        self.chunks.append(chunk)
        self.fps.append(fp)
        self.parent.append(own)
        tried: set[int] = set()
        for key in keys:
            for part, members in self._parts(key).items():
                if self.root(part) == self.root(own):
                    continue
                for other in members:
                    if other in tried:
                        continue
                    tried.add(other)
                    if self._similar(own, other):
                        self.links.append((self.fps[other], fp))
                        self.parent[self.root(own)] = self.root(other)
                        break
        for key in keys:
            self._parts(key).setdefault(self.root(own), []).append(own)

    def batch(self) -> pa.RecordBatch:
        a, b = zip(*self.links, strict=True) if self.links else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links from rows sorted by group and tile; a tile may span batches."""
    last, tile = None, None
    for batch in batches:
        columns = [batch.column(n) for n in ("component", "i", "j", "chunk", "fp", "keys", "text")]
        for row in range(batch.num_rows):
            *place, chunk, fp, keys, text = (c[row].as_py() for c in columns)
            if place != last:
                if tile is not None:
                    yield tile.batch()
                last, tile = place, Tile(place[1] == place[2])
            tile.add(fp, chunk, keys, shingle_set(text))
    if tile is not None:
        yield tile.batch()


def candidate_keys(sketches: DataFrame) -> DataFrame:
    """fp and key of every set with a partner: fingerprints, links of near ones, and bands.

    ``sketches`` has one row per set: fp, fps, bands.
    """
    nodes = materialize(sketches.select(F.explode("fps").alias("fp")).distinct())
    tables = sketches.select(F.col("fp").alias("own"), F.explode("fps").alias("node"))
    near = fingerprint_links(nodes).select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
    near = materialize(near.distinct().withColumn("key", F.xxhash64(F.lit("link"), "u", "v")))
    ends = near.select(F.col("u").alias("end"), "key").unionByName(near.select(F.col("v").alias("end"), "key"))
    linked = tables.join(ends, F.col("node") == F.col("end")).select(F.col("own").alias("fp"), "key")
    same = tables.select(F.col("own").alias("fp"), F.xxhash64(F.lit("table"), "node").alias("key"))
    grouped = same.unionByName(linked)
    keyed = grouped.unionByName(sketches.select("fp", F.explode("bands").alias("key")))
    shared = keyed.groupBy("key").agg(F.min("fp").alias("root"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return keyed.join(shared.select("key", "root"), "key")


def jaccard_links(marked: DataFrame, doc_id: str = "doc_id", text: str = "text", name: str = "simhash") -> DataFrame:
    """Links between set hashes that join all near copies, directly or in a chain.

    ``marked`` is the written result of ``with_set_hash``. Of the links only those are
    returned that join sets not joined before in their tile.
    """
    rows = marked.select(F.col(doc_id).alias("id"), F.col(name).alias("fp"), F.col(text).alias("text"), "sketch")
    sketches = rows.select("fp", "sketch.fps", "sketch.bands", "sketch.size").dropDuplicates(["fp"])
    sketches = materialize(sketches)
    keyed = materialize(candidate_keys(sketches))
    groups = materialize(connected_components(keyed.where("fp <> root").select("fp", "root").distinct()))
    keys = keyed.groupBy(F.col("fp").alias("holder")).agg(F.collect_set("key").alias("keys"))
    sized = groups.join(sketches.select("fp", "size"), F.col("node") == F.col("fp")).drop("fp")
    sizes = sized.groupBy("component").agg(
        F.ceil(F.sum(F.col("size").cast("long")) / CHUNK_SHINGLES).cast("int").alias("chunks")
    ).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # A large group is many keys this way.
    salted = groups.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    # One document of each set gives the text; an id of its own keeps many copies apart.
    first = rows.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull(), "id")).alias("c"))
    members = materialize(
        salted.join(sizes, ["component", "salt"]).join(first, F.col("node") == first["fp"])
        .join(keys, F.col("node") == F.col("holder"))
        .select("node", F.col("c.id").alias("first_id"), "component", "chunks", "keys")
    )
    texts = rows.drop("sketch").join(
        members, (F.col("fp") == F.col("node")) & F.col("id").eqNullSafe(F.col("first_id"))
    ).dropDuplicates(["fp"])
    tiles = (
        texts.withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("component", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
                "chunk", "fp", "keys", "text")
    )
    order = ["component", "i", "j"]
    return tiles.repartition(*order).sortWithinPartitions(*order).mapInArrow(_verified, "a long, b long")
