"""SimHash near-duplicates by pivot distance tables.

Each fingerprint gets a table of Hamming distances to fixed reference fingerprints,
kept per segment of the 64 bits. Two facts about fingerprints x and y with at most
``MAX_BITS`` differing bits drive the join, and neither can lose a pair:

* The differing bits touch at most three of five segments. In the two others the
  distances of x and y to every reference agree, so the pair meets under a key made
  of the coordinates of two segments (ten keys per fingerprint).
* By the triangle inequality the distances to one reference differ by at most
  ``MAX_BITS``. Pairs that meet and exceed this in any coordinate are discarded.

Survivors are verified on their bits. Equal fingerprints are folded before the join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stresslake.llm.common import materialize, read
from stresslake.llm.components import connected_components

SEED = 42
SHINGLE = 3
MAX_BITS = 3
SEGMENT_WIDTHS = (13, 13, 13, 13, 12)
REFERENCES = 8
# Rows of one key that one group compares; more are cut into tiles of two chunks each.
CHUNK = 4096
# Hashes whose bits are counted at once.
_SLICE = 1 << 16
# Runs up to this length are compared by shifting the sorted rows.
_SHORT = 32


def _segment_masks() -> list[int]:
    masks, start = [], 0
    for width in SEGMENT_WIDTHS:
        masks.append(((1 << width) - 1) << start)
        start += width
    return masks


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


MASKS = _segment_masks()
PIVOTS = [xxhash.xxh64_intdigest(f"reference {i}", SEED) for i in range(REFERENCES)]


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of the whole text; 0 without words."""
    # bytes.lower() and bytes.split() know ASCII letters and white space only.
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    return majority_bits(np.array([digest(p, SEED) for p in parts], np.uint64))


def majority_bits(hashes: np.ndarray) -> int:
    """Signed number of the bits that are set in over half of the hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _SLICE):
        octets = hashes[at:at + _SLICE].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "simhash") -> DataFrame:
    """``docs`` with the SimHash of each whole text as a long. NULL counts as no words."""

    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t.as_py()) for t in texts], pa.int64())

    return docs.withColumn(name, simhash(F.col(text)))


def _coordinates(fp: Column, mask: int) -> Column:
    """Distances to all references within a segment, four bits each, in one long."""
    packed = F.lit(0).cast("long")
    for i, pivot in enumerate(PIVOTS):
        distance = F.bit_count((fp.bitwiseXOR(F.lit(_signed(pivot)))).bitwiseAND(F.lit(_signed(mask))))
        packed = packed.bitwiseOR(F.shiftleft(distance.cast("long"), 4 * i))
    return packed


def _keyed(nodes: DataFrame) -> DataFrame:
    """Ten rows per fingerprint: the pair of segments and their coordinates."""
    segments = [f"s{i}" for i in range(len(MASKS))]
    wide = nodes.select("fp", *[
        _coordinates(F.col("fp"), mask).alias(name)
        for name, mask in zip(segments, MASKS, strict=True)
    ])
    keys = [
        F.struct(
            F.lit(number).alias("part"),
            F.shiftleft(F.col(segments[i]), 32).bitwiseOR(F.col(segments[j])).alias("key"),
        )
        for number, (i, j) in enumerate(combinations(range(len(MASKS)), 2))
    ]
    return wide.select("fp", F.inline(F.array(*keys)))


def _tiles(keyed: DataFrame) -> DataFrame:
    """Rows whose key holds several fingerprints, large keys cut into tiles.

    A key of n rows has ceil(n / CHUNK) chunks; a tile holds two of them. Each pair
    of rows meets in exactly one tile, and no tile exceeds two chunks or so.
    """
    sizes = keyed.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    chunk = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    return (
        keyed.join(sizes.select("part", "key", chunks.alias("chunks")), ["part", "key"])
        .withColumn("chunk", chunk)
        .withColumn("other", other)
        .select(
            "part", "key", F.least("chunk", "other").alias("i"),
            F.greatest("chunk", "other").alias("j"), "chunk", "fp",
        )
    )


def distance_table(fps: np.ndarray) -> np.ndarray:
    """Hamming distances of each fingerprint to each reference."""
    pivots = np.array(PIVOTS, np.uint64)
    return np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int8)


def _survivors(fps, table, left, right) -> tuple[np.ndarray, np.ndarray]:
    """Of candidate index pairs those within the distance, pivots first."""
    near = np.abs(table[left] - table[right]).max(1) <= MAX_BITS
    left, right = left[near], right[near]
    same = np.bitwise_count(fps[left] ^ fps[right]) <= MAX_BITS
    return left[same], right[same]


def forest(n: int, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links to the smallest member of each part that the given links join."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[left], label[right])
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        if (label == before).all():
            break
    moved = np.flatnonzero(label != np.arange(n))
    return moved, label[moved]


def _links_of_runs(fps, chunk, starts, lengths, one_chunk) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal keys; ``one_chunk`` marks tiles of a chunk with itself."""
    table = distance_table(fps)
    run = np.repeat(np.arange(len(starts)), lengths)
    whole = np.repeat(one_chunk, lengths)
    left, right = [], []
    short = np.repeat(lengths <= _SHORT, lengths)
    for shift in range(1, min(_SHORT, int(lengths.max(initial=0)))):
        at = np.flatnonzero((run[:-shift] == run[shift:]) & short[:-shift])
        if not len(at):
            break
        at = at[whole[at] | (chunk[at] != chunk[at + shift])]
        a, b = _survivors(fps, table, at, at + shift)
        left.append(a)
        right.append(b)
    for start, length, single in zip(starts, lengths, one_chunk, strict=True):
        if length <= _SHORT:
            continue
        found = []
        for k in range(start, start + length - 1):
            other = np.arange(k + 1, start + length)
            if not single:
                other = other[chunk[other] != chunk[k]]
            near = np.abs(table[other] - table[k]).max(1, initial=0) <= MAX_BITS
            other = other[near]
            other = other[np.bitwise_count(fps[other] ^ fps[k]) <= MAX_BITS]
            if len(other):
                found.append((np.full(len(other), k), other))
        if found:
            a, b = (np.concatenate(x) - start for x in zip(*found, strict=True))
            a, b = forest(length, a, b)
            left.append(a + start)
            right.append(b + start)
    empty = np.empty(0, np.int64)
    return (np.concatenate(left) if left else empty), (np.concatenate(right) if right else empty)


def _link_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links from rows sorted by part, key and tile; a run may span batches."""
    names = ("part", "key", "i", "j", "chunk", "fp")
    held: list[np.ndarray] | None = None

    def links(columns: list[np.ndarray]) -> pa.RecordBatch:
        part, key, i, j, chunk, fp = columns
        change = (np.diff(part) != 0) | (np.diff(key) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)
        starts = np.concatenate([[0], np.flatnonzero(change) + 1])
        lengths = np.diff(np.concatenate([starts, [len(fp)]]))
        fps = fp.view(np.uint64)
        a, b = _links_of_runs(fps, chunk, starts, lengths, i[starts] == j[starts])
        return pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], names=["a", "b"])

    for batch in batches:
        columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
        if not len(columns[0]):
            continue
        if held is not None:
            columns = [np.concatenate(x) for x in zip(held, columns, strict=True)]
        last = np.ones(len(columns[0]), bool)
        for c in columns[:4]:
            last &= c == c[-1]
        cut = len(last) - int(last[::-1].argmin()) if not last.all() else 0
        held = [c[cut:] for c in columns]
        if cut:
            yield links([c[:cut] for c in columns])
    if held is not None:
        yield links(held)


def fingerprint_links(nodes: DataFrame) -> DataFrame:
    """Links between distinct fingerprints (``fp``) that join all within ``MAX_BITS``.

    Within a large run only a spanning set of the links is returned, so the result
    grows with the fingerprints and not with their pairs. Parts joined are the same.
    """
    order = ["part", "key", "i", "j"]
    tiles = _tiles(_keyed(nodes)).repartition(*order).sortWithinPartitions(*order)
    return tiles.mapInArrow(_link_batches, "a long, b long")


def near_duplicates(
    marked: DataFrame, doc_id: str = "doc_id", name: str = "simhash", links: DataFrame | None = None,
) -> DataFrame:
    """Components of documents whose fingerprints link directly or in a chain.

    ``links`` are pairs of fingerprints; without it those within ``MAX_BITS`` link.

    ``marked`` holds an id and a fingerprint per document and should be a written
    table, as it is read more than once. Returns ``doc_id``, ``simhash``,
    ``component_id`` (the smallest id of the component) and ``component`` (its
    smallest fingerprint). Documents without words share fingerprint zero. Repeated
    rows stay; NULL ids count only where a component has no other, then
    ``component_id`` is NULL. An empty table gives an empty result.
    """
    ids = marked.select(F.col(doc_id).alias(doc_id), F.col(name).alias("fp"))
    nodes = materialize(ids.groupBy("fp").agg(F.min(doc_id).alias("first_id")))
    parts = connected_components(fingerprint_links(nodes.select("fp")) if links is None else links)
    linked = parts.join(nodes, parts["node"] == nodes["fp"]).select("fp", "component", "first_id")
    least = linked.groupBy("component").agg(F.min("first_id").alias("least_id"))
    linked = materialize(linked.join(least, "component").select("fp", "component", "least_id"))
    placed = nodes.join(linked, "fp", "left").select(
        "fp",
        F.coalesce("least_id", "first_id").alias("component_id"),
        F.coalesce("component", "fp").alias("component"),
    )
    return ids.join(placed, "fp").select(doc_id, F.col("fp").alias(name), "component_id", "component")


def keep_one(
    docs: DataFrame, mark: Callable[..., DataFrame] = with_fingerprint,
    link: Callable[..., DataFrame] | None = None, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One document of each component, with the columns of ``docs``, whatever their names.

    The document with the smallest id stays (a NULL id only where there is no other).
    ``mark`` adds the fingerprint as ``simhash``; ``link`` gives the links of the marked
    documents, without it fingerprints within ``MAX_BITS`` link. Both are told where the
    text is.
    """
    # The input travels in one column, so that no name of it meets one used here.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    marked = materialize(mark(docs.select(row, F.col(f"`{doc_id}`").alias("doc_id")), f"row.`{text}`"))
    links = link(marked, "doc_id", f"row.`{text}`") if link else None
    groups = near_duplicates(marked, links=links)
    choice = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "simhash")).alias("c")
    keepers = groups.groupBy("component").agg(choice).select(
        F.col("c.doc_id").alias("keep_id"), F.col("c.simhash").alias("keep_fp")
    )
    keepers = materialize(keepers)
    kept = marked.join(
        keepers,
        (F.col("simhash") == F.col("keep_fp")) & F.col("doc_id").eqNullSafe(F.col("keep_id")),
    ).dropDuplicates(["simhash", "doc_id"])
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = materialize(with_fingerprint(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text"))
    digits = F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint")
    return near_duplicates(marked).select("doc_id", digits, "component_id")
