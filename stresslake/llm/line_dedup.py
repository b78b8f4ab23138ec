"""Line dedup with a sharded minimal perfect hash over the distinct lines.

Lines are known by 128 bits of hash. Their counts (documents that hold the line, and the
last of these documents) lie in an index of shards that hold no lines and no keys:

* A shard maps its n line hashes to 0..n-1 without gaps or clashes: bit arrays in
  levels, each taking the hashes that meet no other one in it; a line's number is the
  number of bits set before its own.
* Under that number lie a short fingerprint, which tells lines that are not in the index,
  the count and the last document.

Documents send each line's hash and place past the arrays of its shard. Shards with many
probes are copied, and the probes are dealt over the copies; a task holds one shard and
streams the probes, so a line that very many documents share fills no task. Only places
of lines to be dropped return.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stresslake.llm.common import materialize, read

MIN_CHARS = 40
MIN_DOCUMENTS = 5
# Distinct lines of a shard, and probes of one copy of it, about.
SHARD_LINES = 1 << 18
COPY_PROBES = 1 << 20
# Bits of a level per hash that it receives.
ROOM = 2
SPACE = " \t\n\x0b\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    """Lines of a text; NULL and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    return F.translate(F.trim(line, F.lit(SPACE)), _UPPER, _LOWER)


def _hashes(key: Column) -> list[Column]:
    """Two 64-bit hashes with different seeds."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")]


# --- minimal perfect hash ---------------------------------------------------------


def _mix(h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
    """An own hash of each key per level."""
    with np.errstate(over="ignore"):
        x = h1 + h2 * np.uint64(2 * level + 1)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class PerfectHash:
    """Numbers 0..n-1 for n distinct pairs of hashes; knows neither of them afterwards."""

    def __init__(self, levels: list[np.ndarray]) -> None:
        """``levels``: bit arrays as 64-bit words."""
        self.levels = levels
        self.ranks, before = [], 0
        for words in levels:
            counts = np.bitwise_count(words).astype(np.int64)
            self.ranks.append(before + np.cumsum(counts) - counts)
            before += int(counts.sum())

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        levels, left = [], np.arange(len(h1))
        while len(left):
            words = -(-ROOM * len(left) // 64)
            spot = (_mix(h1[left], h2[left], len(levels)) % np.uint64(64 * words)).astype(np.int64)
            alone = np.bincount(spot, minlength=64 * words) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[spot]]
        return cls(levels)

    def find(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The number of each pair; for pairs that were not built in, any number or -1."""
        out = np.full(len(h1), -1, np.int64)
        left = np.arange(len(h1))
        for number, (words, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            if not len(left):
                break
            spot = _mix(h1[left], h2[left], number) % np.uint64(64 * len(words))
            word, bit = (spot >> np.uint64(6)).astype(np.int64), spot & np.uint64(63)
            hit = (words[word] >> bit) & np.uint64(1) == 1
            word, bit, at = word[hit], bit[hit], left[hit]
            below = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[at] = ranks[word] + np.bitwise_count(below)
            left = left[~hit]
        return out

    def pack(self) -> tuple[list[int], bytes]:
        return [len(w) for w in self.levels], b"".join(w.tobytes() for w in self.levels)

    @classmethod
    def unpack(cls, sizes: list[int], data: bytes) -> PerfectHash:
        words = np.frombuffer(data, "<u8")
        return cls(np.split(words, np.cumsum(sizes)[:-1]) if sizes else [])


# --- index ------------------------------------------------------------------------


def line_counts(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_chars: int = MIN_CHARS
) -> DataFrame:
    """Per distinct line (h1, h2): documents that hold it, and the largest of their ids.

    A document is a row; a line that it repeats counts once. The copies of a line are
    folded before the exchange. Lines of less than ``min_chars`` characters are left out.
    """
    keys = F.filter(F.transform(lines_of(F.col(text)), line_key), lambda k: F.char_length(k) >= min_chars)
    held = docs.select(F.col(doc_id).alias("doc_id"), F.explode(F.array_distinct(keys)).alias("key"))
    return held.select("doc_id", *_hashes(F.col("key"))).groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last_id")
    )


def _build(table: pa.Table) -> pa.Table:
    """One shard: arrays under the numbers of the perfect hash."""
    h1, h2 = (table[c].to_numpy().view(np.uint64) for c in ("h1", "h2"))
    hashed = PerfectHash.build(h1, h2)
    order = np.argsort(hashed.find(h1, h2))
    counts = table["n"].to_numpy()[order]
    sizes, words = hashed.pack()
    return pa.table({
        "shard": table["shard"].slice(0, 1),
        "sizes": pa.array([sizes], pa.list_(pa.int64())),
        "words": pa.array([words], pa.binary()),
        "prints": pa.array([(h2[order] >> np.uint64(32)).astype("<u4").tobytes()], pa.binary()),
        "counts": pa.array([counts.astype("<u4" if counts.max() < 1 << 32 else "<u8").tobytes()], pa.binary()),
        "lasts": pa.array([table["last_id"].take(pa.array(order)).to_pylist()], pa.list_(table.schema.field("last_id").type)),
        "probes": pa.array([int(counts.sum())], pa.int64()),
    })


def build_index(counts: DataFrame, shard_lines: int = SHARD_LINES) -> tuple[DataFrame, int]:
    """The shards of the index over ``line_counts``, written, and their number."""
    counts = materialize(counts)
    shards = max(1, -(-counts.count() // shard_lines))
    id_type = counts.schema["last_id"].dataType.simpleString()
    schema = (
        f"shard int, sizes array<long>, words binary, prints binary, counts binary, lasts array<{id_type}>, probes long"
    )
    dealt = counts.withColumn("shard", _shard(shards))
    return materialize(dealt.groupBy("shard").applyInArrow(_build, schema)), shards


def _shard(shards: int) -> Column:
    return F.pmod("h1", F.lit(shards)).cast("int")


# --- probing ----------------------------------------------------------------------


class Shard:
    """Arrays of one shard as the tasks use them."""

    def __init__(self, row: dict) -> None:
        self.hashed = PerfectHash.unpack(row["sizes"], row["words"])
        self.prints = np.frombuffer(row["prints"], "<u4")
        wide = len(row["counts"]) == 8 * len(self.prints)
        self.counts = np.frombuffer(row["counts"], "<u8" if wide else "<u4")
        self.lasts = row["lasts"]

    def look_up(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of each line, 0 if it is not known, and its number in the shard."""
        number = self.hashed.find(h1, h2)
        known = number >= 0
        known[known] = self.prints[number[known]] == (h2[known] >> np.uint64(32)).astype(np.uint32)
        counts = np.zeros(len(h1), np.int64)
        counts[known] = self.counts[number[known]]
        return counts, number


def _probe(min_documents: int):
    """mapInArrow over rows sorted by shard and copy, the arrays before the probes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = shard = None
        for batch in batches:
            numbers = batch.column("shard").to_numpy()
            copies = batch.column("copy").to_numpy()
            kinds = batch.column("kind").to_numpy()
            change = (np.diff(numbers) != 0) | (np.diff(copies) != 0) | (np.diff(kinds) != 0)
            cuts = np.concatenate([[0], np.flatnonzero(change) + 1, [len(numbers)]])
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if kinds[a] == 0:
                    current, shard = (numbers[a], copies[a]), Shard(part.slice(0, 1).to_pylist()[0])
                    continue
                if current != (numbers[a], copies[a]):
                    continue
                h1, h2 = (part.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
                counts, number = shard.look_up(h1, h2)
                often = np.flatnonzero(counts >= min_documents)
                ids = part.column("doc_id").take(pa.array(often)).to_pylist()
                drop = [i for i, own in zip(often, ids, strict=True) if own != shard.lasts[number[i]]]
                rows = part.take(pa.array(drop, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(c) for c in ("doc_id", "mark", "place")], names=["doc_id", "mark", "place"]
                )

    return run


def repeated_places(
    docs: DataFrame, index: DataFrame, shards: int, text: str = "text", doc_id: str = "doc_id",
    min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS, copy_probes: int = COPY_PROBES,
) -> DataFrame:
    """Lines to drop: doc_id, mark (hash of the text) and place (from 0).

    These are the lines in at least ``min_documents`` documents, but for the document
    with the largest id among them.
    """
    id_type = docs.schema[doc_id].dataType.simpleString()
    lines = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("mark"),
        F.monotonically_increasing_id().alias("row"), F.posexplode(lines_of(F.col(text))).alias("place", "line"),
    )
    lines = lines.select("doc_id", "mark", "row", "place", line_key(F.col("line")).alias("key"))
    probes = lines.where(F.char_length("key") >= min_chars).select(
        "doc_id", "mark", "row", "place", *_hashes(F.col("key"))
    ).withColumn("shard", _shard(shards))
    copies = F.ceil(F.col("probes") / copy_probes).cast("int")
    wide = index.where(copies > 1).select(F.col("shard").alias("s"), copies.alias("copies"))
    probes = probes.join(wide, F.col("shard") == F.col("s"), "left").withColumn(
        "copy", F.pmod(F.xxhash64("row", "place"), F.coalesce("copies", F.lit(1))).cast("int")
    )
    arrays = index.withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    columns = ["shard", "copy", "kind", "sizes", "words", "prints", "counts", "lasts", "doc_id", "mark", "place", "h1", "h2"]
    kinds = {"kind": F.lit(0), "doc_id": F.lit(None).cast(id_type)}
    kinds |= {c: F.lit(None).cast("long") for c in ("mark", "h1", "h2")} | {"place": F.lit(None).cast("int")}
    none = {f.name: F.lit(None).cast(f.dataType) for f in index.schema if f.name in columns and f.name != "shard"}
    rows = arrays.withColumns(kinds).select(columns).unionByName(
        probes.withColumns({"kind": F.lit(1), **none}).select(columns)
    )
    # Of a shard without frequent lines nothing needs to be asked, but it costs little.
    placed = rows.repartition("shard", "copy").sortWithinPartitions("shard", "copy", "kind")
    return placed.mapInArrow(_probe(min_documents), f"doc_id {id_type}, mark long, place int")


def dedup_lines(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
    min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS,
    n_lines: str = "n_lines", n_dropped: str = "n_dropped", **sizes: int,
) -> DataFrame:
    """``docs`` with lines dropped that many documents share, and two counts.

    A line is known by its text without white space at its ends and with A-Z in lower
    case. Lines of at least ``min_chars`` characters found in at least ``min_documents``
    documents (rows) stay only in those with the largest id that holds them; all other
    lines stay, joined by line breaks. ``n_lines`` counts the lines before, ``n_dropped``
    those that went; columns of these names are replaced, all others stay.

    NULL texts count as empty: one line, text ''. Rows without an id are smaller than
    any other. Repeated rows are documents of their own and get the same text; where
    they hold the largest id, all of them keep the line. An empty table gives an empty
    result.
    """
    id_name = f"`{doc_id}`"
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in (n_lines, n_dropped)]).alias("row"))
    plain = docs.select(F.col(id_name).alias("doc_id"), F.col(f"`{text}`").alias("text"))
    index, shards = build_index(
        line_counts(plain, min_chars=min_chars), sizes.get("shard_lines", SHARD_LINES)
    )
    found = repeated_places(
        plain, index, shards, min_chars=min_chars, min_documents=min_documents,
        copy_probes=sizes.get("copy_probes", COPY_PROBES),
    )
    dropped = found.groupBy("doc_id", "mark").agg(F.collect_set("place").alias("places"))
    body = F.col("row").getField(text)
    marked = rows.select("row", F.xxhash64(body).alias("own"))
    joined = marked.join(
        dropped, F.col("row").getField(doc_id).eqNullSafe(F.col("doc_id")) & (F.col("own") == F.col("mark")), "left"
    )
    lines = lines_of(body)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("places"))
    new = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    names = [c for c in docs.columns if c not in (n_lines, n_dropped)]
    out = [
        F.when(F.col("places").isNull(), F.coalesce(body, F.lit(""))).otherwise(new).alias(c)
        if c == text else F.col("row").getField(c).alias(c)
        for c in names
    ]
    gone = F.when(F.col("places").isNull(), F.lit(0)).otherwise(F.size("places"))
    return joined.select(*out, F.size(lines).cast("long").alias(n_lines), gone.cast("long").alias(n_dropped))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


OP11_SQL = r"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), shared AS (
  SELECT key, max(doc_id) AS last_id FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.last_id AS dropped
  FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
