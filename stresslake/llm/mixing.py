"""Mixing sources to target weights by weighted fair queueing, in SQL expressions only.

Each source is a queue of its documents in a shuffled order (md5 of seed, id and text), and
the queue starts again from the front once it has been served. A document's virtual
finish time is the number of words its source has served up to its end, divided by
the source's target, so every source reaches its target at time 1. Sorting all
documents by that time interleaves the sources, and the mix is truncated at the total
budget: what lies before the cut is taken. The one document of each source that is in
service at time 1 is queued word by word, each word with a finish time of its own, so
the cut falls within it and sources come out to the word.

Both running sums (per source, and over the whole mix) are taken in two levels: sums
of ranges of the sort key first, then rows within a range. There are about as many
ranges as a range has rows, so both grow with the root of the table: a hot source is
spread over many tasks, and no window runs over a whole source or the whole table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stresslake.llm.common import materialize, read, word_count

SHARE = 1.5
MAX_REPEATS = 2
CYCLE = (5, 2, 1)
SEED = "mix"
# Ranges of a sort key that a table has at least.
MIN_RANGES = 16


def cycle_weights(sources: DataFrame, cycle: tuple[int, ...] = CYCLE) -> DataFrame:
    """Weights in rotation over the sources by code point, NULL last.

    ``sources`` has one row per source; this is a catalogue of sources, ranked in one
    window.
    """
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in cycle]), (rank % len(cycle) + 1).cast("int"))
    return sources.withColumn("weight", weight.cast("long"))


def targets(
    sources: DataFrame, share: float = SHARE, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """Adds ``target`` to rows of source, source_size and weight.

    The budget, ``share`` of all sizes, is dealt by weight; a source stops at
    ``max_repeats`` times its size and what it leaves is dealt again by weight. Sorted
    by the level at which a source fills up, the sources that fill are a prefix, so
    sums over that order give the final level at once. Sums are whole numbers and the
    target needs one division. Sources without words or weight get 0.
    """
    cap = (F.col("source_size") * max_repeats).alias("cap")
    order = W.orderBy("fill", F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    onward = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.partitionBy()
    budget = (F.sum("source_size").over(everything) * share).alias("budget")
    live = sources.select("source", "weight", cap, budget).where("cap > 0 AND weight > 0")
    dealt = (
        live.withColumn("fill", F.col("cap") / F.col("weight"))
        .withColumn("caps_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weights_on", F.sum("weight").over(onward))
        # Full if its cap does not exceed what its weight gives once all before are full.
        .withColumn("full", F.col("cap") * F.col("weights_on")
                    <= F.col("weight") * (F.col("budget") - F.col("caps_before")))
    )
    open_row = lambda name: F.when(~F.col("full"), F.col(name))
    level = (F.max(open_row("budget")).over(everything) - F.min(open_row("caps_before")).over(everything))
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(
        F.col("weight") * level / F.max(open_row("weights_on")).over(everything)
    )
    found = dealt.select(F.col("source").alias("s"), target.alias("target"))
    return sources.join(found, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "source_size", "weight", F.coalesce("target", F.lit(0.0)).alias("target")
    )


def shuffle_key(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """Place of a document in the shuffled order of its source, as hex digits.

    The text takes part, so rows that share an id are spread as well.
    """
    parts = [F.coalesce(x.cast("string"), F.lit("")) for x in (doc_id, text)]
    return F.md5(F.concat_ws(":", F.lit(seed), *parts).cast("binary"))


def _running_sum(df: DataFrame, group: list[str], span: str, order: list, value: str, name: str) -> DataFrame:
    """``name``: sum of ``value`` over the rows before, by ``span`` then ``order``."""
    sums = df.groupBy(*group, span).agg(F.sum(value).alias("_sum"))
    earlier = W.partitionBy(*group).orderBy(span).rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("_base", F.coalesce(F.sum("_sum").over(earlier), F.lit(0).cast("long")))
    keys = [*group, span]
    side = sums.select(*[F.col(k).alias(f"_{k}") for k in keys], "_base")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    within = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    joined = df.join(side, same).drop(*[f"_{k}" for k in keys])
    inside = F.coalesce(F.sum(value).over(within), F.lit(0).cast("long"))
    return joined.withColumn(name, F.col("_base") + inside).drop("_base")


def mix_plan(
    docs: DataFrame, weights: DataFrame | None = None, share: float = SHARE,
    max_repeats: int = MAX_REPEATS, seed: str = SEED, text: str = "text",
) -> DataFrame:
    """What the mix takes of each document.

    ``weights`` has source and weight, one row per source; sources it lacks weigh 0,
    and without it the weights rotate. Returns doc_id, source, size (words),
    source_size, weight, target, taken, shuffle_key, finish (virtual time at which
    the document's first turn ends; NULL for a source without a target) and position
    (words of the mix before its first turn; NULL if it has none). ``taken`` counts
    repeats and never exceeds ``max_repeats`` sizes. The document in service when its
    source reaches the target is taken in part, down to whole words. The budget is what
    the targets make in whole words.

    NULL texts and texts without words have size 0 and take nothing. NULL sources
    form one source. Repeated rows are separate documents;
    if the cut falls between equal rows, either may be the one taken. An empty table
    gives an empty result.
    """
    sized = materialize(docs.select(
        "doc_id", "source", word_count(F.col(text)).alias("size"),
        shuffle_key(F.col("doc_id"), F.col(text), seed).alias("shuffle_key"),
    ))
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    if weights is None:
        sources = cycle_weights(sources)
    else:
        given = weights.select(F.col("source").alias("s"), "weight")
        sources = sources.join(given, F.col("source").eqNullSafe(F.col("s")), "left").select(
            "source", "source_size", F.coalesce("weight", F.lit(0)).cast("long").alias("weight")
        )
    sources = materialize(targets(sources, share, max_repeats))
    ranges = max(MIN_RANGES, math.isqrt(sized.count()))
    # The first hex digits of the md5 name the range of the shuffled order.
    digits = math.ceil(math.log(ranges, 16))

    queued = _running_sum(
        sized.withColumn("span", F.substring("shuffle_key", 1, digits)), ["source"], "span",
        ["shuffle_key", "doc_id", "size"], "size", "start",
    )
    side = sources.withColumnRenamed("source", "s")
    queued = queued.join(side, F.col("source").eqNullSafe(F.col("s"))).drop("s", "span")
    end = F.col("start") + F.col("size")
    queued = materialize(queued.withColumn("finish", F.when(F.col("target") > 0, end / F.col("target"))))

    # One row per turn. Turns that begin at time 1 or later lie behind the cut.
    turns = queued.withColumn("turn", F.explode(F.array(*[F.lit(t) for t in range(max_repeats)])))
    turns = turns.withColumn("begun", F.col("start") + F.col("source_size") * F.col("turn"))
    ahead = turns.where((F.col("size") > 0) & (F.col("begun") < F.floor("target")))
    done = F.col("begun") + F.col("size") <= F.col("target")
    one = F.lit(1).cast("long")
    whole_turns = ahead.where(done).withColumns({"words": F.col("size"), "served": F.col("begun") + F.col("size")})
    # In service at time 1: at most one turn of each source, word by word.
    by_word = ahead.where(~done).withColumns({
        "words": one, "served": F.explode(F.sequence(F.col("begun") + 1, F.col("begun") + F.col("size"))),
    })
    live = whole_turns.unionByName(by_word).withColumn("time", F.col("served") / F.col("target"))
    live = live.withColumn("time_range", F.floor(F.least("time", F.lit(1.0)) * ranges).cast("int"))
    order = ["time", F.col("source").asc_nulls_last(), "served", "shuffle_key", "doc_id", "size"]
    sorted_turns = _running_sum(live, [], "time_range", order, "words", "place")
    budget = sources.agg(F.coalesce(F.sum(F.floor("target")), F.lit(0))).head()[0]
    left = F.lit(int(budget)).cast("long") - F.col("place")
    cut = sorted_turns.withColumn("words", F.greatest(F.lit(0).cast("long"), F.least("words", left)))
    taken = cut.where("words > 0")
    keys = ["doc_id", "source", "size", "source_size", "weight", "target", "shuffle_key", "start", "finish"]
    # A document is named by its start too, which tells repeated rows with words apart.
    idle = queued.where("size > 0").select(
        *keys, F.lit(0).cast("long").alias("words"), F.lit(None).cast("long").alias("place")
    )
    whole = taken.select(*keys, "words", "place").unionByName(idle).groupBy(*keys).agg(
        F.sum("words").alias("taken"), F.min("place").alias("position")
    )
    none = queued.where("size = 0").select(
        *keys, F.lit(0).cast("long").alias("taken"), F.lit(None).cast("long").alias("position")
    )
    return whole.unionByName(none).drop("start")


def mix(docs: DataFrame, weights: DataFrame | None = None, **options) -> DataFrame:
    """The documents of the mix, repeated as often as it takes them, columns as in ``docs``.

    The plan leaves at most two cuts per source in the shuffled order, so texts are
    matched with a small table of sources and not moved. A document taken in part
    comes whole. Documents without words are not taken.
    """
    seed, text = options.get("seed", SEED), options.get("text", "text")
    # The input travels in one column, so that no name of it meets one used here.
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    field = F.col("row").getField
    plan = mix_plan(
        packed.select(*[field(c).alias(n) for c, n in (("doc_id", "doc_id"), ("source", "source"), (text, "text"))]),
        weights, **{**options, "text": "text"},
    )
    repeats = options.get("max_repeats", MAX_REPEATS)
    key = F.struct("shuffle_key", "size")
    cuts = materialize(plan.groupBy("source").agg(*[
        F.max(F.when(F.col("taken") > F.col("size") * t, key)).alias(f"cut{t}")
        for t in range(repeats)
    ]))
    own = F.struct(
        shuffle_key(field("doc_id"), field(text), seed).alias("shuffle_key"),
        word_count(field(text)).alias("size"),
    )
    rows = packed.withColumn("own", own).join(cuts, field("source").eqNullSafe(F.col("source"))).where(
        F.col("own.size") > 0
    )
    copies = sum(
        (F.coalesce((F.col("own") <= F.col(f"cut{t}")).cast("int"), F.lit(0)) for t in range(repeats)),
        F.lit(0),
    )
    repeated = rows.select("row", F.explode(F.array_repeat(F.lit(1), copies)))
    return repeated.select(*[field(c).alias(c) for c in docs.columns])


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix_plan(docs).select("doc_id", "size", "source_size", "target", "taken", "position")


# The same queues and cuts with plain windows.
OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS shuffle_key
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, sum(size)::BIGINT * 2 AS cap,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::BIGINT AS weight
  FROM sized GROUP BY source
), ranked AS (
  SELECT *,
         coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS caps_before,
         (sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS weights_on,
         (sum(source_size) OVER ())::DOUBLE * 1.5 AS budget
  FROM sources WHERE cap > 0
), judged AS (
  SELECT *, (cap * weights_on)::DOUBLE <= weight * (budget - caps_before) AS is_full FROM ranked
), level AS (
  SELECT max(budget) AS b, min(caps_before) AS c, max(weights_on) AS w FROM judged WHERE NOT is_full
), aimed AS (
  SELECT s.source, s.source_size,
         coalesce(CASE WHEN is_full THEN j.cap::DOUBLE ELSE j.weight * (b - c) / w END, 0.0) AS target
  FROM sources s LEFT JOIN judged j ON s.source IS NOT DISTINCT FROM j.source CROSS JOIN level
), queued AS (
  SELECT d.doc_id, d.source, d.size, d.shuffle_key, a.source_size, a.target,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY shuffle_key, doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized d JOIN aimed a ON d.source IS NOT DISTINCT FROM a.source
), turns AS (
  SELECT *, start + source_size * turn AS begun
  FROM queued CROSS JOIN (VALUES (0), (1)) AS t(turn)
  WHERE size > 0 AND start + source_size * turn < floor(target)
), live AS (
  SELECT *, size AS words, begun + size AS served FROM turns WHERE begun + size <= target
  UNION ALL
  SELECT *, 1 AS words, begun + unnest(range(1, size + 1)) AS served FROM turns WHERE begun + size > target
), placed AS (
  SELECT *, coalesce(sum(words) OVER (ORDER BY served / target, source NULLS LAST, served, shuffle_key, doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place
  FROM live
), cut AS (
  SELECT * REPLACE (least(words, (SELECT sum(floor(target)) FROM aimed) - place)::BIGINT AS words)
  FROM placed WHERE place < (SELECT sum(floor(target)) FROM aimed)
)
SELECT q.doc_id, q.size, q.source_size, q.target,
       coalesce(sum(p.words), 0)::BIGINT AS taken, min(p.place)::BIGINT AS position
FROM queued q LEFT JOIN cut p
  ON q.source IS NOT DISTINCT FROM p.source AND q.start = p.start AND q.shuffle_key = p.shuffle_key
 AND q.size = p.size AND q.doc_id IS NOT DISTINCT FROM p.doc_id
GROUP BY q.doc_id, q.size, q.source_size, q.target, q.source, q.start, q.shuffle_key
"""
