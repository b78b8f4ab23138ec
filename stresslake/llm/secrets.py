"""Secret scans: pattern matches and sliding-window entropy, in SQL expressions only.

Everything happens within a row: no exchange, no Python. Positions are code points,
ends exclusive. NULL text counts as empty and gives no span.

A candidate string of the entropy method is a maximal run of one character class.
For each class a window slides over the run. Entering and leaving characters change
the sum of c * log2(c) over the character counts c in the window by one step each, so
a window's Shannon entropy, log2(w) - sum / w, follows from the one before. A run
whose best window reaches the class's threshold is a span, unless the allow-list
names it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stresslake.llm.common import read, scan_array

# Patterns of the contract. Letters of the key words count in either case.
ASSIGN = r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16

SPAN = "array<struct<start:bigint,kind_order:int,kind:string,end:bigint>>"
MASK = "[secret]"


@dataclass(frozen=True)
class EntropyClass:
    """A character class with its window length and the bits that make a run suspicious."""

    kind: str
    characters: str
    window: int
    bits: float
    min_length: int


ENTROPY_CLASSES = (
    EntropyClass("entropy_hex", "0-9a-fA-F", 24, 3.0, 24),
    EntropyClass("entropy_base64", "A-Za-z0-9+/_=-", 20, 3.5, 20),
)
# Runs that are no secrets: between marks only words (letters in one case, or with one
# leading capital) or digits; UUIDs; repetitions. Letters of mixed case are judged.
MARKS = "[-_/+=]"
PLAIN_PART = "^(?:[A-Z]?[a-z]*|[A-Z]*|[0-9]*)$"
ALLOWED = (
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"^(.{1,4})\1+.{0,3}$",
)
# Characters of a block in which places of a text are looked up.
BLOCK = 4096
# Windows of a long run are folded in pieces of so many, which keeps each step short.
PIECE = 256


def _pieces(text: Column, pattern: str, anchor: Column) -> Column:
    """Gaps and matches in order: what precedes each match, and the match.

    Both lists come from one pattern, ``gap + match``, so they have equal length.
    ``\\G`` ties each search to the end of the one before; without it the text after
    the last match would be searched again from each of its characters. Texts without
    the anchor are not searched.
    """
    tied = F.lit(rf"\G(?s)(.*?)({pattern})")
    whole = F.regexp_extract_all(text, tied, F.lit(1))
    match = F.regexp_extract_all(text, tied, F.lit(2))
    empty = F.array().cast("array<string>")
    return F.when(anchor, F.arrays_zip(whole.alias("gap"), match.alias("match"))).otherwise(
        F.arrays_zip(empty.alias("gap"), empty.alias("match"))
    )


def _placed(pieces: Column) -> Column:
    """Start, end and text of each match, by a running sum of lengths."""

    def step(at: Column, piece: Column) -> tuple[Column, Column]:
        begin = at + F.length(piece["gap"])
        end = begin + F.length(piece["match"])
        return end, F.struct(begin.alias("start"), end.alias("end"), piece["match"].alias("match"))

    return scan_array(pieces, F.lit(0).cast("bigint"), step, "struct<start:bigint,end:bigint,match:string>")


def _labelled(spans: Column, kind: str, order: int) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(order).alias("kind_order"),
        F.lit(kind).alias("kind"), s["end"].alias("end"),
    ))


# Counts of a window's characters lie in words of 60 bits, five bits each.
COUNT_BITS, COUNTS_PER_WORD = 5, 12


def _steps(window: int) -> Column:
    """By how much c * log2(c) grows when a count rises from 0, 1, 2, ... by one.

    What enters does so before the oldest leaves, so a count exceeds the window by one.
    """
    value = lambda c: c * math.log2(c) if c > 1 else 0.0
    return F.array(*[F.lit(value(c + 1) - value(c)) for c in range(window + 1)])


def _piece_entropy(chars: Column, window: int) -> Column:
    """Best window of one piece of a run, given as an array of characters.

    The counts of all characters in the window are kept; a step raises the count of the
    one that enters, lowers that of the one that leaves, and changes the sum by both.
    """
    if window + 1 >= 1 << COUNT_BITS:
        raise ValueError(f"a window has less than {(1 << COUNT_BITS) - 1} characters")
    grows = _steps(window)

    def whole(held: Column) -> Column:
        places = held["places"]

        def step(state: Column, i: Column) -> Column:
            come = F.element_at(places, i)
            # Before the window is full nothing leaves.
            gone = F.get(places, i - window - 1)

            def count(place: Column) -> Column:
                word = F.element_at(state["counts"], place["word"])
                return F.call_function("shiftright", word, place["shift"]).bitwiseAND(F.lit((1 << COUNT_BITS) - 1))

            same = F.when((gone["word"] == come["word"]) & (gone["shift"] == come["shift"]), F.lit(1)).otherwise(F.lit(0))
            left = F.when(gone.isNotNull(), F.element_at(grows, (count(gone) + same).cast("int")))
            total = state["total"] + F.element_at(grows, (count(come) + 1).cast("int")) - F.coalesce(left, F.lit(0.0))
            unit = lambda place, at: F.when(
                at + 1 == place["word"], F.call_function("shiftleft", F.lit(1).cast("long"), place["shift"])
            ).otherwise(F.lit(0).cast("long"))
            counts = F.transform(state["counts"], lambda n, at: n + unit(come, at) - unit(gone, at))
            bits = F.when(i >= window, F.log2(F.lit(float(window))) - total / window)
            return F.struct(counts.alias("counts"), total.alias("total"), F.greatest(state["best"], bits).alias("best"))

        words = F.sequence(F.lit(1), F.greatest(F.ceil(held["distinct"] / COUNTS_PER_WORD).cast("int"), F.lit(1)))
        zero = F.struct(
            F.transform(words, lambda _: F.lit(0).cast("long")).alias("counts"), F.lit(0.0).alias("total"),
            F.lit(None).cast("double").alias("best"),
        )
        return F.aggregate(F.sequence(F.lit(1), F.size(places)), zero, step, lambda s: s["best"])

    def placed(known: Column, c: Column) -> Column:
        """Word (from 1) and shift of each character's count."""
        def place(x: Column) -> Column:
            number = (F.array_position(known, x) - 1).cast("int")
            return F.struct(
                F.floor(number / COUNTS_PER_WORD + 1).cast("int").alias("word"),
                (number % COUNTS_PER_WORD * COUNT_BITS).alias("shift"),
            )

        return F.struct(F.transform(c, place).alias("places"), F.size(known).alias("distinct"))

    # Variables of the lambdas, so that each array is computed once.
    found = F.transform(F.array(chars), lambda c: F.transform(F.array(F.array_distinct(c)), lambda k: placed(k, c))[0])
    return F.transform(found, whole)[0]


def best_window_entropy(run: Column, window: int) -> Column:
    """Largest Shannon entropy, in bits, of any ``window`` characters in a row of ``run``.

    Pieces overlap by a window less one, so each window lies in exactly one piece.
    Shorter runs give NULL.
    """
    last = F.greatest(F.floor((F.length(run) - window) / PIECE), F.lit(0))
    pieces = F.transform(
        F.sequence(F.lit(0).cast("bigint"), last),
        lambda k: F.split(run.substr((k * PIECE + 1).cast("int"), F.lit(PIECE + window - 1)), ""),
    )
    return F.array_max(F.transform(pieces, lambda chars: _piece_entropy(chars, window)))


def _suspicious(run: Column, kind: EntropyClass) -> Column:
    plain = F.forall(F.split(run, MARKS), lambda part: part.rlike(PLAIN_PART))
    allowed = reduce(or_, [run.rlike(entry) for entry in ALLOWED], plain)
    return ~allowed & (best_window_entropy(run, kind.window) >= kind.bits)


def _entropy_spans(text: Column, kind: EntropyClass, order: int) -> Column:
    # Possessive: a run is maximal, so it is never cut short to make a match.
    pattern = rf"[{kind.characters}]{{{kind.min_length},}}+"
    spans = _placed(_pieces(text, pattern, text.rlike(pattern)))
    return _labelled(F.filter(spans, lambda s: _suspicious(s["match"], kind)), kind.kind, order)


def _joined(spans: Column) -> Column:
    """kind:start:end by start, then by order of kind, joined by commas."""
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])),
        ",",
    )


def scan_secrets(
    docs: DataFrame, text: str = "text", base_name: str = "base_spans", name: str = "secret_spans"
) -> DataFrame:
    """``docs`` with two arrays of spans (start, kind, end).

    ``base_name`` holds matches of the patterns per kind, leftmost and without
    overlap; ``name`` adds the entropy spans. A document without any has empty
    arrays. Repeated rows and other columns of ``docs`` stay; columns with these two
    names are replaced.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    # Group 2 of the outer pattern is the match; the value is read from the match again.
    assign = _placed(_pieces(body, ASSIGN, body.rlike(r"(?i)password|passwd|secret|token|api_?key")))
    assign = F.filter(
        assign, lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 1)) >= MIN_ASSIGN
    )
    access = _placed(_pieces(body, ACCESS, F.contains(body, F.lit("AKIA"))))
    access = F.filter(access, lambda s: s["end"] - s["start"] >= MIN_ACCESS)
    # A run of hex digits is maximal whatever its length, so short ones need no search.
    long_hex = rf"[0-9a-f]{{{MIN_HEX},}}+"
    hexes = _placed(_pieces(body, long_hex, body.rlike(long_hex)))
    base = F.concat(
        _labelled(assign, "assign", 0), _labelled(access, "access", 1), _labelled(hexes, "hex", 2)
    ).cast(SPAN)
    extra = F.concat(*[
        _entropy_spans(body, kind, 3 + i) for i, kind in enumerate(ENTROPY_CLASSES)
    ]).cast(SPAN)
    return docs.withColumns({base_name: base, name: F.concat(base, extra)})


def _between(blocks: Column, begin: Column, end: Column) -> Column:
    """Characters ``begin`` to ``end`` of a text given in blocks of ``BLOCK`` characters.

    Looking a place up in a long text counts its characters from the front; here only
    those of one block are counted.
    """
    first, last = (F.floor(x / BLOCK).cast("int") for x in (begin, end))
    head, tail = ((x - b * BLOCK).cast("int") for x, b in ((begin, first), (end, last)))
    get = lambda k: F.coalesce(F.get(blocks, k), F.lit(""))
    inner = F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
    apart = F.concat(F.substring(get(first), head + 1, F.lit(BLOCK)), inner, F.substring(get(last), F.lit(1), tail))
    return F.when(first == last, F.substring(get(first), head + 1, tail - head)).otherwise(apart)


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by the mask; overlapping spans become one."""

    def whole(held: Column) -> Column:
        def step(at: Column, s: Column) -> tuple[Column, Column]:
            # A span that begins inside the one before only lengthens its mask.
            part = F.when(s["start"] >= at, F.concat(_between(held["blocks"], at, s["start"]), F.lit(MASK)))
            end = F.greatest(at, s["end"])
            return end, F.struct(end.alias("end"), F.coalesce(part, F.lit("")).alias("part"))

        parts = scan_array(held["spans"], F.lit(0).cast("bigint"), step, "struct<end:bigint,part:string>")

        def joined(p: Column) -> Column:
            last = F.element_at(p, -1)["end"]
            return F.concat(F.array_join(F.transform(p, lambda x: x["part"]), ""),
                            _between(held["blocks"], last, held["size"]))

        return F.transform(F.array(parts), joined)[0]

    held = F.struct(
        F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{BLOCK}}}"), F.lit(0)).alias("blocks"),
        F.array_sort(spans).alias("spans"), F.length(text).cast("bigint").alias("size"),
    )
    return F.when(F.size(spans) > 0, F.transform(F.array(held), whole)[0]).otherwise(text)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents with every secret span masked; overlapping spans become one mask.

    The columns stay those of ``docs``, whatever their names; ``n_chars``, if there,
    follows the new text. Documents without secrets stay as they are, NULL texts too.
    """
    # The input travels in one column, so that no name of it meets one used here.
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    body = F.col("row").getField(text)
    scanned = scan_secrets(packed.withColumn("body", body), "body", "base", "spans")
    new = scanned.select("row", F.size("spans").alias("n"), masked(F.col("body"), F.col("spans")).alias("new"))
    found = F.col("n") > 0

    def column(name: str) -> Column:
        own = F.col("row").getField(name)
        if name == text:
            own = F.col("new")
        elif name == "n_chars":
            own = F.when(found, F.length("new").cast(docs.schema[name].dataType)).otherwise(own)
        return own.alias(name)

    return new.select(*[column(c) for c in docs.columns])


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")

    def count(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(_joined(F.col("base_spans")), 256).alias("base_sha256"),
        _joined(F.col("secret_spans")).alias("spans"),
    )
