"""Conversation structure repair by Hirschberg's divide and conquer.

A conversation is well formed if its role initials read ``(s?(ua)+)?``. Four states tell
how far a prefix has come: nothing yet, after the system row, after a user row, after an
assistant row. Rows are kept, given another role or deleted, and empty rows inserted, at
least cost; of equally cheap repairs the one whose audit (its edits' initials in order)
is least by ASCII counts.

A row is a 4x4 table: the cheapest edits, with their initials, that lead from one state
across the row to another. Its inserts come before the row's own edit, so no audit of a
prefix is the beginning of another one, and comparing audits piece by piece compares
the whole.

* A forward vector holds, for each of the four states, the least cost so far and the rank
  of its audit among the four; a backward vector the least cost to the end.
* Hirschberg: both vectors meet at the middle row. Of the states where their sum is least
  the one with the least rank is where the best repair crosses; both halves are solved
  the same way between known states. Space is linear, and no audit is ever compared.

The same step runs above rows. Conversations are cut into pieces of bounded length; a
piece's four forward vectors form a 4x4 table again, and up to ``FAN`` pieces form a
node, level by level. Downwards a node's known begin and end states give those of its
pieces. So a conversation of any length is repaired by many tasks.

Rows are placed by one range sort on conversation and turn, which cuts a long
conversation over tasks as well; places are all that later steps need.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stresslake.llm.common import materialize, read

# Costs of the edits, and of a truncated row that is not deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SPACE = " \t\n\x0b\f\r"
# Rows of a piece and pieces of a node: 2 to the power of.
PIECE_BITS, FAN_BITS = 9, 9
FAN = 1 << FAN_BITS

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
FAR = 1 << 60
# The state that a user or assistant row may lead to.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
# Inserts that finish a conversation.
TAIL = {START: (0, ""), SYSTEM: (2 * INSERT, "II"), USER: (INSERT, "I"), ASSISTANT: (0, "")}

# (cost, order) by state before and after; order is an audit or the rank of one.
Table = tuple[tuple[tuple[int, object], ...], ...]
# Costs and ranks by state.
Vector = tuple[tuple[int, ...], tuple[int, ...]]


def _row_edits(initial: str, kind: str, state: int) -> Iterator[tuple[int, int, str]]:
    """State, cost and initial of each edit of a row. Kinds: c(lean), t(runcated), x."""
    yield state, DELETE, "D"
    if kind == "x":
        return
    extra = TRUNCATED if kind == "t" else 0
    after = NEXT[state]
    if initial == "s" and state == START:
        yield SYSTEM, KEEP + extra, "K"
    if initial == ("a" if after == ASSISTANT else "u"):
        yield after, KEEP + extra, "K"
    yield after, REROLE + extra, "R"


@lru_cache(None)
def row_table(code: str) -> Table:
    """Cheapest edits across a row; ``code`` is its role initial and its kind."""
    found = [[(FAR, "")] * 4 for _ in STATES]
    for begin in STATES:
        state, cost, inserts = begin, 0, ""
        # Three inserts lead back to where one does.
        for _ in range(3):
            for after, price, edit in _row_edits(*code, state):
                found[begin][after] = min(found[begin][after], (cost + price, inserts + edit))
            state, cost, inserts = NEXT[state], cost + INSERT, inserts + "I"
    return tuple(map(tuple, found))


def forward(vector: Vector, table: Table) -> tuple[Vector, int]:
    """The vector behind a row or piece, with its least cost taken off, and that cost."""
    costs, ranks = vector
    best = []
    for after in STATES:
        ways = [
            (costs[q] + table[q][after][0], ranks[q], table[q][after][1])
            for q in STATES if costs[q] < FAR and table[q][after][0] < FAR
        ]
        best.append(min(ways) if ways else None)
    order = sorted({w[1:] for w in best if w})
    low = min(w[0] for w in best if w)
    costs = tuple(w[0] - low if w else FAR for w in best)
    return (costs, tuple(order.index(w[1:]) if w else 4 for w in best)), low


def backward(costs: tuple[int, ...], table: Table) -> tuple[int, ...]:
    """Least costs to the end from before a row or piece; only differences count."""
    found = [min(table[q][after][0] + costs[after] for after in STATES) for q in STATES]
    low = min(found)
    return tuple(min(c - low, FAR) for c in found)


# Few vectors exist once the common cost is taken off.
@lru_cache(1 << 16)
def _forward_row(vector: Vector, code: str) -> tuple[Vector, int]:
    return forward(vector, row_table(code))


@lru_cache(1 << 16)
def _backward_row(costs: tuple[int, ...], code: str) -> tuple[int, ...]:
    return backward(costs, row_table(code))


def begin_at(state: int) -> Vector:
    return tuple(0 if q == state else FAR for q in STATES), tuple(0 if q == state else 4 for q in STATES)


def piece_table(items: list, step=_forward_row) -> Table:
    """Costs and ranks of the least audits between all states across rows or pieces."""
    rows = []
    for state in STATES:
        vector, cost = begin_at(state), 0
        for item in items:
            vector, low = step(vector, item)
            cost += low
        rows.append(tuple((c + cost if c < FAR else FAR, r) for c, r in zip(*vector, strict=True)))
    return tuple(rows)


def crossings(items: list, begin: int, end: int, ahead=_forward_row, back=_backward_row) -> list[int]:
    """States behind each row or piece of the best repair between two states."""
    if len(items) <= 1:
        return [end] * len(items)
    middle = len(items) // 2
    vector = begin_at(begin)
    for item in items[:middle]:
        vector, _ = ahead(vector, item)
    costs = tuple(0 if q == end else FAR for q in STATES)
    for item in reversed(items[middle:]):
        costs = back(costs, item)
    # The audit-least of the cheapest crossings.
    _, _, state = min((vector[0][q] + costs[q], vector[1][q], q) for q in STATES)
    return crossings(items[:middle], begin, state, ahead, back) + crossings(items[middle:], state, end, ahead, back)


def row_audits(codes: list[str], begin: int, end: int) -> list[tuple[int, str]]:
    """For each row the state before it and the initials of its inserts and edit."""
    after = crossings(codes, begin, end)
    before = [begin, *after[:-1]]
    return [(p, row_table(c)[p][q][1]) for c, p, q in zip(codes, before, after, strict=True)]


def best_end(table: Table) -> int:
    """The state behind the last row of the best repair of a whole conversation."""
    return min((table[START][q][0] + TAIL[q][0], table[START][q][1], q) for q in STATES)[2]


def illegal_pairs(initials: str) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))


# --- tables as flat lists ----------------------------------------------------------


def _flat(table: Table) -> list[int]:
    return [x for row in table for pair in row for x in pair]


def _table(flat: list[int]) -> Table:
    pairs = list(zip(flat[::2], flat[1::2], strict=True))
    return tuple(tuple(pairs[i:i + 4]) for i in range(0, 16, 4))


_NODE = "struct<costs:array<long>,illegal:long,first:string,last:string>"
_ROOT = "struct<end:int,cost:long>"
_STATES = "array<struct<id:long,begin:int,end:int,finish:boolean>>"
_EDITS = "struct<audit:string,edits:array<struct<before:string,edit:string,role:string,after:string>>>"


def _piece(codes: pa.Array) -> pa.Array:
    """Table of a piece given by two letters per row, and what its initials tell."""
    out = []
    for code in codes.to_pylist():
        initials = code[::2]
        out.append({
            "costs": _flat(piece_table([code[i:i + 2] for i in range(0, len(code), 2)])),
            "illegal": illegal_pairs(initials), "first": initials[0], "last": initials[-1],
        })
    return pa.array(out, _node_type())


def _joined(children: pa.Array) -> pa.Array:
    """Table of a node from those of its pieces in order."""
    out = []
    for parts in children.to_pylist():
        parts = [p["node"] for p in parts]
        seams = sum(illegal_pairs(a["last"] + b["first"]) for a, b in zip(parts, parts[1:], strict=False))
        out.append({
            "costs": _flat(piece_table([_table(p["costs"]) for p in parts], forward)),
            "illegal": sum(p["illegal"] for p in parts) + seams,
            "first": parts[0]["first"], "last": parts[-1]["last"],
        })
    return pa.array(out, _node_type())


def _node_type() -> pa.DataType:
    return pa.struct([
        ("costs", pa.list_(pa.int64())), ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string()),
    ])


def _root(costs: pa.Array) -> pa.Array:
    out = []
    for flat in costs.to_pylist():
        table = _table(flat)
        end = best_end(table)
        out.append({"end": end, "cost": table[START][end][0] + TAIL[end][0]})
    return pa.array(out, pa.struct([("end", pa.int32()), ("cost", pa.int64())]))


def _spread(children: pa.Array, begins: pa.Array, ends: pa.Array, finishes: pa.Array) -> pa.Array:
    """Begin and end states of a node's pieces; ``finish`` marks a conversation's last."""
    out = []
    for parts, begin, end, finish in zip(*(a.to_pylist() for a in (children, begins, ends, finishes)), strict=True):
        tables = [_table(p["node"]["costs"]) for p in parts]
        after = crossings(tables, begin, end, forward, backward)
        before = [begin, *after[:-1]]
        out.append([
            {"id": p["id"], "begin": a, "end": b, "finish": finish and i == len(parts) - 1}
            for i, (p, a, b) in enumerate(zip(parts, before, after, strict=True))
        ])
    fields = [("id", pa.int64()), ("begin", pa.int32()), ("end", pa.int32()), ("finish", pa.bool_())]
    return pa.array(out, pa.list_(pa.struct(fields)))


def _edits(codes: pa.Array, begins: pa.Array, ends: pa.Array, finishes: pa.Array) -> pa.Array:
    """Audit of a piece, and per row the roles inserted before and after it and its edit.

    Inserted roles are given by their initials; ``role`` is the new role, if any.
    """
    out = []
    for code, begin, end, finish in zip(*(a.to_pylist() for a in (codes, begins, ends, finishes)), strict=True):
        rows = []
        for state, audit in row_audits([code[i:i + 2] for i in range(0, len(code), 2)], begin, end):
            before = ""
            for _ in audit[:-1]:
                state = NEXT[state]
                before += ROLE_OF[state][0]
            role = ROLE_OF[NEXT[state]] if audit[-1] == "R" else None
            rows.append({"audit": audit, "before": before, "edit": audit[-1], "role": role, "after": ""})
        tail, state = TAIL[end][1] if finish else "", end
        for _ in tail:
            state = NEXT[state]
            rows[-1]["after"] += ROLE_OF[state][0]
        out.append({"audit": "".join(r.pop("audit") for r in rows) + tail, "edits": rows})
    edit = pa.struct([(n, pa.string()) for n in ("before", "edit", "role", "after")])
    return pa.array(out, pa.struct([("audit", pa.string()), ("edits", pa.list_(edit))]))


# --- rows --------------------------------------------------------------------------


def place(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Rows by conversation and turn (NULL first) with ``pos``, their place; written once.

    Rows of one turn follow each other by the XXH64 of role and text, so equal rows are
    neighbours. NULL roles and texts count as one space.
    """
    space = F.lit(" ")
    named = rows.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), space).alias("role"), F.coalesce(F.col(text), space).alias("text"),
    )
    # Equal rows may be very many; the number only deals them over tasks.
    order = ["conv_id", "turn", "tie", "number"]
    keyed = named.withColumns({"tie": F.xxhash64("role", "text"), "number": F.monotonically_increasing_id()})
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    body = F.rtrim("text", F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    return materialize(ordered.select(
        "conv_id", F.monotonically_increasing_id().alias("pos"), "turn", "role", "text",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        (body == "").alias("blank"), (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("open"),
    ))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def mark_faults(placed: DataFrame) -> DataFrame:
    """conv_id, pos, initial and fault (blank, duplicate, truncated or NULL) of each row.

    The first row of each role and text is found by a fold over hashes of 128 bits, and
    joined on its place, which no two rows share.
    """
    same = ["conv_id", "role", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2")]
    first = placed.groupBy(*same).agg(F.min("pos").alias("first"))
    fault = (
        F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("open"), "truncated")
    )
    joined = placed.join(first.select("first"), F.col("pos") == F.col("first"), "left")
    return joined.select("conv_id", "pos", "initial", fault.alias("fault"))


def pieces_of(faults: DataFrame) -> DataFrame:
    """Pieces of conversations: id, the place of the first row, codes and the faults counted."""
    kind = F.when(F.col("fault") == "truncated", "t").when(F.col("fault").isNull(), "c").otherwise("x")
    coded = F.collect_list(F.struct("pos", F.concat("initial", kind).alias("code")))
    grouped = faults.groupBy("conv_id", F.shiftright("pos", PIECE_BITS).alias("id")).agg(
        F.min("pos").alias("first_pos"), F.array_sort(coded).alias("rows"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
    )
    code = F.array_join(F.transform("rows", lambda r: r["code"]), "")
    return materialize(grouped.withColumn("codes", code).drop("rows").withColumn("node", F.arrow_udf(_piece, _NODE)("codes")))


def solve(pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per conversation its cost and illegal pairs, and per piece the states it lies between."""
    nodes = pieces.select("conv_id", "id", "node")
    levels = []
    while True:
        sizes = nodes.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
        # One node takes all pieces of a conversation where they are few enough.
        if levels and sizes.agg(F.max("n")).head()[0] in (None, 1):
            break
        parent = F.when(F.col("n") <= FAN, F.lit(0).cast("long")).otherwise(F.shiftright("id", FAN_BITS))
        named = sizes.select(F.col("conv_id").alias("c"), "n")
        grouped = nodes.join(named, _same(F.col("conv_id"), F.col("c"))).groupBy(
            "conv_id", parent.alias("parent")
        ).agg(F.array_sort(F.collect_list(F.struct("id", "node"))).alias("children"))
        level = materialize(grouped.withColumn("node", F.arrow_udf(_joined, _NODE)("children")).withColumnRenamed("parent", "id"))
        levels.append(level)
        nodes = level.select("conv_id", "id", "node")
    top = levels[-1].withColumn("root", F.arrow_udf(_root, _ROOT)("node.costs"))
    results = top.select("conv_id", F.col("root.cost").alias("cost"), F.col("node.illegal").alias("illegal"))
    states = top.select(
        "conv_id", "id", F.lit(START).alias("begin"), F.col("root.end").alias("end"), F.lit(True).alias("finish")
    )
    for level in reversed(levels):
        inner = level.select(F.col("conv_id").alias("c"), F.col("id").alias("i"), "children")
        met = states.join(inner, _same(F.col("conv_id"), F.col("c")) & (F.col("id") == F.col("i")))
        states = materialize(met.select(
            "conv_id", F.inline(F.arrow_udf(_spread, _STATES)("children", "begin", "end", "finish"))
        ))
    return results, states


def repair(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Conversations whose roles read ``(s?(ua)+)?``, at least cost.

    Returns three tables:

    * per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost;
    * per piece of a conversation: conv_id, id (ascending) and its part of the audit;
    * repaired rows: conv_id, pos and number (their order), role, text and edit (K, R, I).

    Rows are taken by turn, NULL first; rows of one turn by XXH64 of role and text. NULL
    roles and texts count as one space, NULL ids as one conversation. A row's first fault
    counts: blank, duplicate (role and text were there before), truncated. Only initials
    s, u and a can be kept. Repeated rows are duplicates. Other columns do not matter,
    texts of any length are only read where they are compared and returned, and an empty
    table gives empty results.
    """
    placed = place(rows, conv_id, turn, role, text)
    pieces = pieces_of(mark_faults(placed))
    results, states = solve(pieces)

    turns = placed.groupBy("conv_id", "turn").agg(F.lit(1)).groupBy("conv_id").agg(
        F.max("turn").alias("high"), F.min("turn").alias("low"), F.count("turn").alias("turns")
    )
    span = F.col("high").cast("decimal(38,0)") - F.col("low").cast("decimal(38,0)") + 1 - F.col("turns")
    counts = pieces.groupBy("conv_id").agg(*[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")])
    summary = turns.select("conv_id", F.coalesce(span.cast("long"), F.lit(0).cast("long")).alias("gaps"))
    for part in (counts, results):
        named = part.withColumnRenamed("conv_id", "c")
        summary = summary.join(named, _same(F.col("conv_id"), F.col("c"))).drop("c")

    known = states.select(F.col("conv_id").alias("c"), F.col("id").alias("i"), "begin", "end", "finish")
    edited = materialize(
        pieces.join(known, _same(F.col("conv_id"), F.col("c")) & (F.col("id") == F.col("i")))
        .select("conv_id", "id", "first_pos", F.arrow_udf(_edits, _EDITS)("codes", "begin", "end", "finish").alias("e"))
    )
    audits = edited.select("conv_id", "id", F.col("e.audit").alias("audit"))
    edits = edited.select("first_pos", F.posexplode("e.edits").alias("nth", "x")).select(
        (F.col("first_pos") + F.col("nth")).alias("p"), "x.*"
    )

    def inserted(initials: Column) -> Column:
        return F.transform(F.filter(F.split(initials, ""), lambda c: c != ""), lambda c: F.struct(
            F.when(c == "u", "user").otherwise("assistant").alias("role"), F.lit("").alias("text"),
            F.lit("I").alias("edit"),
        ))

    own = F.array(F.struct(F.coalesce(F.col("x_role"), F.col("role")).alias("role"), "text", "edit"))
    nothing = F.slice(own, 1, 0)
    lines = F.concat(
        inserted(F.col("before")), F.when(F.col("edit") == "D", nothing).otherwise(own), inserted(F.col("after"))
    )
    joined = placed.select("conv_id", "pos", "role", "text").join(
        edits.withColumnRenamed("role", "x_role"), F.col("pos") == F.col("p")
    )
    out = joined.select("conv_id", "pos", F.posexplode(lines).alias("number", "line"))
    return summary, audits, out.select("conv_id", "pos", "number", "line.*")


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and text with faults drawn by crc32 of ``conv_id:turn``."""
    space = F.lit(" ")
    key = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    number = F.crc32(F.concat(key[0], F.lit(":"), key[1]).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), space) for c in ("role", "text"))
    marked = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), number.alias("n")).where("n <> 0")
    new_text = F.when(F.col("n") == 1, "").when(F.col("n") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.array_repeat(F.lit(1), F.when(F.col("n") == 3, 2).otherwise(1))
    return marked.select(
        "conv_id", "turn", F.when(F.col("n") == 4, "user").otherwise(F.col("role")).alias("role"),
        new_text.alias("text"), F.explode(copies).alias("copy"),
    ).drop("copy")


def digests(lines: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's rows (conv_id, pos, number, line) joined by line breaks.

    The digest runs over a conversation from its first to its last byte, so the lines of
    one pass through one task; they are streamed, and the task holds none of them.
    """
    id_type = lines.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = state = kind = None
        for batch in batches:
            kind, found = batch.schema.field("conv_id").type, []
            for conv, line in zip(batch.column("conv_id").to_pylist(), batch.column("line").to_pylist(), strict=True):
                if state is None or conv != current:
                    if state is not None:
                        found.append((current, state.hexdigest()))
                    current, state = conv, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(line.encode("utf-8", "surrogatepass"))
            if found:
                yield _pairs(found, kind)
        if state is not None:
            yield _pairs([(current, state.hexdigest())], kind)

    ordered = lines.repartition("conv_id").sortWithinPartitions("conv_id", "pos", "number")
    return ordered.select("conv_id", "line").mapInArrow(run, f"conv_id {id_type}, sha string")


def _pairs(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    ids, values = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(values)], names=["conv_id", "sha"])


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations")
    summary, audits, repaired = repair(damage(rows))
    line = F.concat("role", F.lit(":"), "text").alias("line")
    shas = digests(repaired.select("conv_id", "pos", "number", line))
    # The audit of a conversation is one value of its result: a letter per row or so.
    whole = audits.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("id", "audit"))).alias("parts"))
    whole = whole.select("conv_id", F.array_join(F.transform("parts", lambda p: p["audit"]), "").alias("audit"))
    out = rows.select("conv_id").distinct()
    for part in (summary, whole, shas):
        named = part.withColumnRenamed("conv_id", "c")
        out = out.join(named, _same(F.col("conv_id"), F.col("c")), "left").drop("c")
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(
        "conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
