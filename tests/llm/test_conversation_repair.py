"""Conversation repair against exhaustive search and a plain version of the query."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
import xxhash

from stresslake.llm import conversation_repair as cr
from stresslake.llm.common import prepare, read

GOOD = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def all_repairs(codes):
    """(cost, audit, repaired initials) of every way to repair a few rows."""
    inserts = ["", "u", "a", "ua", "au"]

    def edits(code):
        yield cr.DELETE, "D", ""
        if code[1] != "x":
            extra = cr.TRUNCATED if code[1] == "t" else 0
            yield extra, "K", code[0]
            for role in "ua":
                yield cr.REROLE + extra, "R", role

    for ways in itertools.product(*[list(itertools.product(inserts, edits(c))) for c in codes]):
        for tail in inserts:
            cost = sum(cr.INSERT * len(i) + e[0] for i, e in ways) + cr.INSERT * len(tail)
            audit = "".join("I" * len(i) + e[1] for i, e in ways) + "I" * len(tail)
            roles = "".join(i + e[2] for i, e in ways) + tail
            if GOOD.fullmatch(roles):
                yield cost, audit, roles


def solved(codes):
    """(cost, audit) by the operator's functions alone."""
    table = cr.piece_table(codes)
    end = cr.best_end(table)
    cost, tail = cr.TAIL[end]
    return table[cr.START][end][0] + cost, "".join(a for _, a in cr.row_audits(codes, cr.START, end)) + tail


def plain(codes):
    """(cost, audit) by keeping whole audits per state."""
    best = {cr.START: (0, "")}
    for code in codes:
        ways = {}
        for state, (cost, audit) in best.items():
            for after in cr.STATES:
                price, edits = cr.row_table(code)[state][after]
                if price < cr.FAR:
                    way = (cost + price, audit + edits)
                    ways[after] = min(ways.get(after, way), way)
        best = ways
    return min((cost + cr.TAIL[q][0], audit + cr.TAIL[q][1]) for q, (cost, audit) in best.items())


def test_cheapest_and_least_audit():
    codes = [r + k for r in "suao" for k in "ctx"]
    rng = random.Random(1)
    for n in (1, 2, 3):
        rows = list(itertools.product(codes, repeat=n))
        for case in rng.sample(rows, min(len(rows), 120 if n < 3 else 25)):
            assert solved(list(case)) == min(all_repairs(case))[:2], case


def test_divide_and_conquer_equals_whole_audits():
    rng = random.Random(2)
    for n in (5, 17, 64, 301):
        for _ in range(10):
            case = [rng.choice("suuaao") + rng.choice("cccctx") for _ in range(n)]
            assert solved(case) == plain(case)


def test_pieces_join_to_the_whole():
    rng = random.Random(3)
    for _ in range(30):
        case = [rng.choice("suuaao") + rng.choice("cctx") for _ in range(rng.randint(3, 40))]
        cuts = sorted(rng.sample(range(1, len(case)), 2))
        parts = [case[a:b] for a, b in zip([0, *cuts], [*cuts, len(case)], strict=True)]
        tables = [cr.piece_table(p) for p in parts]
        whole = cr.piece_table(tables, cr.forward)
        end = cr.best_end(whole)
        states = cr.crossings(tables, cr.START, end, cr.forward, cr.backward)
        audit = "".join(
            a for p, begin, after in zip(parts, [cr.START, *states[:-1]], states, strict=True)
            for _, a in cr.row_audits(p, begin, after)
        ) + cr.TAIL[end][1]
        assert (whole[cr.START][end][0] + cr.TAIL[end][0], audit) == plain(case)


def plain_query(rows):
    """The query's rows by conversation, straight from its definition."""
    white = " \t\n\x0b\f\r"
    signed = lambda n: n - (1 << 64) if n >> 63 else n
    tie = lambda role, text: signed(xxhash.xxh64_intdigest(text, xxhash.xxh64_intdigest(role, 42)))
    kept = {}
    for conv, turn, role, text in rows:
        kept.setdefault(conv, [])
        role, text = (" " if v is None else v for v in (role, text))
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        number = zlib.crc32(key.encode()) % 20
        if number == 0:
            continue
        text = "" if number == 1 else re.sub("[.!?]", "", text) if number == 2 else text
        role = "user" if number == 4 else role
        kept[conv] += [(turn, role, text)] * (2 if number == 3 else 1)
    out = {}
    for conv, found in kept.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, tie(*r[1:])))
        turns = [t for t, _, _ in found if t is not None]
        seen, codes, faults, initials = set(), [], [], []
        for _, role, text in found:
            body = text.rstrip(white)
            fault = ("blank" if not body else "duplicate" if (role, text) in seen
                     else "truncated" if body[-1] not in ".!?" else None)
            seen.add((role, text))
            faults.append(fault)
            initials.append(role[:1] if role[:1] in ("s", "u", "a") else "o")
            codes.append(initials[-1] + {None: "c", "truncated": "t"}.get(fault, "x"))
        cost, audit = plain(codes)
        lines, state, row = [], cr.START, iter(found)
        for edit in audit:
            if edit == "I":
                state = cr.NEXT[state]
                lines.append(cr.ROLE_OF[state] + ":")
                continue
            _, role, text = next(row)
            if edit != "D":
                state = cr.SYSTEM if edit == "K" and role[:1] == "s" else cr.NEXT[state]
                lines.append((role if edit == "K" else cr.ROLE_OF[state]) + ":" + text)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            cr.illegal_pairs("".join(initials)), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def run_query(spark, tmp_path, frame):
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    prepare(spark)
    return {r[0]: tuple(r[1:]) for r in cr.op13_conversation_repair(spark, str(tmp_path)).collect()}


def test_query_equals_plain_version(spark):
    rows = read(spark, "/root/testdata/sf0.01", "conversations")
    prepare(spark)
    found = {r[0]: tuple(r[1:]) for r in cr.op13_conversation_repair(spark, "/root/testdata/sf0.01").collect()}
    assert found == plain_query([tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()])


def odd_rows():
    rng = random.Random(5)
    texts = ["Yes.", "no", "", " \n", "What?\n", "é!", None, "Yes."]
    roles = ["user", "assistant", "system", None, "", "tool", "User"]
    rows = [(c, t, rng.choice(roles), rng.choice(texts))
            for c in (None, 1, 2, -7) for t in [None, None, *range(9), 4, 4, 1 << 40]]
    rows += [(9, 5, "user", "Same.")] * 40 + [(10, None, None, None)]
    # Numbers of a drop: a conversation that loses its only row.
    lost = next(c for c in range(100, 1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return [*rows, (lost, 0, "user", "Gone.")]


def test_nulls_ties_and_repeats(spark, tmp_path):
    rows = odd_rows()
    frame = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", pos long")
    assert run_query(spark, tmp_path, frame) == plain_query(rows)


def test_long_conversation_in_many_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cr, "PIECE_BITS", 2)
    monkeypatch.setattr(cr, "FAN_BITS", 2)
    monkeypatch.setattr(cr, "FAN", 4)
    rng = random.Random(6)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "no", f"{t}."]))
            for t in range(700)]
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"{t}!") for c in range(2, 40) for t in range(5)]
    assert run_query(spark, tmp_path, spark.createDataFrame(rows, SCHEMA)) == plain_query(rows)


def test_empty_table(spark, tmp_path):
    assert run_query(spark, tmp_path, spark.createDataFrame([], SCHEMA)) == {}


def test_repaired_rows_and_one_long_text(spark):
    prepare(spark)
    long_text = "word " * 200_000 + "end."
    rows = spark.createDataFrame([(1, 0, "user", long_text), (1, 2, "user", "Hi.")], SCHEMA)
    _, audits, lines = cr.repair(rows)
    found = [tuple(r) for r in lines.orderBy("pos", "number").select("role", "text", "edit").collect()]
    assert [r.audit for r in audits.collect()] == ["KR"]
    assert found == [("user", long_text, "K"), ("assistant", "Hi.", "R")]


@pytest.mark.parametrize("codes, expected", [
    (["uc", "ac"], (0, "KK")), ([], (0, "")), (["sc"], (4, "D")), (["ac"], (3, "IK")),
    (["uc", "uc"], (3, "KR")), (["ux"], (4, "D")),
])
def test_small_cases(codes, expected):
    assert (solved(codes) if codes else (0, "")) == expected
