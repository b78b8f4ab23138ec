"""Source mixing against SQL, and its promises on odd tables."""

import math
import re
from collections import defaultdict

import pytest

from stresslake.llm import mixing
from tests.oracle_check import connect, differences

SCHEMA = "doc_id long, text string, source string, size string"


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_matches_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    found = mixing.op1_mixing(spark, folder)
    assert differences(found, connect(folder), mixing.OP1_SQL) == []
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def plain_targets(sizes, weights, share=1.5):
    """Deal the budget round by round, as the contract words it."""
    full, budget = set(), share * sum(sizes.values())
    while True:
        live = [s for s in sizes if s not in full and sizes[s] > 0]
        rest = budget - sum(2 * sizes[s] for s in full)
        level = rest / sum(weights[s] for s in live) if live else 0
        over = {s for s in live if weights[s] * level >= 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in full else weights[s] * level if s in live else 0.0 for s in sizes}
        full |= over


def check(rows, plan):
    sizes = defaultdict(int)
    for _, text, source, _ in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    wanted = plain_targets(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    taken = defaultdict(int)
    for r in plan:
        assert math.isclose(r.target, wanted[r.source], rel_tol=1e-12, abs_tol=1e-9)
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        taken[r.source] += r.taken
    for s, target in wanted.items():
        assert target - 1 <= taken[s] <= target + 1e-9
    assert len(plan) == len(rows)


def test_odd_rows(spark):
    rows = [
        (1, None, "a", "x"), (2, "", "a", "x"), (3, "one two", "a", "x"), (3, "one two", "a", "x"),
        (None, "three words here", None, "x"), (None, "more", None, "x"), (4, "w " * 50_000, "b", "x"),
        (5, "é é é", "c", "x"), (6, None, "empty", "x"),
    ] + [(i, "some words " * (i % 7), "hot", "x") for i in range(100, 400)]
    docs = spark.createDataFrame(rows, SCHEMA)
    first = mixing.mix_plan(docs).collect()
    check(rows, first)
    key = lambda r: (r.shuffle_key, r.taken, r.size)
    assert sorted(map(key, mixing.mix_plan(docs.repartition(7)).collect())) == sorted(map(key, first))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    copies = defaultdict(int)
    for r in mixed.collect():
        copies[r.doc_id, r.text] += 1
    expected = defaultdict(int)
    for r in first:
        expected[r.doc_id, r.shuffle_key] += -(-r.taken // r.size) if r.size else 0
    assert sum(copies.values()) == sum(expected.values())
    positions = sorted((r.position, r.size) for r in first if r.position is not None)
    assert positions[0][0] == 0 and len({p for p, _ in positions}) == len(positions)


def test_given_weights_and_empty_table(spark):
    docs = spark.createDataFrame([(i, "a b c", "x" if i % 2 else "y", "") for i in range(100)], SCHEMA)
    weights = spark.createDataFrame([("x", 3)], "source string, weight long")
    plan = mixing.mix_plan(docs, weights, share=0.5).collect()
    assert sum(r.taken for r in plan if r.source == "x") == 150
    assert sum(r.taken for r in plan if r.source == "y") == 0
    assert mixing.mix_plan(docs.where("false")).count() == 0
    assert mixing.mix(docs.where("false")).count() == 0


def test_the_cut_decides(spark):
    """More words are queued than the budget has, and what is taken lies before the cut."""
    rows = [(i, "word " * (1 + i * 37 % 400), f"s{i % 3}", "") for i in range(90)]
    plan = mixing.mix_plan(spark.createDataFrame(rows, SCHEMA)).collect()
    budget = sum(math.floor(t) for t in {r.source: r.target for r in plan}.values())
    assert sum(r.taken for r in plan) == budget
    part = [r for r in plan if r.taken % r.size]
    assert part and all(r.position < budget for r in plan if r.taken)
    # Only the document in service at the end of its source's share is taken in part.
    assert len(part) <= 3


def test_clashing_columns_stay(spark):
    names = ["cut0", "cut1", "_own", "_source", "own", "row", "_copy", "span", "col", "a.b"]
    schema = "doc_id long, text string, source string, " + ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame([(i, "a b c", "x", *names) for i in range(8)], schema)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    rows = mixed.collect()
    assert len(rows) == 12 and all(tuple(r)[3:] == tuple(names) for r in rows)
