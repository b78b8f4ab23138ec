"""Line dedup: the perfect hash, and the operator against a plain version."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from stresslake.llm import line_dedup as ld
from stresslake.llm.common import prepare, read

SCHEMA = "doc_id long, text string"
WHITE = " \t\n\x0b\f\r"
UPPER = str.maketrans(ld._UPPER, ld._LOWER)


def plain(rows):
    """(doc_id, text, lines, dropped) of each row."""
    key = lambda line: line.strip(WHITE).translate(UPPER)
    held = {}
    for doc_id, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            held.setdefault(k, []).append(doc_id)
    last = {k: max((i for i in ids if i is not None), default=None)
            for k, ids in held.items() if len(k) >= 40 and len(ids) >= 5}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in last or last[key(x)] == doc_id]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def test_perfect_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(1)
    for n in (1, 2, 63, 5_000):
        h1, h2 = rng.integers(0, 2**63, (2, n), dtype=np.uint64)
        h1[n // 2:] = h1[0]  # equal first hashes differ in the second
        built = ld.PerfectHash.build(h1, h2)
        back = ld.PerfectHash.unpack(*built.pack())
        assert sorted(back.find(h1, h2)) == list(range(n))
        other = back.find(*rng.integers(0, 2**63, (2, 100), dtype=np.uint64))
        assert ((other >= -1) & (other < n)).all()


def test_unknown_lines_count_zero(spark):
    prepare(spark)
    rows = [(i, f"{'known line ' * 5}{k}") for i in range(6) for k in range(50)]
    index, shards = ld.build_index(ld.line_counts(spark.createDataFrame(rows, SCHEMA)))
    assert shards == 1
    shard = ld.Shard(index.head().asDict())
    h1, h2 = np.random.default_rng(2).integers(0, 2**63, (2, 1000), dtype=np.uint64)
    assert not shard.look_up(h1, h2)[0].any()
    assert len(shard.counts) == 50 and (shard.counts == 6).all()


def odd_rows():
    rng = random.Random(4)
    shared = [f"  Shared line number {k} that is long enough, ÄÖ  " for k in range(12)]
    short = ["", "short", "x" * 39, " \t\x0b"]
    rows = []
    for i in range(60):
        lines = [rng.choice(shared + short + [f"own line of document {i}, quite long as well {rng.random()}"])
                 for _ in range(rng.randint(0, 12))]
        lines = [line.upper() if rng.random() < 0.2 and "Ä" not in line else line for line in lines]
        rows.append((None if i % 11 == 0 else i // 2 if i > 50 else i, "\n".join(lines)))
    rows += [(70, None), (71, ""), (None, None), (72, "\n\n")]
    rows += [(80, "a line that is repeated in one document only, forty or more\n" * 9)]
    # Equal rows, and texts of very many lines.
    rows += [(90, f"{shared[0]}\nrest")] * 7
    rows += [(91, "\n".join(f"{shared[1]}" if k % 2 else f"{k}" for k in range(20_000)))]
    return rows


def run(spark, rows, **sizes):
    prepare(spark)
    frame = spark.createDataFrame([(*r, "kept", 5) for r in rows], SCHEMA + ", places string, n_lines int")
    out = ld.dedup_lines(frame, **sizes)
    assert out.columns == ["doc_id", "text", "places", "n_lines", "n_dropped"]
    found = out.collect()
    assert all(r.places == "kept" for r in found)
    return sorted([(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found], key=repr)


def test_equals_plain_version(spark):
    rows = odd_rows()
    expected = plain(rows)
    assert run(spark, rows) == expected
    assert sum(r[3] for r in expected) > 100


def test_many_shards_and_copies(spark):
    rows = odd_rows()
    assert run(spark, rows, shard_lines=5, copy_probes=3) == plain(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_query_on_whole_table(spark):
    prepare(spark)
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    expected = [(d, n, k, hashlib.sha256(t.encode()).hexdigest())
                for d, t, n, k in plain([tuple(r) for r in docs.select("doc_id", "text").collect()])]
    found = ld.op11_line_dedup(spark, "/root/testdata/sf0.001").select("doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_texts_are_not_joined_by_line(spark):
    """No exchange of the lines themselves: only hashes and places travel."""
    prepare(spark)
    docs = read(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    counts = ld.line_counts(docs)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and counts.schema["h1"].dataType.simpleString() == "bigint"
    index, shards = ld.build_index(counts)
    found = ld.repeated_places(docs, index, shards)
    assert found.columns == ["doc_id", "mark", "place"]
    assert found.agg(F.count(F.lit(1))).head()[0] > 0
