"""SimHash near-duplicates against comparing all pairs."""

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stresslake.llm import simhash
from stresslake.llm.common import read

SCHEMA = "doc_id long, text string, source string, simhash_note string"


def plain_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    parts = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps, bits=3):
    """Smallest id reachable by links, over all pairs."""
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    values = np.array(fps, np.uint64)
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1:] ^ values[i]) <= bits) + i + 1:
            parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, x in enumerate(ids):
        least[root(i)] = min(x, least.get(root(i), x))
    return [least[root(i)] for i in range(len(ids))]


def components_of(spark, fps):
    marked = spark.createDataFrame(
        [(i, simhash._signed(f)) for i, f in enumerate(fps)], "doc_id long, simhash long"
    )
    return {r.doc_id: r.component_id for r in simhash.near_duplicates(marked).collect()}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_matches_all_pairs(spark, sf):
    folder = f"/root/testdata/{sf}"
    docs = read(spark, folder, "documents").orderBy("doc_id").collect()
    fps = [plain_fingerprint(d.text) for d in docs]
    parts = plain_components([d.doc_id for d in docs], fps)
    expected = Counter((d.doc_id, f"{f:016x}", c) for d, f, c in zip(docs, fps, parts, strict=True))
    found = simhash.op3_simhash(spark, folder)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert Counter(map(tuple, found.collect())) == expected
    assert len(set(parts)) < len(docs)


def test_chains_and_large_keys(spark, monkeypatch):
    """Chains of links, and keys cut into tiles, lose no link."""
    monkeypatch.setattr(simhash, "CHUNK", 16)
    rng = random.Random(5)
    base = rng.getrandbits(64)
    fps = {base}
    for _ in range(400):  # a dense cluster that shares segments
        fps.add(base ^ sum(1 << b for b in rng.sample(range(20), rng.randint(1, 4))))
    chain = rng.getrandbits(64)
    for _ in range(40):
        chain ^= sum(1 << b for b in rng.sample(range(64), 3))
        fps.add(chain)
    fps |= {rng.getrandbits(64) for _ in range(500)}
    fps = sorted(fps)
    found = components_of(spark, fps)
    assert [found[i] for i in range(len(fps))] == plain_components(range(len(fps)), fps)


def test_pairs_at_every_distance(spark):
    rng = random.Random(7)
    for bits in range(1, 6):
        fps = []
        for _ in range(200):
            x = rng.getrandbits(64)
            fps += [x, x ^ sum(1 << b for b in rng.sample(range(64), bits))]
        found = components_of(spark, fps)
        linked = [found[i] == found[i + 1] for i in range(0, len(fps), 2)]
        assert all(linked) if bits <= 3 else not any(linked)


def test_odd_rows(spark):
    long_text = "word " * 300_000
    rows = [
        (1, None, "a", "x"), (2, "", "a", "x"), (3, " \n\t", None, "x"), (4, "one", "a", None),
        (5, "ONE", "a", "x"), (6, long_text, "a", "x"), (6, long_text, "a", "x"),
        (None, "one", "a", "x"), (None, "alone here now", "a", "x"),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(
        simhash.with_fingerprint(docs).select("doc_id", "simhash")).collect()}
    assert found == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 6), (None, 4), (None, None)}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 4, 6]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.keep_one(docs).count() == 0
    marked = simhash.with_fingerprint(docs).select("doc_id", "simhash")
    assert simhash.near_duplicates(marked).count() == 0


def test_spark_hash_is_the_contract_hash(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("a b ç")).alias("h")).head()
    assert row.h & (1 << 64) - 1 == xxhash.xxh64_intdigest("a b ç".encode(), 42)
