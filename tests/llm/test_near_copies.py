"""Near copies by Jaccard against comparing all pairs, and the stage of the pipeline."""

import random

import corpus_pipeline
import pytest
from stresslake.llm import near_copies, simhash
from stresslake.llm.common import read

SCHEMA = "doc_id long, text string, source string"


def plain_set(text):
    words = (text or "").lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_kept(rows):
    """Smallest id of each group, over all pairs."""
    sets, parent = [plain_set(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a == b or a and b and len(a & b) / len(a | b) >= 0.8:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return sorted(least.values())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_stage_keeps_one_of_all_near_copies(spark, sf):
    folder = f"/root/testdata/{sf}"
    docs = read(spark, folder, "documents")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, folder)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect())
    assert ids == plain_kept([(r.doc_id, r.text) for r in docs.collect()])
    # The query's three bits keep both copies of some pairs.
    assert len(ids) < simhash.keep_one(docs).count()


def test_chains_and_large_groups(spark, monkeypatch):
    """A chain of copies, and a group cut into tiles, lose no link."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(2_000)]
    rows, text = [], rng.choices(words, k=100)
    for i in range(60):
        rows.append((i, " ".join(text)))
        text = [*text[6:], *rng.choices(words, k=6)]
    base = rng.choices(words, k=120)
    for i in range(600):
        copy = list(base)
        copy[rng.randrange(120)] = f"x{i}"
        rows.append((1_000 + i, " ".join(copy)))
    half = base[:60] + rng.choices(words, k=60)
    rows += [(5_000, " ".join(half)), (5_001, None), (5_002, " "), (5_003, "one two"), (5_004, "ONE\ntwo")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    kept = simhash.keep_one(docs, near_copies.with_set_hash, near_copies.jaccard_links)
    assert sorted(r.doc_id for r in kept.collect()) == plain_kept(rows) == [0, 1_000, 5_000, 5_001, 5_003]
    assert simhash.keep_one(docs.where("false"), near_copies.with_set_hash, near_copies.jaccard_links).count() == 0


def test_tables_and_bands_find_all_pairs(spark):
    """Recall of the candidates by themselves, against all pairs of different texts."""
    docs = read(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    marked = near_copies.with_set_hash(docs).drop("text")
    sketches = {r.simhash: r.sketch for r in marked.collect()}
    texts = {}
    for r in near_copies.with_set_hash(docs).select("simhash", "text").collect():
        texts.setdefault(r.simhash, near_copies.shingle_set(r.text))
    fps = [f for f in texts if len(texts[f])]
    close = [(a, b) for i, a in enumerate(fps) for b in fps[:i] if near_copies.jaccard(texts[a], texts[b]) >= 0.8]
    banded = [p for p in close if set(sketches[p[0]].bands) & set(sketches[p[1]].bands)]
    near = [p for p in close if any(
        bin((x ^ y) & (1 << 64) - 1).count("1") <= simhash.MAX_BITS
        for x, y in zip(sketches[p[0]].fps, sketches[p[1]].fps, strict=True))]
    assert len(close) >= 5 and len(banded) == len(close)
    # Close copies come through the pivot tables too.
    assert len(near) > 0


def test_tiles_compare_across_chunks(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "CHUNK_SHINGLES", 300)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(500)]
    base, rows = rng.choices(words, k=90), []
    for i in range(150):
        copy = list(base)
        copy[rng.randrange(90)] = f"x{i}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    kept = simhash.keep_one(docs, near_copies.with_set_hash, near_copies.jaccard_links)
    assert sorted(r.doc_id for r in kept.collect()) == plain_kept(rows)


NAMES = ["simhash", "sketch", "row", "keep_id", "keep_fp", "fp", "component", "keys", "_bands", "a.b"]


@pytest.mark.parametrize("how", [(), (near_copies.with_set_hash, near_copies.jaccard_links)])
def test_clashing_columns_stay(spark, how):
    rows = [(1, "one two three", *NAMES), (2, "one two three", *NAMES), (3, None, *NAMES)]
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in NAMES)
    kept = simhash.keep_one(spark.createDataFrame(rows, schema), *how)
    assert kept.columns == ["doc_id", "text", *NAMES]
    assert sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]
