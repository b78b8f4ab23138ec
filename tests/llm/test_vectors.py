"""Top-k search and embedding near-duplicates against all pairs."""

import math
import os
from collections import Counter

import numpy as np
import pytest

from stresslake.llm import embedding_dedup, knn
from stresslake.llm.common import read
from tests.oracle_check import connect, differences

SCHEMA = "vec_id long, embedding array<float>, label int, vector string"


def test_topk_matches_sql(spark):
    folder = "/root/testdata/sf0.01"
    found = knn.op5_topk(spark, folder)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert differences(found, connect(folder), knn.OP5_SQL) == []


def plain_topk(rows, queries, k):
    usable = {
        i: [math.floor(64 * x) for x in v] for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for q in queries:
        scored = sorted(
            (-sum(a * b for a, b in zip(usable[q], v, strict=True)), i)
            for i, v in usable.items() if i != q and len(v) == len(usable[q])
        )
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize("shard,block", [(40, 7), (10_000, 10_000)])
def test_topk_over_shards(spark, monkeypatch, shard, block):
    monkeypatch.setattr(knn, "SHARD_ROWS", shard)
    monkeypatch.setattr(knn, "BLOCK_QUERIES", block)
    monkeypatch.setattr(knn, "LEAF_ROWS", 8)
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 1, 5)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)]  # ties
    rows += [(2000, None), (2001, [float("nan")] * 5), (2002, [1.0, None, 1.0, 1.0, 1.0]),
             (2003, [1.0, 2.0]), (2004, [3.0, 2.0]), (2005, []), (None, [1.0] * 5),
             (2006, [float("inf")] * 5), (2007, [1e6] * 5)]
    table = knn.quantize(spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA))
    asked = [i for i, v in rows if i in {0, 5, 77, 1003, 2003, 2007} or (i or 1) % 20 == 0 and i < 2000]
    found = knn.top_k(table, table.where(table.vec_id.isin(asked)), 6)
    assert Counter(map(tuple, found.collect())) == plain_topk(rows, asked, 6)
    assert knn.top_k(table.where("false"), table.where("false")).count() == 0


def test_topk_beyond_double_precision(spark):
    rows = [(i, [float(2**25 + 4 * i), 3.0], 1, "x") for i in range(8)]
    table = knn.quantize(spark.createDataFrame(rows, SCHEMA))
    found = knn.top_k(table, table.where("vec_id = 0"), 3)
    assert Counter(map(tuple, found.collect())) == plain_topk([r[:2] for r in rows], [0], 3)


def plain_groups(ids, vectors, least=0.9):
    """n_links and component per row, over all pairs."""
    n = len(ids)
    usable = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)
              for v in vectors]
    parent, links = list(range(n)), [0] * n

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i + 1, n):
            if usable[i] and usable[j] and len(vectors[i]) == len(vectors[j]):
                a, b = np.array(vectors[i], float), np.array(vectors[j], float)
                if a @ b / math.sqrt(a @ a) / math.sqrt(b @ b) >= least:
                    links[i] += 1
                    links[j] += 1
                    parent[root(i)] = root(j)
    smallest = {}
    for i, x in enumerate(ids):
        if x is not None:
            smallest[root(i)] = min(x, smallest.get(root(i), x))
    parts = [smallest.get(root(i)) for i in range(n)]
    return Counter((x, k, c, c is None or x == c) for x, k, c in zip(ids, links, parts, strict=True))


def test_dedup_query_matches_all_pairs(spark):
    folder = "/root/testdata/sf0.01"
    rows = read(spark, folder, "embeddings").collect()
    found = embedding_dedup.op10_embedding_dedup(spark, folder)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    expected = plain_groups([r.vec_id for r in rows], [r.embedding for r in rows])
    assert Counter(map(tuple, found.collect())) == expected


@pytest.mark.parametrize("chunk", [25, 16384])
@pytest.mark.parametrize("dim", [3, 24])
def test_dedup_around_the_threshold(spark, monkeypatch, chunk, dim):
    monkeypatch.setattr(embedding_dedup, "CHUNK", chunk)
    rng = np.random.default_rng(dim)
    vectors = []
    for _ in range(40):
        centre = rng.normal(0, 1, dim)
        centre /= np.linalg.norm(centre)
        for spread in (0.0, 0.2, 0.4, 0.45, 0.5, 0.6):
            step = rng.normal(0, 1, dim)
            vectors.append((centre + spread * step / np.linalg.norm(step)) * rng.uniform(0.01, 100))
    hot = rng.normal(0, 1, dim)
    vectors += [hot + rng.normal(0, 0.05, dim) for _ in range(60)]
    vectors = [[float(np.float32(x)) for x in v] for v in vectors]
    vectors += [vectors[0]] * 5 + [None, [], [0.0] * dim, [float("nan")] * dim, [None] * dim, [1.0], [2.0], [-1.0]]
    vectors += [[1e30] * dim, [1e-30] * dim]
    ids = [3 * i % 1009 for i in range(len(vectors))]
    rows = list(zip(ids, vectors, [1] * len(ids), ["x"] * len(ids), strict=True)) + [(None, vectors[0], 1, "x")]
    found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert Counter(map(tuple, found.collect())) == plain_groups([*ids, None], [*vectors, vectors[0]])


def test_dedup_of_nothing(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_dedup_of_doubles_around_the_threshold(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CHUNK", 40)
    rng = np.random.default_rng(64)
    vectors = []
    for _ in range(25):
        centre = rng.normal(0, 1, 64)
        for spread in (0.0, 0.3, 0.44, 0.46, 0.48, 0.5, 0.7):
            step = rng.normal(0, 1, 64)
            vectors.append(centre / np.linalg.norm(centre) + spread * step / np.linalg.norm(step))
    hot = rng.normal(0, 1, 64)
    vectors += [hot + rng.normal(0, 0.2, 64) for _ in range(60)]
    # The first ones again in single precision: other values, all of them linked.
    vectors += [v.astype(np.float32).astype(float) for v in vectors[:9]]
    signed = [float(k % 3 == 0) for k in range(64)]
    vectors = [v.tolist() for v in vectors] + [signed, [x or -0.0 for x in signed], signed[:32]]
    rows = [(7 * i % 1009, v, 1, "x") for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, vector string")
    found = embedding_dedup.near_duplicates(table)
    assert Counter(map(tuple, found.collect())) == plain_groups([r[0] for r in rows], vectors)


def test_dedup_disk_grows_with_the_vectors(spark, monkeypatch):
    """However many chunks there are, a vector is written once and pairs of chunks exchange nothing."""
    written, plans = [], []
    store = embedding_dedup.materialize

    def recorded(df, **options):
        if "links" in df.columns:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        table = store(df, **options)
        written.append(sum(os.path.getsize(f.removeprefix("file://")) for f in table.inputFiles()))
        return table

    monkeypatch.setattr(embedding_dedup, "CHUNK", 50)
    monkeypatch.setattr(embedding_dedup, "materialize", recorded)
    points = np.random.default_rng(1).normal(0, 1, (2000, 32)).astype(np.float32).tolist()
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in enumerate(points)], SCHEMA)
    assert embedding_dedup.near_duplicates(table).count() == 2000
    assert sum(written) < 2 * 2000 * 32 * 4
    assert len(plans) == 1 and "CartesianProduct" in plans[0] and "Exchange" not in plans[0]
