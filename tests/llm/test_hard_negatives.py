"""Hard negatives: the residue product is exact, and the operator equals all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stresslake.llm import hard_negatives as hn
from stresslake.llm.common import prepare

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("dim, size", [(1, 3), (64, 300), (64, 1 << 20), (700, 5_000), (3, 1 << 28)])
def test_product_is_exact(dim, size):
    rng = np.random.default_rng(dim)
    a, b = (rng.integers(-size, size + 1, (n, dim)) for n in (17, 23))
    a[0], b[0], b[1] = size, size, -size  # the largest sums there can be
    shard = hn.Shard(b, np.arange(23), np.arange(23), np.zeros(23, np.int64))
    exact = a.astype(object) @ b.astype(object).T
    assert (shard.scores(a) == exact).all()


def test_primes():
    for dim in (1, 8, 64, 256, 4096):
        primes = hn.moduli(dim, 10**9)
        assert len(set(primes)) == len(primes) and np.prod(primes, dtype=object) > 2 * 10**9 + 1
        assert all(pow(2, p - 1, p) == 1 for p in primes)
        assert all(min(dim, hn.INNER) * (p // 2) ** 2 < 1 << 24 for p in primes)
    with pytest.raises(OverflowError):
        hn.moduli(64, 1 << 62)


def plain(rows, is_anchor, positives=5, negatives=3):
    """Rows (anchor, positive, rank, negative, scores) from all pairs."""
    used = []
    for number, (vec_id, vector, label) in enumerate(rows):
        if label is None or not vector or any(x is None or not np.isfinite(x) for x in vector):
            continue
        used.append((number, vec_id, [int(np.floor(256 * float(np.float32(x)))) for x in vector], label))
    order = lambda r: (-r[2], r[1] is None, r[1] or 0)
    out = []
    for number, vec_id, vector, label in used:
        if vec_id is None or not is_anchor(vec_id):
            continue
        scored = [(n, v, sum(x * y for x, y in zip(vector, w, strict=True)), lab)
                  for n, v, w, lab in used if len(w) == len(vector) and n != number]
        for _, pos, score, _ in sorted((r for r in scored if r[3] == label), key=order)[:positives]:
            near = [r for r in scored if r[3] != label and 50 * score <= 100 * r[2] <= 95 * score]
            out += [(vec_id, pos, rank, r[1], score, r[2])
                    for rank, r in enumerate(sorted(near, key=order)[:negatives], 1)]
    return sorted(out, key=repr)


def found(spark, rows, **options):
    prepare(spark)
    frame = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA + ", node int")
    out = hn.mine(frame, F.col("vec_id") % 5 == 0, **options)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, out.collect()), key=repr)


def odd_rows():
    rng = np.random.default_rng(3)
    centre = rng.normal(size=8)
    rows = [(i, (centre + rng.normal(size=8) * 0.7).tolist(), int(rng.integers(0, 3))) for i in range(300)]
    # Ties, repeated ids and rows, other lengths, and rows that take no part.
    rows += [(i, rows[i % 7][1], i % 3) for i in range(300, 360)]
    rows += [(5, rows[5][1], 1), (5, rows[5][1], 1), (None, rows[3][1], 2), (None, rows[3][1], 2)]
    rows += [(1000 + i, [1.0, 0.5], i % 2) for i in range(12)]
    rows += [(400, None, 1), (405, [], 1), (410, [1.0, None], 1), (415, [float("nan")] * 8, 1),
             (420, [float("inf")] * 8, 0), (425, rows[0][1], None), (430, [0.0] * 8, 0), (435, [-9.0] * 8, 0)]
    return rows


def test_equals_all_pairs(spark):
    rows = odd_rows()
    expected = plain(rows, lambda i: i % 5 == 0)
    assert len(expected) > 300
    assert found(spark, rows) == expected


def test_small_shards(spark, monkeypatch):
    monkeypatch.setattr(hn, "SHARD_ROWS", 20)
    monkeypatch.setattr(hn, "_SCORES", 50)
    rows = odd_rows()
    assert found(spark, rows) == plain(rows, lambda i: i % 5 == 0)


def test_few_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(5, [1.0, 2.0], 1)]) == []
    assert found(spark, [(5, [1.0], 1), (6, [1.0], 1), (7, [0.9], 2)]) == plain(
        [(5, [1.0], 1), (6, [1.0], 1), (7, [0.9], 2)], lambda i: i % 5 == 0)


def test_large_components_raise(spark):
    rows = [(5, [1e30, 1.0], 1), (6, [1e30, 1.0], 1), (7, [1.0, 1.0], 2)]
    with pytest.raises(Exception, match="do not fit|OverflowError"):
        found(spark, rows)
