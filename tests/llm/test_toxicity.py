"""nnPU toxicity: the risk and its fit, held-out accuracy, odd rows."""

import random
import zlib

import numpy as np

from stresslake.llm import toxicity
from stresslake.llm.common import read

SCHEMA = "doc_id long, text string, score string"


def test_query_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in read(spark, folder, "labels").collect()}
    found = toxicity.op2_toxicity(spark, folder)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.collect()
    assert len(rows) == read(spark, folder, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    tested = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    toxic = [p for p, t in tested if t]
    clean = [p for p, t in tested if not t]
    assert sum(toxic) / len(toxic) > 0.9 and sum(clean) / len(clean) < 0.05


def test_fit_recovers_positives_hidden_in_the_unlabelled():
    rng = np.random.default_rng(0)
    n, prior = 3000, 0.2
    hidden = rng.random(n) < prior
    x_unl = (rng.random((n, 12)) < 0.1).astype(np.float32)
    x_unl[hidden, 0] = 1
    x_pos = (rng.random((300, 12)) < 0.1).astype(np.float32)
    x_pos[:, 0] = 1
    x_unl[~hidden, 0] = 0
    w, b = toxicity.fit_nnpu(x_pos, x_unl, prior, 1)
    found = toxicity._sigmoid(x_unl @ w + b) >= 0.5
    assert found[hidden].mean() > 0.95 and found[~hidden].mean() < 0.02


def docs_and_labels(spark, n=400):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        text = rng.choices(words, k=20)
        toxic = i % 4 == 0
        if toxic:
            text.insert(rng.randint(0, 20), "zzbad" + rng.choice("klmno"))
        rows.append((i, " ".join(text), "x"))
        if i % 2 == 0 or not toxic:
            labels.append((i, 1, int(toxic)))
    return rows, labels


def test_odd_rows(spark):
    rows, labels = docs_and_labels(spark)
    rows += [(None, "zzbadk alone", "x"), (9001, None, "x"), (9002, "", "x"), (9003, "abc " * 100_000 + "ZZBADM", "x"),
             (9004, "123 !!", "x"), (0, rows[0][1], "x")]
    labels += [(None, 1, 1), (5, None, None), (0, 1, 1), (99999, 0, 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(docs.select("doc_id", "text"), marks)
    assert model.score("zzbadq in some words") > 0.3 > model.score("in some words")
    kept = toxicity.keep_clean(docs, marks)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert {9001, 9002, 9004} <= ids and not {None, 0, 4, 9003} & ids
    clean = {i for i, _, _ in rows if i and i < 400 and i % 4}
    assert len(clean & ids) >= 0.95 * len(clean)
    assert toxicity.keep_clean(docs.where("false"), marks).count() == 0


def test_without_labels_all_scores_are_zero(spark):
    docs = spark.createDataFrame([(1, "a b c", "x")], SCHEMA)
    for labels in ([], [(1, 1, 0)]):
        marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        assert toxicity.train(docs, marks) is None
        assert toxicity.keep_clean(docs, marks).count() == 1


def test_texts_without_a_word_stay_whatever_the_bias(spark, monkeypatch):
    model = toxicity.ToxicityModel({}, np.zeros((1, 0)), np.array([2.0]))
    monkeypatch.setattr(toxicity, "train", lambda docs, labels: model)
    rows = [(1, None, "x"), (2, "", "x"), (3, " 12_ !\n", "x"), (4, "words", "x"), (5, "\u00e9", "x")]
    kept = toxicity.keep_clean(spark.createDataFrame(rows, SCHEMA), None)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3]


def test_risk_and_slopes_equal_a_plain_loop():
    rng = np.random.default_rng(4)
    x_pos, x_unl = (rng.random((n, 5)) for n in (20, 50))
    w, prior = rng.normal(size=5), 0.3

    def plain(w):
        loss = lambda row, sign: 1 / (1 + np.exp(sign * sum(a * b for a, b in zip(row, w, strict=True))))
        positive = prior * sum(loss(r, 1) for r in x_pos) / len(x_pos)
        inner = sum(loss(r, -1) for r in x_unl) / len(x_unl) - prior * sum(loss(r, -1) for r in x_pos) / len(x_pos)
        return positive, inner

    risks = toxicity.nnpu_risk(x_pos, x_unl, w, prior)
    assert np.allclose(risks[:2], plain(w))
    for d in range(5):
        step = np.eye(5)[d] * 1e-6
        slopes = [(b - a) / 2e-6 for a, b in zip(plain(w - step), plain(w + step), strict=True)]
        assert np.allclose([risks[2][d], risks[3][d]], slopes, atol=1e-6)


def test_fit_turns_back_when_the_negative_risk_is_negative():
    """All unlabelled rows look like the positives: the risk must not run below zero."""
    x = np.ones((50, 3), np.float32)
    w, b = toxicity.fit_nnpu(x, x * 0 + np.float32(1), 0.9, 1)
    _, negative, _, _ = toxicity.nnpu_risk(np.hstack([x, x[:, :1]]), np.hstack([x, x[:, :1]]), np.append(w, b), 0.9)
    assert negative > -0.1


def test_query_scores_equal_a_plain_scorer(spark):
    folder = "/root/testdata/sf0.01"
    docs = read(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read(spark, folder, "labels"))
    plain = {}
    for r in docs.collect():
        text = (r.text or "").lower()
        words = {w for w in "".join(c if c.isalpha() else " " for c in text).split()}
        marks = {w + "$" for w in words if len(w) > 2} | {w[:n] for w in words for n in (4, 5, 6) if len(w) >= n}
        margins = [b + sum(ws[i] for f, i in model.vocabulary.items() if f in marks)
                   for ws, b in zip(model.weights, model.bias, strict=True)]
        plain[r.doc_id] = sum(1 / (1 + np.exp(-m)) for m in margins) / len(margins)
    found = {r.doc_id: r.score for r in toxicity.op2_toxicity(spark, folder).collect()}
    assert found.keys() == plain.keys()
    assert all(abs(found[i] - plain[i]) < 1e-9 for i in plain)


def test_only_copies_are_folded():
    rng = random.Random(1)
    base = [rng.choices([f"w{i}" for i in range(400)], k=200) for _ in range(4)]
    near = [*base[0][:198], "x", "y"]
    half = base[1][:100] + base[2][:100]
    texts = [" ".join(t) for t in (*base, near, half)]
    kept = toxicity.fold_copies(np.array([toxicity._sketch(t) for t in texts]))
    assert kept.tolist() == [0, 1, 2, 3, 5]
    assert len(toxicity.fold_copies(np.array([toxicity._sketch("") for _ in range(3)]))) == 1
