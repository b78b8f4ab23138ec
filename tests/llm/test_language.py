"""Language ID: exact code lengths, and accuracy on held-out rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from stresslake.llm import language
from stresslake.llm.common import read

SAMPLES = {"aa": ["abracadabra abra", "cadabra", ""], "bb": ["hocus pocus", "focus hocus é"], "none": [""]}


def plain_length(texts, text, contexts):
    """PPM with escape C and exclusion, spelled out, over the contexts that are kept."""
    counts = {}
    pad = [-1] * language.ORDER
    for t in texts:
        s = pad + list(t.lower().encode())
        for i in range(language.ORDER, len(s)):
            for order in range(language.ORDER + 1):
                counts.setdefault(tuple(s[i - order:i]), Counter())[s[i]] += 1

    cache = {}

    def distribution(context):
        if context in cache:
            return cache[context]
        parent = [1 / 256] * 256 if context == () else distribution(context[1:])
        seen = counts.get(context, Counter())
        n, d = sum(seen.values()), len(seen)
        left = sum(parent[b] for b in range(256) if b not in seen)
        esc = d if left > 0 else 0
        out = [
            seen[b] / (n + esc) if b in seen else (esc / (n + esc) if n else 1.0) * parent[b] / left
            for b in range(256)
        ]
        cache[context] = out
        return out

    s = pad + list(text.lower().encode())
    bits = 0.0
    for i in range(language.ORDER, len(s)):
        context = next(
            tuple(s[i - k:i]) for k in range(language.ORDER, 0, -1) if k == 1 or tuple(s[i - k:i]) in contexts
        )
        bits -= math.log2(distribution(context)[s[i]])
    return bits


def kept_contexts(model):
    """Contexts of two or more bytes that the model kept, spelled nearest byte last."""
    byte_of = {int(c): b for b, c in enumerate(model.classes) if c}
    start = len(model.first) - 1
    spell = lambda c: -1 if c == start else byte_of.get(int(c), -2)
    out, level = set(), {int(n): (spell(c),) for c, n in enumerate(model.first)}
    while level:
        longer = {}
        for node, context in level.items():
            for symbol in np.flatnonzero(model.child[node]):
                longer[int(model.child[node, symbol])] = (spell(symbol), *context)
        out |= set(longer.values())
        level = longer
    return out


@pytest.mark.parametrize("least", [1, 3])
def test_code_lengths_are_exact(monkeypatch, least):
    monkeypatch.setattr(language, "MIN_COUNT", least)
    model = language.fit(SAMPLES)
    assert model.languages == ["aa", "bb"]
    contexts = kept_contexts(model)
    assert len(contexts) > 3
    for text in ("abracadabra", "hocus", "zebra ß", "Pocus Abra! " * 5):
        found = model.code_lengths(text)
        for i, name in enumerate(model.languages):
            assert math.isclose(found[i], plain_length(SAMPLES[name], text, contexts), rel_tol=1e-5)


def test_distributions_sum_to_one():
    model = language.fit(SAMPLES)
    symbols = len(model.first) - 1
    p = np.exp2(-model.bits.reshape(-1, symbols, len(model.languages)).astype(float))
    p[:, 0] *= 256 - (model.classes > 0).sum()
    assert np.allclose(p[1:].sum(1), 1, atol=1e-5)


def test_slices_make_no_difference(monkeypatch):
    model = language.fit(SAMPLES)
    text = "abra hocus " * 300
    whole = model.code_lengths(text)
    monkeypatch.setattr(language, "_SLICE", 7)
    assert np.allclose(model.code_lengths(text), whole)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.lang for r in read(spark, folder, "documents").select("doc_id", "lang").collect()}
    found = language.op6_language(spark, folder)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = found.collect()
    assert len(rows) == len(truth) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    tested = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in tested) / len(tested) > 0.995


def test_odd_rows(spark):
    rows = [(i, f"the cat and the dog {i}", "en", "x") for i in range(40)]
    rows += [(100 + i, f"der hund und die katze {i}", "de", "x") for i in range(40)]
    rows += [(None, None, "en", "x"), (200, "", None, "x"), (201, "123 ... !", "de", "x"), (202, "die katze " * 50_000, None, "x"),
             (203, "日本", None, "x"), (1, rows[1][1], "en", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    model = language.train(docs)
    assert model.languages == ["de", "en"]
    out = {r.doc_id: r.p for r in docs.select("doc_id", language.predict_columns(model, docs.text).alias("p")).collect()}
    assert out[None].lang_pred == out[200].lang_pred == out[201].lang_pred == "und"
    assert out[202].lang_pred == "de" and out[1].lang_pred == "en" and out[203].lang_pred in ("de", "en")
    nothing = language.train(docs.where("false"))
    assert nothing.predict("text") == ("und", 0.0)
    assert docs.where("false").select(language.predict_columns(model, docs.text)).count() == 0


def test_a_language_of_long_texts_is_learnt(spark):
    long_text = "zq xk vv " * 20_000
    rows = [(i, long_text, "long") for i in range(12)]
    rows += [(100 + i, "the quick brown fox jumps over it", "short") for i in range(12)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["long", "short"]
    assert model.predict("vv zq xk zq")[0] == "long" and model.predict("the brown fox")[0] == "short"


def test_the_sample_of_many_languages_is_bounded(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(language, "fit", lambda samples: seen.update(samples))
    rows = [(i, "abc " * 500, f"l{i % 40}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    language.train(docs, max_documents=3, max_chars=1_000, max_sample=12_000)
    assert len(seen) == 40 and all(len(v) == 3 for v in seen.values())
    assert sum(len(t) for v in seen.values() for t in v) <= 12_000
